"""Batch and streaming give the same run-log output; a restart repeats nothing."""

from __future__ import annotations

from martlet.functions.runlog import log_lines
from martlet.plans.analogs import log_records, table
from martlet.streaming.runlog_sinks import append_text, read_stream_like, stream_text

from conftest import SF_SMALL


def test_batch_equals_stream_and_restart_is_idempotent(spark, workdir):
    events = table(spark, SF_SMALL, "events")
    batch_out, stream_out, ckpt = f"{workdir}/batch", f"{workdir}/stream", f"{workdir}/ckpt"
    append_text(log_lines(log_records(events)), batch_out, "line")

    def run_once():
        stream = read_stream_like(spark, SF_SMALL, events.schema, glob="events.parquet")
        q = stream_text(log_lines(log_records(stream)), stream_out, "line", ckpt)
        q.awaitTermination()
        assert q.exception() is None

    run_once()
    run_once()  # same checkpoint, no new input: nothing appended
    b = spark.read.text(batch_out)
    s = spark.read.text(stream_out)
    assert b.count() == s.count() == events.count()
    assert b.exceptAll(s).count() == 0 and s.exceptAll(b).count() == 0


def test_stream_picks_up_only_new_files(spark, workdir):
    from pyspark.sql import functions as F

    from martlet.functions.runlog import envelope

    events = table(spark, SF_SMALL, "events")
    inbox, out, ckpt = f"{workdir}/inbox", f"{workdir}/out", f"{workdir}/ckpt"
    first = events.where(F.col("event_id") % 2 == 0)
    second = events.where(F.col("event_id") % 2 == 1)
    first.write.parquet(inbox)

    def run_once():
        stream = read_stream_like(spark, inbox, events.schema, glob="*.parquet")
        q = stream_text(envelope(log_records(stream), "app"), out, "payload", ckpt)
        q.awaitTermination()
        assert q.exception() is None
        return spark.read.text(out).count()

    assert run_once() == first.count()
    second.write.mode("append").parquet(inbox)
    assert run_once() == events.count()  # only the new file's rows were added
    assert run_once() == events.count()

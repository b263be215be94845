"""

Usage: python tools/measure.py [sf_dir]

Prints one JSON object: load rows/s, compaction MB/s and files before/after for
one job over all partitions versus one job per partition, retention seconds by
partition count, and run-log rows/s for batch and stream.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from martlet.functions.runlog import envelope  # noqa: E402
from martlet.operators.compact import compact, compact_directory, compaction_plan  # noqa: E402
from martlet.operators.load import load_snapshot  # noqa: E402
from martlet.operators.partitions import apply_retention  # noqa: E402
from martlet.plans.analogs import (  # noqa: E402
    APP_ID,
    LOAD_DATE,
    lineitem_by_year,
    log_records,
    payroll_source,
    table,
)
from martlet.plans.spec import payroll_spec, recreate, spec_for_frame  # noqa: E402
from martlet.session import get_session, new_work_dir, unique_name  # noqa: E402
from martlet.streaming.runlog_sinks import read_stream_like, stream_parquet  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t0


def many_files(spark, sf_dir, label, files=40):
    root = new_work_dir(spark, label) + "/t"
    lineitem_by_year(spark, sf_dir).repartition(files, "l_orderkey").write.partitionBy(
        "ctl_validfrom"
    ).parquet(root)
    return root


def count_files(spark, root):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).count()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("martlet-measure", master="local[8]", shuffle_partitions=8)
    out: dict = {"sf_dir": sf_dir}

    # warm-up: one load and one compaction of each kind on the smallest tables
    warm = "/root/testdata/sf0.001"
    spec = payroll_spec(unique_name("w"), new_work_dir(spark, "w") + "/w")
    load_snapshot(spark, spec, payroll_source(spark, warm), loading_id=1, load_date=LOAD_DATE)
    warm_root = many_files(spark, warm, "warm")
    compact(spark, warm_root, "ctl_validfrom", "date", None, 20_000)
    for r in compaction_plan(spark, warm_root, "ctl_validfrom", "date", None, 10_000).collect()[:1]:
        compact_directory(spark, f"{warm_root}/{r['fragment']}", 10_000)

    # load
    for rebalance in (True, False):
        spec = payroll_spec(unique_name("m"), new_work_dir(spark, "m") + "/m")
        res, sec = timed(
            lambda: load_snapshot(
                spark, spec, payroll_source(spark, sf_dir), loading_id=42,
                load_date=LOAD_DATE, rebalance=rebalance,
            )
        )
        out[f"load_rows_per_sec_rebalance_{rebalance}"] = round(res.rows_written / sec)

    # compaction: one job over all partitions vs one job per partition
    for target in (128 * 1024 * 1024, 200_000):
        for mode in ("one_job", "per_partition"):
            root = many_files(spark, sf_dir, f"c_{mode}")
            before = count_files(spark, root)
            plan = compaction_plan(spark, root, "ctl_validfrom", "date", None, target).collect()
            mb = sum(r["bytes"] for r in plan) / 1e6
            if mode == "one_job":
                _, sec = timed(lambda: compact(spark, root, "ctl_validfrom", "date", None, target))
            else:
                def loop():
                    for r in plan:
                        compact_directory(spark, f"{root}/{r['fragment']}", target)
                _, sec = timed(loop)
            after = count_files(spark, root)
            out[f"compact_{mode}_target_{target}"] = {
                "mb": round(mb, 2), "sec": round(sec, 2), "mb_per_sec": round(mb / sec, 2),
                "files_before": before, "files_after": after, "partitions": len(plan),
            }

    # retention seconds against partition count (year, month, day partitions)
    li = table(spark, sf_dir, "lineitem")
    for unit in ("year", "month", "day"):
        root = new_work_dir(spark, f"r_{unit}") + "/r"
        df = li.select("l_orderkey", "l_quantity", F.trunc(F.col("l_shipdate").cast("date"), unit).alias("ctl_validfrom")) \
            if unit != "day" else li.select("l_orderkey", "l_quantity", F.col("l_shipdate").cast("date").alias("ctl_validfrom"))
        df.write.partitionBy("ctl_validfrom").parquet(root)
        spec = spec_for_frame(df, unique_name("r"), root)
        recreate(spark, spec)
        n = df.select("ctl_validfrom").distinct().count()
        dropped, sec = timed(lambda: apply_retention(spark, spec, "1996-01-01", "1999-01-01"))
        out[f"retention_{unit}"] = {"partitions": n, "dropped": len(dropped), "sec": round(sec, 2)}

    # run log, batch and stream
    events = table(spark, sf_dir, "events")
    n = events.count()
    _, sec = timed(lambda: envelope(log_records(events), APP_ID).write.format("noop").mode("overwrite").save())
    out["log_envelope_batch_rows_per_sec"] = round(n / sec)
    wd = new_work_dir(spark, "s")

    def stream():
        q = stream_parquet(
            envelope(log_records(read_stream_like(spark, sf_dir, events.schema, glob="events.parquet")), APP_ID),
            f"{wd}/out", f"{wd}/ckpt",
        )
        q.awaitTermination()

    _, sec = timed(stream)
    out["log_envelope_stream_rows_per_sec"] = round(n / sec)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

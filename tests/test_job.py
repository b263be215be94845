"""The whole run: loads, compaction, repair, statistics and status events."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet.job import JobConfig, MartTarget, run_mart_job
from martlet.operators.stats import read_stats
from martlet.plans.analogs import merchant_source, payroll_source
from martlet.plans.spec import merchant_spec, payroll_spec
from martlet.session import unique_name

from conftest import SF_SMALL

D = dt.date(2021, 10, 25)


def _cfg(spark, workdir, **kw):
    payroll = payroll_spec(unique_name("jp"), f"{workdir}/payroll")
    merch = merchant_spec(unique_name("jm"), f"{workdir}/merch")
    base = dict(
        targets=[
            MartTarget(payroll, payroll_source(spark, SF_SMALL), "report_dt"),
            MartTarget(merch, merchant_source(spark, SF_SMALL)),
        ],
        loading_id=42,
        entity_id=7,
        load_date=D,
        stats_path=f"{workdir}/load_stats",
        status_path=f"{workdir}/run_status",
        lines_path=f"{workdir}/run_lines",
        events_path=f"{workdir}/run_events",
        app_id="app",
        repair=True,
        count_rows=True,
    )
    base.update(kw)
    return JobConfig(**base), payroll, merch


def test_job_publishes_marts_stats_and_status(spark, workdir):
    cfg, payroll, merch = _cfg(spark, workdir)
    report = run_mart_job(spark, cfg)
    n_pay = payroll_source(spark, SF_SMALL).count()
    n_merch = merchant_source(spark, SF_SMALL).count()
    assert report.counts_before == {payroll.table: 0, merch.table: 0}
    assert report.counts_after == {payroll.table: n_pay, merch.table: n_merch}
    stats = {r.stat_id: r.avalue[0] for r in read_stats(spark, cfg.stats_path).collect()}
    business = payroll_source(spark, SF_SMALL).agg(F.max("report_dt")).first()[0]
    assert stats == {15: "app", 11: "2021-10-25", 2: "1", 5: business, 1: "2021-10-25"}
    status = spark.read.parquet(cfg.status_path).collect()
    assert [r.status for r in status] == ["RUNNING"] and status[0].loading_id == 42
    import json

    lines = [r.value for r in spark.read.text(cfg.lines_path).collect()]
    assert len(lines) == 3 and all(" - martlet.job [" in line for line in lines)
    events = [json.loads(r.value) for r in spark.read.text(cfg.events_path).collect()]
    assert sorted(e["subtype_id"] for e in events) == ["CTL_INFO", "INFO", "INFO"]
    assert all(e["app_id"] == "app" and e["type_id"] == "Tech" for e in events)


def test_job_rerun_same_day_is_idempotent(spark, workdir):
    cfg, payroll, merch = _cfg(spark, workdir)
    run_mart_job(spark, cfg)
    report = run_mart_job(spark, cfg)
    assert report.counts_before == report.counts_after


def test_job_failure_records_error_status(spark, workdir):
    cfg, payroll, _ = _cfg(spark, workdir)
    cfg.targets = [MartTarget(payroll, payroll_source(spark, SF_SMALL).limit(0), "report_dt")]
    with pytest.raises(Exception):
        run_mart_job(spark, cfg)
    rows = spark.read.parquet(cfg.status_path).collect()
    assert [r.status for r in rows] == ["ERROR"] and "FAILED" in rows[0].log


def test_job_with_timestamp_partitions_compacts_escaped_dirs(spark, workdir):
    import os

    from pyspark.sql.types import TimestampType

    from martlet.session import local_path

    payroll = payroll_spec(unique_name("jt"), f"{workdir}/payroll_ts", partition_type=TimestampType())
    src = payroll_source(spark, SF_SMALL).repartition(6, "epk_id")
    cfg = JobConfig(
        targets=[MartTarget(payroll, src, "report_dt")],
        loading_id=42, entity_id=7, load_date=D, count_rows=True,  # 6 files in, 1 out
        stats_path=f"{workdir}/stats_ts", app_id="app",
    )
    # an older partition that must stay untouched (before the load date)
    from martlet.operators.load import load_snapshot

    load_snapshot(spark, payroll, src, loading_id=41, load_date=dt.date(2021, 10, 24))
    old_dir = [n for n in os.listdir(local_path(payroll.location)) if "2021-10-24" in n][0]
    old_files = sorted(os.listdir(os.path.join(local_path(payroll.location), old_dir)))
    report = run_mart_job(spark, cfg)
    assert report.compacted_partitions[payroll.table] == 1
    dirs = sorted(n for n in os.listdir(local_path(payroll.location)) if n.startswith("ctl_validfrom="))
    assert dirs == ["ctl_validfrom=2021-10-24 00%3A00%3A00", "ctl_validfrom=2021-10-25 00%3A00%3A00"]
    assert sorted(os.listdir(os.path.join(local_path(payroll.location), old_dir))) == old_files
    n = src.count()
    assert report.counts_after[payroll.table] == 2 * n
    stats = {r.stat_id: r.avalue[0] for r in read_stats(spark, cfg.stats_path).collect()}
    assert stats[1] == "2021-10-25"


def test_job_without_whole_mart_counts(spark, workdir):
    cfg, payroll, merch = _cfg(spark, workdir, count_rows=False, lines_path=None, events_path=None)
    report = run_mart_job(spark, cfg)
    assert report.counts_before == {} and report.counts_after == {}
    assert report.loads[payroll.table].rows_written == payroll_source(spark, SF_SMALL).count()
    assert spark.read.parquet(cfg.status_path).first().status == "RUNNING"


def test_job_parallel_loads(spark, workdir):
    cfg, payroll, merch = _cfg(spark, workdir, parallel_loads=True)
    report = run_mart_job(spark, cfg)
    assert report.counts_after == {
        payroll.table: payroll_source(spark, SF_SMALL).count(),
        merch.table: merchant_source(spark, SF_SMALL).count(),
    }


def test_failing_status_sink_does_not_hide_the_error(spark, workdir):
    cfg, payroll, _ = _cfg(spark, workdir, status_path="no-such-scheme://x/y")
    cfg.targets[0] = MartTarget(payroll, "no_such_source_table", "report_dt")
    with pytest.raises(Exception) as caught:
        run_mart_job(spark, cfg)
    assert "no_such_source_table" in str(caught.value)
    assert any("could not be published" in note for note in caught.value.__notes__)

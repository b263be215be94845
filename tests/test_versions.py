"""Versioned publication: pointers, undo, several marts at once, vacuum."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martlet.operators import versions as V
from martlet.operators.compact import compact
from martlet.operators.load import SourceChangedError, load_snapshot
from martlet.operators.partitions import apply_retention, repair_partitions
from martlet.plans.analogs import lineitem_by_year, payroll_source
from martlet.plans.spec import payroll_spec, recreate, spec_for_frame
from martlet.session import local_path, unique_name
from martlet.sources.hadoop_fs import HadoopFS
from pyspark.sql.types import TimestampType

from conftest import SF_SMALL

DAY = dt.date(2021, 10, 25)


def _year_mart(spark, workdir):
    df = lineitem_by_year(spark, SF_SMALL)
    df.repartition(6, "l_orderkey").write.partitionBy("ctl_validfrom").parquet(f"{workdir}/years")
    spec = spec_for_frame(df, unique_name("years"), f"{workdir}/years")
    recreate(spark, spec)
    return spec, df


def _counts(spark, table):
    return {r[0]: r[1] for r in spark.table(table).groupBy("ctl_validfrom").count().collect()}


def test_readers_lose_no_partition_during_the_switch(spark, workdir, monkeypatch):
    """A query after every single pointer change finds all rows."""
    spec, df = _year_mart(spark, workdir)
    expected = {r[0]: r[1] for r in df.groupBy("ctl_validfrom").count().collect()}
    planned = spark.table(spec.table)
    seen = []
    point = V.Switch.point

    def watched(self, *args, **kwargs):
        point(self, *args, **kwargs)
        seen.append(_counts(spark, spec.table))

    monkeypatch.setattr(V.Switch, "point", watched)
    res = compact(spark, spec.location, "ctl_validfrom", "date", None, 20_000, table=spec.table, publish="pointer", verify="checksum")
    assert len(seen) == len(res.swapped) == 7 and all(s == expected for s in seen)
    assert planned.count() == df.count()  # the old files are still there
    at = V.partition_location(spark, spec.table, "ctl_validfrom=1995-01-01")
    assert "/_versions/v" in at
    again = compact(spark, spec.location, "ctl_validfrom", "date", dt.date(1997, 1, 1), 20_000, table=spec.table, publish="pointer")
    assert len(again.swapped) == 5 and _counts(spark, spec.table) == expected
    assert all("/_versions/" in p["path"] for p in again.plan)


def test_failed_switch_points_back(spark, workdir, monkeypatch):
    spec, df = _year_mart(spark, workdir)
    before = {f: V.partition_location(spark, spec.table, f) for f in ("ctl_validfrom=1995-01-01", "ctl_validfrom=1998-01-01")}
    calls = []
    set_ = V.Switch._set

    def failing(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == 4:
            raise OSError("catalog away")
        set_(self, *args, **kwargs)

    monkeypatch.setattr(V.Switch, "_set", failing)
    with pytest.raises(OSError):
        compact(spark, spec.location, "ctl_validfrom", "date", None, 20_000, table=spec.table, publish="pointer")
    assert {f: V.partition_location(spark, spec.table, f) for f in before} == before
    assert spark.table(spec.table).count() == df.count()


def test_rows_appended_during_a_pointer_compaction_are_kept(spark, workdir, monkeypatch):
    spec, df = _year_mart(spark, workdir)
    extra = df.where(F.col("ctl_validfrom") == F.lit("1995-01-01").cast("date")).limit(9).drop("ctl_validfrom")
    point = V.Switch.point

    def appending(self, fragment, *args, **kwargs):
        point(self, fragment, *args, **kwargs)
        if "1995" in fragment:
            extra.coalesce(1).write.mode("append").parquet(f"{spec.location}/{fragment}")

    monkeypatch.setattr(V.Switch, "point", appending)
    res = compact(spark, spec.location, "ctl_validfrom", "date", None, 20_000, table=spec.table, publish="pointer")
    assert [c.rsplit("=", 1)[1] for c in res.conflicts] == ["1995-01-01"] and len(res.swapped) == 6
    spark.catalog.refreshTable(spec.table)
    assert spark.table(spec.table).count() == df.count() + 9


def test_both_marts_or_none(spark, workdir):
    specs = [payroll_spec(unique_name(f"m{i}"), f"{workdir}/m{i}") for i in range(2)]
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, specs[0], src, loading_id=1, load_date=DAY)  # mart one has plain rows; two has none
    broken = src.withColumn("inn", F.lit("x" * 3))  # no bigint: the insert raises
    with pytest.raises(Exception):
        V.load_together(spark, [(specs[0], src), (specs[1], broken)], loading_id=2, load_date=DAY)
    assert {r[0] for r in spark.table(specs[0].table).select("ctl_loading").distinct().collect()} == {1}
    assert spark.table(specs[1].table).count() == 0
    assert not [n for _, _, fs in os.walk(local_path(f"{workdir}/m0/_versions")) for n in fs if n.endswith(".parquet")]

    results = V.load_together(spark, [(s, src) for s in specs], loading_id=3, load_date=DAY)
    assert [r.rows_written for r in results] == [src.count()] * 2
    for s in specs:
        assert {r[0] for r in spark.table(s.table).select("ctl_loading").distinct().collect()} == {3}


def test_second_pointer_that_fails_takes_back_the_first(spark, workdir, monkeypatch):
    specs = [payroll_spec(unique_name(f"p{i}"), f"{workdir}/p{i}") for i in range(2)]
    src = payroll_source(spark, SF_SMALL)
    V.load_together(spark, [(specs[0], src)], loading_id=1, load_date=DAY)
    set_ = V.Switch._set

    def failing(self, table, *args, **kwargs):
        if table == specs[1].table:
            raise OSError("catalog away")
        set_(self, table, *args, **kwargs)

    monkeypatch.setattr(V.Switch, "_set", failing)
    with pytest.raises(OSError):
        V.load_together(spark, [(s, src) for s in specs], loading_id=2, load_date=DAY)
    assert {r[0] for r in spark.table(specs[0].table).select("ctl_loading").distinct().collect()} == {1}
    assert spark.table(specs[1].table).count() == 0


def test_staging_a_source_that_changes_publishes_nothing(spark, workdir, monkeypatch):
    spec = payroll_spec(unique_name("swap"), f"{workdir}/swap")
    src = payroll_source(spark, SF_SMALL)
    V.load_together(spark, [(spec, src)], loading_id=1, load_date=DAY)
    facts = src.agg(F.count("*").alias("source_rows"), (F.max("ctl_loading") - 1).cast("long").alias("src_loading_id")).first()
    monkeypatch.setattr(V, "pinned_source", lambda *_: (src, facts))  # as many rows, other ids
    with pytest.raises(SourceChangedError):
        V.load_together(spark, [(spec, src)], loading_id=2, load_date=DAY)
    assert {r[0] for r in spark.table(spec.table).select("ctl_loading").distinct().collect()} == {1}


def test_pointers_survive_repair_and_recreate(spark, workdir):
    spec, df = _year_mart(spark, workdir)
    compact(spark, spec.location, "ctl_validfrom", "date", dt.date(1997, 1, 1), 20_000, table=spec.table, publish="pointer")
    pointers = V.partition_locations(spark, spec.table, ["ctl_validfrom=1997-01-01", "ctl_validfrom=1996-01-01"])
    assert repair_partitions(spark, spec) == ([], [])
    V.recreate_versioned(spark, spec)
    assert V.partition_locations(spark, spec.table, list(pointers)) == pointers
    assert spark.table(spec.table).count() == df.count()


def test_vacuum_keeps_what_pointers_name(spark, workdir):
    spec, df = _year_mart(spark, workdir)
    for _ in range(2):
        compact(spark, spec.location, "ctl_validfrom", "date", dt.date(1997, 1, 1), 20_000, table=spec.table, publish="pointer")
    assert V.vacuum_versions(spark, spec, older_than_hours=1) == []
    doomed = V.vacuum_versions(spark, spec, older_than_hours=-1)
    assert len(doomed) == 10  # five retired directories, five old versions
    spark.catalog.refreshTable(spec.table)
    assert spark.table(spec.table).count() == df.count()
    assert repair_partitions(spark, spec) == ([], [])
    assert apply_retention(spark, spec, dt.date(1996, 1, 1), dt.date(1998, 1, 1)) == ["ctl_validfrom=1997-01-01"]
    left = [p for v in HadoopFS(spark).list(f"{spec.location}/_versions") for p in HadoopFS(spark).list(v.path) if "1997" in p.name]
    assert left == [] and _counts(spark, spec.table).keys() == _counts(spark, spec.table).keys() - {dt.date(1997, 1, 1)}


def test_timestamp_partitions_are_published_under_one_name(spark, workdir):
    spec = payroll_spec(unique_name("ts"), f"{workdir}/ts", partition_type=TimestampType())
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=DAY)
    V.load_together(spark, [(spec, src)], loading_id=2, load_date=DAY)
    V.load_together(spark, [(spec, src)], loading_id=3, load_date=DAY + dt.timedelta(1))
    got = {(str(r[0])[:10], r[1]): r[2] for r in spark.table(spec.table).groupBy("ctl_validfrom", "ctl_loading").count().collect()}
    assert got == {("2021-10-25", 2): src.count(), ("2021-10-26", 3): src.count()}


def test_job_publishes_together_and_compacts_by_pointer(spark, workdir):
    from martlet.job import JobConfig, MartTarget, run_mart_job

    specs = [payroll_spec(unique_name(f"j{i}"), f"{workdir}/j{i}") for i in range(2)]
    src = payroll_source(spark, SF_SMALL).repartition(5)
    report = run_mart_job(spark, JobConfig(
        targets=[MartTarget(s, src, "report_dt") for s in specs], loading_id=5, entity_id=1, load_date=DAY, together=True,
        repair=True, target_file_bytes=100_000_000, stats_path=f"{workdir}/stats", app_id="app",
    ))
    assert all(spark.table(s.table).count() == src.count() for s in specs)
    assert set(report.compacted_partitions.values()) == {1} and report.quarantined == {}
    with pytest.raises(ValueError):
        run_mart_job(spark, JobConfig(targets=[], loading_id=5, entity_id=1, load_date=DAY, together=True, force=True))

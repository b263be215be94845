"""Compaction: rows kept, file counts bounded, safe swap, plan shape."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from martlet.operators.compact import (
    CompactionLayoutError,
    CompactionSchemaError,
    CompactionVerifyError,
    _rewritten,
    _scan,
    compact,
    compact_directory,
    compaction_plan,
    files_for,
)
from martlet.plans.analogs import lineitem_by_year, table
from martlet.session import local_path
from martlet.sources.hadoop_fs import HadoopFS

from conftest import SF_SMALL

TARGET = 20_000
START = dt.date(1998, 1, 1)


def _many_files(spark, root, n=12):
    df = lineitem_by_year(spark, SF_SMALL).repartition(n, "l_orderkey")
    df.write.partitionBy("ctl_validfrom").parquet(root)
    return df


def _files_by_partition(root):
    out = {}
    for name in sorted(os.listdir(local_path(root))):
        if name.startswith("ctl_validfrom="):
            files = [f for f in os.listdir(os.path.join(local_path(root), name)) if f.endswith(".parquet")]
            out[name.split("=", 1)[1]] = sorted(files)
    return out


def _assert_same_rows(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_compaction_keeps_rows_and_bounds_files(spark, workdir):
    root = f"{workdir}/t"
    src = _many_files(spark, root)
    before = _files_by_partition(root)
    plan = {r["ctl_validfrom"]: r for r in compaction_plan(spark, root, "ctl_validfrom", "date", START, TARGET).collect()}
    res = compact(spark, root, "ctl_validfrom", "date", START, TARGET, verify="checksum")
    assert res.strategy == "packed" and res.conflicts == []
    after = _files_by_partition(root)
    for value, files in after.items():
        d = dt.date.fromisoformat(value)
        if d >= START:
            assert 1 <= len(files) <= plan[d]["n_files"]
            assert len(files) < len(before[value])
        else:
            assert files == before[value]  # untouched below the start date
    back = spark.read.parquet(root)
    _assert_same_rows(back.select(*src.columns), src)
    # no staging or backup left next to the table
    assert [n for n in os.listdir(os.path.dirname(local_path(root))) if n.startswith("t__")] == []


def test_start_date_is_inclusive(spark, workdir):
    root = f"{workdir}/t"
    _many_files(spark, root)
    values = {r["ctl_validfrom"] for r in compaction_plan(spark, root, "ctl_validfrom", "date", START, TARGET).collect()}
    assert START in values and min(values) == START


def test_exact_multiple_gets_one_more_file(spark):
    df = spark.createDataFrame([(0,), (99,), (100,), (250,)], "bytes long")
    got = [r[0] for r in df.select(files_for("bytes", 100)).collect()]
    assert got == [1, 1, 2, 3]


def test_flat_directory_with_trailing_slash(spark, workdir):
    root = f"{workdir}/flat/"
    src = table(spark, SF_SMALL, "lineitem")
    src.repartition(10, "l_orderkey").write.parquet(root)
    res = compact_directory(spark, root, TARGET, verify="checksum")
    files = [f for f in os.listdir(local_path(root)) if f.endswith(".parquet")]
    assert len(files) <= res.plan[0]["n_files"] < 10
    _assert_same_rows(spark.read.parquet(root), src)


class _FailingFS(HadoopFS):
    """Fails the rename that installs the second staged partition."""

    def __init__(self, spark):
        super().__init__(spark)
        self.calls = 0

    def rename(self, src, dst):
        self.calls += 1
        if self.calls == 4:
            raise OSError("injected failure")
        super().rename(src, dst)


def test_swap_failure_restores_source(spark, workdir):
    root = f"{workdir}/t"
    src = _many_files(spark, root)
    before = _files_by_partition(root)
    with pytest.raises(OSError):
        compact(spark, root, "ctl_validfrom", "date", START, TARGET, _fs=_FailingFS(spark))
    assert _files_by_partition(root) == before
    spark.catalog.refreshByPath(root)
    _assert_same_rows(spark.read.parquet(root).select(*src.columns), src)


def test_rowless_file_partition_is_left_alone(spark, workdir):
    root = f"{workdir}/t"
    src = _many_files(spark, root, n=4)
    empty = lineitem_by_year(spark, SF_SMALL).limit(0).drop("ctl_validfrom")
    empty.coalesce(1).write.parquet(f"{root}/ctl_validfrom=2005-01-01")
    res = compact(spark, root, "ctl_validfrom", "date", START, TARGET)
    assert dt.date(2005, 1, 1) in {p["ctl_validfrom"] for p in res.plan}
    _assert_same_rows(spark.read.parquet(root).select(*src.columns), src)


def test_nothing_to_do_returns_empty_plan(spark, workdir):
    root = f"{workdir}/t"
    _many_files(spark, root, n=2)
    res = compact(spark, root, "ctl_validfrom", "date", dt.date(2100, 1, 1), TARGET)
    assert res.plan == [] and res.swapped == []


def _plan_nodes(spark, root, values):
    """Physical operators of the rewrite of ``values`` one-file partitions."""
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "p string, id int")
    df.repartition(8, "id").write.partitionBy("p").parquet(root)
    plan = [r.asDict() for r in compaction_plan(spark, root, "p", "string", None, TARGET).collect()]
    assert len(plan) == len(values)
    schema = df.select("id", "p").schema
    data = _scan(spark, root, [f"{root}/{r['fragment']}" for r in plan], schema)
    rows = _rewritten(lambda _: data, plan, ["p"], "salted")
    text = rows._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?m)^[\s:+*()0-9-]*([A-Z]\w+)", text), rows, plan


def test_rewrite_plan_size_does_not_grow_with_partitions(spark, workdir):
    few, _, _ = _plan_nodes(spark, f"{workdir}/few", [f"v{i}" for i in range(10)])
    many, rows, plan = _plan_nodes(spark, f"{workdir}/many", [f"v{i}" for i in range(120)])
    assert few == many and "Union" not in many
    selected = {f"/{r['fragment']}/" for r in plan}
    files = rows.inputFiles()
    assert files and all(any(sel in f for sel in selected) for f in files)
    assert not any("Python" in node for node in many)


def test_no_bound_on_reducers_or_partitions():
    from martlet.operators import compact as C

    assert not [n for n in dir(C) if n.startswith("MAX_")]


def test_verify_error_keeps_source(spark, workdir, monkeypatch):
    root = f"{workdir}/t"
    _many_files(spark, root, n=4)
    before = _files_by_partition(root)
    from pyspark.sql import Observation

    from martlet.operators import compact as C

    class OneRowMissing(Observation):
        @property
        def get(self):
            got = dict(Observation.get.fget(self))
            got["rows"] += 1
            return got

    monkeypatch.setattr(C, "Observation", OneRowMissing)
    with pytest.raises(CompactionVerifyError):
        C.compact(spark, root, "ctl_validfrom", "date", START, TARGET)
    assert _files_by_partition(root) == before
    parent = os.path.dirname(local_path(root))
    assert [n for n in os.listdir(parent) if n.startswith("t__")] == []


def test_rebalance_strategy_keeps_rows(spark, workdir):
    root = f"{workdir}/t"
    src = _many_files(spark, root, n=6)
    res = compact(spark, root, "ctl_validfrom", "date", START, TARGET, strategy="rebalance", verify="checksum")
    assert res.strategy == "rebalance"
    _assert_same_rows(spark.read.parquet(root).select(*src.columns), src)


def test_recover_after_driver_loss_mid_swap(spark, workdir):
    from martlet.operators.compact import recover_interrupted_swap

    root = f"{workdir}/t"
    src = _many_files(spark, root)

    class DriverDies(HadoopFS):
        calls = 0

        def rename(self, a, b):
            DriverDies.calls += 1
            if DriverDies.calls == 4:  # second partition moved to backup, new not installed
                raise SystemExit("driver lost")
            super().rename(a, b)

        def delete(self, path, recursive=True):  # a dead driver restores nothing
            return False

    fs = DriverDies(spark)
    with pytest.raises(SystemExit):
        compact(spark, root, "ctl_validfrom", "date", START, TARGET, _fs=fs)
    recover_interrupted_swap(spark, root)
    _assert_same_rows(spark.read.parquet(root).select(*src.columns), src)
    parent = os.path.dirname(local_path(root))
    assert [n for n in os.listdir(parent) if n.startswith("t__")] == []


def test_rewrite_job_count_does_not_grow_with_partitions(spark, workdir):
    counts = []
    for start in (dt.date(2001, 1, 1), dt.date(1995, 1, 1)):  # 1 partition, then all 7
        root = f"{workdir}/t{start.year}"
        _many_files(spark, root, n=6)
        res = compact(spark, root, "ctl_validfrom", "date", start, TARGET)
        counts.append((len(res.plan), res.rewrite_jobs))
    assert counts[0][0] == 1 and counts[1][0] == 7
    # one job per adaptive query stage (broadcast, shuffle map, write)
    assert counts[0][1] == counts[1][1]
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_salted_spreads_copies_of_one_row(spark, workdir):
    root = f"{workdir}/copies"
    base = table(spark, SF_SMALL, "lineitem")
    one = base.limit(1).collect()[0].asDict()
    copies = base.where(F.col("l_linenumber") <= 3).select(
        *[F.lit(v).cast(base.schema[k].dataType).alias(k) for k, v in one.items()]
    )
    n_copies = copies.count()
    base.unionByName(copies).repartition(10, "l_orderkey").write.parquet(root)
    res = compact_directory(spark, root, TARGET, strategy="salted", verify="checksum")
    assert res.plan[0]["n_files"] > 2
    per_file = (
        spark.read.parquet(root).where(F.col("l_orderkey") == one["l_orderkey"])
        .where(F.col("l_partkey") == one["l_partkey"]).where(F.col("l_linenumber") == one["l_linenumber"])
        .groupBy(F.input_file_name()).count().collect()
    )
    assert len(per_file) > 1 and max(r[1] for r in per_file) < n_copies


def test_failed_rewrite_leaves_source_and_no_staging(spark, workdir, monkeypatch):
    root = f"{workdir}/t"
    src = _many_files(spark, root, n=4)
    before = _files_by_partition(root)
    from martlet.operators import compact as C

    original = C._rewritten

    def failing(*args, **kwargs):
        df = original(*args, **kwargs)
        return df.withColumn(
            "l_tax", F.when(F.col("l_linenumber") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("l_tax"))
        )

    monkeypatch.setattr(C, "_rewritten", failing)
    with pytest.raises(Exception):
        C.compact(spark, root, "ctl_validfrom", "date", START, TARGET)
    assert _files_by_partition(root) == before
    parent = os.path.dirname(local_path(root))
    assert [n for n in os.listdir(parent) if n.startswith("t__")] == []
    spark.catalog.refreshByPath(root)
    _assert_same_rows(spark.read.parquet(root).select(*src.columns), src)


def test_block_size_target(spark, workdir):
    root = f"{workdir}/t"
    _many_files(spark, root, n=4)
    block = HadoopFS(spark).default_block_size(root)
    plan = compaction_plan(spark, root, "ctl_validfrom", "date", START, None).collect()
    assert block > 0 and all(p["n_files"] == p["bytes"] // block + 1 for p in plan)


def test_recover_flat_folder_after_driver_loss(spark, workdir):
    from martlet.operators.compact import recover_interrupted_swap

    root = f"{workdir}/flat"
    src = table(spark, SF_SMALL, "lineitem")
    src.repartition(8, "l_orderkey").write.parquet(root)

    class DriverDies(HadoopFS):
        calls = 0

        def rename(self, a, b):
            DriverDies.calls += 1
            if DriverDies.calls == 2:  # folder moved to backup, staged copy not installed
                raise SystemExit("driver lost")
            super().rename(a, b)

        def delete(self, path, recursive=True):
            return False

    with pytest.raises(SystemExit):
        compact_directory(spark, root, TARGET, _fs=DriverDies(spark))
    assert not os.path.exists(local_path(root))
    assert recover_interrupted_swap(spark, root) == [root]
    _assert_same_rows(spark.read.parquet(root), src)
    parent = os.path.dirname(local_path(root))
    assert [n for n in os.listdir(parent) if n.startswith("flat__")] == []


def _names(root):
    return sorted(n for n in os.listdir(local_path(root)) if "=" in n)


def test_columns_of_one_partition_only_are_kept(spark, workdir):
    for with_table in (False, True):
        root = f"{workdir}/t{with_table}"
        spark.range(100).write.parquet(f"{root}/d=2021-01-01")
        spark.range(100).selectExpr("id", "id AS extra").repartition(4).write.parquet(f"{root}/d=2021-01-02")
        table_name = None
        if with_table:
            table_name = f"evolved_{os.path.basename(workdir).replace('-', '_')}"
            spark.sql(f"CREATE TABLE {table_name} (id bigint, extra bigint, d date) USING parquet PARTITIONED BY (d) LOCATION '{root}'")
            spark.sql(f"MSCK REPAIR TABLE {table_name}")
        compact(spark, root, "d", "date", verify="checksum", table=table_name)
        back = spark.table(table_name) if with_table else spark.read.option("mergeSchema", "true").parquet(root)
        assert back.agg(F.count("id"), F.count("extra"), F.sum("extra")).first() == (200, 100, 4950)


def test_undeclared_and_conflicting_columns_raise(spark, workdir):
    root = f"{workdir}/t"
    spark.range(10).selectExpr("id", "id AS extra").write.parquet(f"{root}/d=2021-01-01")
    name = f"narrow_{os.path.basename(workdir).replace('-', '_')}"
    spark.sql(f"CREATE TABLE {name} (id bigint, d date) USING parquet PARTITIONED BY (d) LOCATION '{root}'")
    with pytest.raises(CompactionSchemaError):
        compact(spark, root, "d", "date", table=name)
    spark.range(10).selectExpr("id", "cast(id AS string) AS extra").write.parquet(f"{root}/d=2021-01-02")
    with pytest.raises(CompactionSchemaError):
        compact(spark, root, "d", "date")
    assert spark.read.parquet(f"{root}/d=2021-01-01").count() == 10


def test_partitioned_layout_survives_without_a_column(spark, workdir):
    root = f"{workdir}/t"
    df = spark.range(100).selectExpr("id", "date_add(date'2021-01-01', cast(id % 2 AS int)) AS d", "cast(id % 3 AS int) AS h")
    df.repartition(4).write.partitionBy("d", "h").parquet(root)
    for kwargs in ({}, {"partition_column": "d", "partition_type": "date"}, {"partition_column": "h", "partition_type": "int"}):
        res = compact(spark, root, verify="checksum", **kwargs)
        assert len(res.swapped) == 6
        _assert_same_rows(spark.read.parquet(root).select("id", "d", "h"), df)
        assert all(len([f for _, _, fs in os.walk(local_path(f"{root}/{r['fragment']}")) for f in fs if f.endswith(".parquet")]) == 1 for r in res.plan)
    with pytest.raises(CompactionLayoutError):
        compact(spark, root, "other", "int")
    bounded = compaction_plan(spark, root, "h", "int", 2, TARGET).collect()
    assert sorted({r["h"] for r in bounded}) == [2] and len(bounded) == 2


def test_mixed_layout_raises(spark, workdir):
    root = f"{workdir}/t"
    spark.range(5).write.parquet(f"{root}/d=1")
    spark.range(5).write.parquet(f"{root}/e=1")
    with pytest.raises(CompactionLayoutError):
        compact(spark, root)


@pytest.mark.parametrize("when", ["before", "during"])
def test_rows_appended_during_compaction_are_kept(spark, workdir, when):
    root = f"{workdir}/t"
    spark.range(100).selectExpr("id", "date'2021-01-01' AS d").repartition(4).write.partitionBy("d").parquet(root)
    spark.range(100).selectExpr("id", "date'2021-01-02' AS d").repartition(4).write.mode("append").partitionBy("d").parquet(root)

    class Appends(HadoopFS):
        def __init__(self, spark):
            super().__init__(spark)
            self.done = False

        def append(self, where):
            self.done = True
            spark.range(50).write.mode("append").parquet(where)

        def rename(self, src, dst):
            super().rename(src, dst)
            if when == "during" and "__backup_" in dst and "2021-01-01" in dst and not self.done:
                self.append(dst)  # a writer that listed the folder before the rename

    fs = Appends(spark)
    if when == "before":
        from martlet.operators import compact as C

        original = C._footer_rows
        calls = []

        def counted(*args):
            calls.append(1)
            out = original(*args)
            if len(calls) == 2:
                fs.append(f"{root}/d=2021-01-01")
            return out

        C._footer_rows = counted
    try:
        res = compact(spark, root, "d", "date", _fs=fs)
    finally:
        if when == "before":
            C._footer_rows = original
    assert fs.done and [c.rsplit("/", 1)[1] for c in res.conflicts] == ["d=2021-01-01"]
    assert [t.rsplit("/", 1)[1] for t in res.swapped] == ["d=2021-01-02"]
    spark.catalog.refreshByPath(root)
    assert spark.read.parquet(root).count() == 250
    assert [n for n in os.listdir(os.path.dirname(local_path(root))) if n.startswith("t__")] == []


def test_null_odd_and_short_named_partitions(spark, workdir):
    root = f"{workdir}/t"
    df = spark.createDataFrame([(i, v) for i in range(40) for v in (None, "a%b c+d=e/f", "x:y", "é")], "id int, p string")
    df.repartition(4, "id").write.partitionBy("p").parquet(root)
    names = _names(root)
    res = compact(spark, root, "p", "string", verify="checksum")
    assert len(res.swapped) == 4 and _names(root) == names
    _assert_same_rows(spark.read.parquet(root).select("id", "p"), df)
    short = f"{workdir}/short"
    for name in ("2021-10-25", "2021-10-25 00%3A00%3A00"):
        spark.range(10).repartition(3).write.parquet(f"{short}/d={name}")
    assert len(compact(spark, short, "d", "timestamp").swapped) == 2
    assert len(_names(short)) == 2 and spark.read.parquet(short).count() == 20


def test_timestamp_partitions_under_another_session_time_zone(spark, workdir):
    root = f"{workdir}/t"
    df = spark.range(60).selectExpr("id", "timestamp'2021-01-01 05:00:00' + make_interval(0, 0, 0, cast(id % 2 AS int)) AS d")
    df.repartition(4).write.partitionBy("d").parquet(root)
    names = _names(root)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = compact(spark, root, "d", "timestamp", verify="checksum")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert res.rows_source == 60 and len(res.swapped) == 2 and _names(root) == names


def test_nested_maps_are_in_the_checksum(spark, workdir):
    root = f"{workdir}/t"
    spark.range(30).selectExpr("id", "map('k', id) AS m", "array(named_struct('x', map(id, 'v'))) AS n").repartition(5).write.parquet(root)
    compact_directory(spark, root, verify="checksum")
    assert spark.read.parquet(root).selectExpr("sum(m['k'])").first()[0] == 435


def test_recover_nested_partitions(spark, workdir):
    from martlet.operators.compact import recover_interrupted_swap

    root = f"{workdir}/t"
    df = spark.range(100).selectExpr("id", "cast(id % 2 AS int) AS a", "cast(id % 3 AS int) AS b")
    df.repartition(4).write.partitionBy("a", "b").parquet(root)

    class DriverDies(HadoopFS):
        calls = 0

        def rename(self, src, dst):
            DriverDies.calls += 1
            if DriverDies.calls >= 6:
                raise SystemExit("driver lost")
            super().rename(src, dst)

        def delete(self, path, recursive=True):
            return False

    with pytest.raises(SystemExit):
        compact(spark, root, _fs=DriverDies(spark))
    recover_interrupted_swap(spark, root)
    _assert_same_rows(spark.read.parquet(root).select("id", "a", "b"), df)


def test_hidden_entries_are_skipped(spark, workdir):
    root = f"{workdir}/t"
    spark.range(20).selectExpr("id", "id % 2 AS p").repartition(3).write.partitionBy("p").parquet(root)
    fs = HadoopFS(spark)
    for name in ("p=0/_temporary/x.parquet", "p=0/.hidden", "_SUCCESS", "_delta/z", ".staging/y"):
        fs.touch(f"{root}/{name}")
    plan = compaction_plan(spark, root, "p", "int", None, TARGET).collect()
    assert sorted((r["p"], r["files"]) for r in plan) == [(0, 3), (1, 3)]
    assert sorted(r["fragment"] for r in compaction_plan(spark, root).collect()) == ["p=0", "p=1"]


def test_row_groups_follow_the_target(spark, workdir):
    import pyarrow.parquet as pq

    root = f"{workdir}/flat"
    spark.range(400_000).selectExpr("id", "uuid() AS u").repartition(6).write.parquet(root)
    compact_directory(spark, root, 2 * 1024 * 1024)
    files = [f for f in os.listdir(local_path(root)) if f.endswith(".parquet")]
    groups = [pq.ParquetFile(f"{local_path(root)}/{f}").metadata.num_row_groups for f in files]
    assert len(files) > 4 and max(groups) <= 3


# -- packing, isolation, journal ----------------------------------------------------
def _packed_rows(spark, root, target=TARGET):
    from martlet.operators.compact import _scan_rows, packing_session

    plan = [r.asDict() | {"path": f"{root}/{r['fragment']}"} for r in compaction_plan(spark, root, "ctl_validfrom", "date", None, target).collect()]
    schema = lineitem_by_year(spark, SF_SMALL).drop("ctl_validfrom").schema.add("ctl_validfrom", "string")
    session = packing_session(spark, target)
    return _rewritten(lambda some: _scan_rows(session, some, ["ctl_validfrom"], schema), plan, ["ctl_validfrom"], "packed"), plan


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_packed_rewrite_moves_no_rows(spark, workdir, threshold):
    """No exchange, join or sort of data, broadcast or not; one task a file."""
    root = f"{workdir}/t"
    _many_files(spark, root)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows, plan = _packed_rows(spark, root)
        text = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.search(r"Exchange|Join|Sort|Python", text) and "Coalesce" in text
    tasks = rows.select(F.spark_partition_id().alias("p"), "ctl_validfrom").distinct().groupBy("p").count().collect()
    assert all(t["count"] == 1 for t in tasks)
    assert rows.rdd.getNumPartitions() <= sum(p["n_files"] for p in plan)


def test_salted_rewrite_shuffles_once_without_broadcast_by_size(spark, workdir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, rows, _ = _plan_nodes(spark, f"{workdir}/s", [f"v{i}" for i in range(10)])
        text = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", text)) == 1
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_packing_keeps_large_files_apart_and_cuts_what_is_beyond_the_target(spark, workdir):
    root = f"{workdir}/t"
    small = spark.range(2000).selectExpr("id", "uuid() AS u")
    for i in range(6):
        small.coalesce(1).write.mode("append").parquet(f"{root}/p=1")
    big = spark.range(200_000).selectExpr("id", "uuid() AS u").coalesce(1)
    big.write.option("parquet.block.size", str(1024 * 1024)).parquet(f"{root}/p=2")
    target = 2 * 1024 * 1024
    res = compact(spark, root, "p", "int", None, target, verify="checksum")
    files = {p["p"]: len([f for f in os.listdir(local_path(f"{root}/{p['fragment']}")) if f.endswith(".parquet")]) for p in res.plan}
    planned = {p["p"]: p["n_files"] for p in res.plan}
    assert files[1] == 1 and 2 < files[2] <= planned[2]
    assert spark.read.parquet(root).count() == 212_000


def _corrupt(spark, root, fragment):
    spark.createDataFrame([("not parquet",)], "value string").coalesce(1).write.mode("append").text(f"{root}/{fragment}")


def test_isolated_partitions_do_not_stop_the_others(spark, workdir):
    root = f"{workdir}/t"
    src = _many_files(spark, root)
    _corrupt(spark, root, "ctl_validfrom=1996-01-01")
    before = _files_by_partition(root)
    with pytest.raises(Exception):
        compact(spark, root, "ctl_validfrom", "date", None, TARGET)
    assert _files_by_partition(root) == before
    res = compact(spark, root, "ctl_validfrom", "date", None, TARGET, on_error="isolate", verify="checksum")
    assert [p.rsplit("=", 1)[1] for p in res.quarantined] == ["1996-01-01"] and len(res.swapped) == len(before) - 1
    after = _files_by_partition(root)
    assert after["1996-01-01"] == before["1996-01-01"]
    sound = spark.read.parquet(*[f"{root}/ctl_validfrom={d}" for d in after if d != "1996-01-01"])
    assert sound.count() == src.where("year(ctl_validfrom) <> 1996").count()


def test_damage_that_only_the_rewrite_finds_is_isolated(spark, workdir):
    """The footer is sound, the pages are not."""
    root = f"{workdir}/t"
    spark.range(60_000).selectExpr("id", "uuid() AS u", "id % 6 AS p").repartition(3).write.partitionBy("p").parquet(root)
    folder = local_path(f"{root}/p=4")
    name = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(f"{folder}/{name}", "r+b") as f:
        f.seek(64)
        f.write(os.urandom(2000))
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    spark.catalog.refreshByPath(root)
    res = compact(spark, root, "p", "int", None, TARGET, on_error="isolate")
    assert [q.rsplit("=", 1)[1] for q in res.quarantined] == ["4"] and len(res.swapped) == 5
    assert name in os.listdir(folder)


def test_type_clashes_are_rewritten_by_kind_or_set_aside(spark, workdir):
    root = f"{workdir}/t"
    for i in range(3):
        spark.range(10).selectExpr("id", "id AS x").repartition(3).write.parquet(f"{root}/d=2021-01-0{i + 1}")
    spark.range(10).selectExpr("id", "cast(id AS string) AS x").repartition(3).write.parquet(f"{root}/d=2021-01-04")
    res = compact(spark, root, "d", "date", on_error="isolate")
    assert len(res.swapped) == 4 and res.quarantined == {}
    assert dict(spark.read.parquet(f"{root}/d=2021-01-04").dtypes)["x"] == "string"
    name = f"clash_{os.path.basename(workdir).replace('-', '_')}"
    spark.sql(f"CREATE TABLE {name} (id bigint, x bigint, d date) USING parquet PARTITIONED BY (d) LOCATION '{root}'")
    res = compact(spark, root, "d", "date", table=name, on_error="isolate")
    assert [q.rsplit("=", 1)[1] for q in res.quarantined] == ["2021-01-04"] and len(res.swapped) == 3
    assert "CompactionSchemaError" in next(iter(res.quarantined.values()))


def test_all_partitions_failing_is_an_error(spark, workdir):
    root = f"{workdir}/t"
    spark.range(10).write.parquet(f"{root}/d=2021-01-01")
    _corrupt(spark, root, "d=2021-01-01")
    with pytest.raises(Exception):
        compact(spark, root, "d", "date", on_error="isolate")


def test_waves_bound_partitions_and_files():
    from martlet.operators.compact import _waves

    rows = [{"n_files": n} for n in (1, 1, 1, 5, 9, 30, 1)]
    assert [[r["n_files"] for r in w] for w in _waves(rows, 3, 10)] == [[1, 1, 1], [5], [9], [30], [1]]
    assert _waves([], 3, 10) == []


class _Dies(HadoopFS):
    """A driver that is lost at a given rename."""

    def __init__(self, spark, at):
        super().__init__(spark)
        self.at, self.calls = at, 0

    def rename(self, src, dst):
        self.calls += 1
        if self.calls >= self.at:
            raise SystemExit("driver lost")
        super().rename(src, dst)

    def delete(self, path, recursive=True):
        return super().delete(path, recursive) if self.calls < self.at else False


# Two renames a partition, two partitions a wave: 5 is between two waves, 6 amid a swap.
@pytest.mark.parametrize("at", [5, 6, 8])
def test_restart_goes_on_after_the_last_wave(spark, workdir, at):
    from martlet.operators.compact import read_journal

    root, journal = f"{workdir}/t", f"{workdir}/journal"
    src = _many_files(spark, root)
    with pytest.raises(SystemExit):
        compact(spark, root, "ctl_validfrom", "date", None, TARGET, journal=journal, wave_partitions=2, _fs=_Dies(spark, at))
    first = {r["fragment"] for r in read_journal(spark, journal).where("phase = 'published'").collect()}
    assert len(first) == 2
    res = compact(spark, root, "ctl_validfrom", "date", None, TARGET, journal=journal, wave_partitions=2, verify="checksum")
    assert {p.rsplit("/", 1)[1] for p in res.resumed} >= first and len(res.swapped) + len(res.resumed) == 7
    assert not {p.rsplit("/", 1)[1] for p in res.swapped} & first
    spark.catalog.refreshByPath(root)
    _assert_same_rows(spark.read.parquet(root).select(*src.columns), src)
    assert [n for n in os.listdir(local_path(workdir)) if n.startswith("t__")] == []
    again = compact(spark, root, "ctl_validfrom", "date", None, TARGET, journal=journal)
    assert again.swapped == [] and len(again.resumed) == 7
    # A partition that got new files since is compacted again.
    src.where("year(ctl_validfrom) = 1996").drop("ctl_validfrom").coalesce(1).write.mode("append").parquet(f"{root}/ctl_validfrom=1996-01-01")
    assert len(compact(spark, root, "ctl_validfrom", "date", None, TARGET, journal=journal).swapped) == 1

"""Snapshot load: lineage, idempotent reruns, static partition safety, guards."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from martlet.operators.load import EmptySourceError, force_load, load_snapshot
from martlet.plans.analogs import merchant_source, payroll_source
from martlet.plans.spec import merchant_spec, payroll_spec
from martlet.session import unique_name
from martlet.sources.hadoop_fs import HadoopFS

from conftest import SF_SMALL

D1 = dt.date(2021, 10, 24)
D2 = dt.date(2021, 10, 25)


def _spec(workdir, **kw):
    return payroll_spec(unique_name("pm"), f"{workdir}/pm", **kw)


def _counts(spark, spec):
    rows = spark.table(spec.table).groupBy(spec.partition_column).count().collect()
    return {r[0]: r[1] for r in rows}


def test_load_adds_lineage_and_keeps_rows(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    res = load_snapshot(spark, spec, src, loading_id=42, load_date=D2)
    expected_max = src.agg(F.max("ctl_loading")).first()[0]
    assert res.source_rows == src.count()
    assert res.src_loading_id == expected_max
    assert res.rows_written == res.source_rows
    out = spark.table(spec.table)
    assert out.count() == res.source_rows
    lineage = out.select("src_loading_id", "ctl_loading", "ctl_validfrom").distinct().collect()
    assert [tuple(r) for r in lineage] == [(expected_max, 42, D2)]
    assert out.schema["gosb_id"].dataType.simpleString() == "int"
    assert out.select(*spec.business_columns).exceptAll(src.select(*spec.business_columns)).count() == 0


def test_same_day_rerun_replaces_partition(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D2)
    load_snapshot(spark, spec, src, loading_id=2, load_date=D2)
    out = spark.table(spec.table)
    assert out.count() == src.count()
    assert [r[0] for r in out.select("ctl_loading").distinct().collect()] == [2]


def test_second_date_keeps_first_partition(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    n = src.count()
    load_snapshot(spark, spec, src, loading_id=1, load_date=D1)
    load_snapshot(spark, spec, src, loading_id=2, load_date=D2)
    assert _counts(spark, spec) == {D1: n, D2: n}


def test_empty_source_raises_and_keeps_old_partition(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D2)
    with pytest.raises(EmptySourceError):
        load_snapshot(spark, spec, src.limit(0), loading_id=2, load_date=D2)
    assert _counts(spark, spec) == {D2: src.count()}


def test_null_load_ids_raise(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL).withColumn("ctl_loading", F.lit(None).cast("bigint"))
    with pytest.raises(EmptySourceError):
        load_snapshot(spark, spec, src, loading_id=1, load_date=D2)


def test_allow_empty_replaces_with_empty_partition(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D2)
    load_snapshot(spark, spec, src.limit(0), loading_id=2, load_date=D2, allow_empty=True)
    assert spark.table(spec.table).count() == 0


def test_missing_or_extra_source_column_raises(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    with pytest.raises(Exception):
        load_snapshot(spark, spec, src.drop("amt"), loading_id=1, load_date=D2)
    from martlet.operators.load import check_columns

    with pytest.raises(ValueError):
        check_columns(src.withColumn("extra", F.lit(1)), list(src.columns))


def test_overflow_on_insert_raises(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL).withColumn(
        "gosb_id", (F.col("gosb_id").cast("bigint") + F.lit(10**12))
    )
    with pytest.raises(Exception):
        load_snapshot(spark, spec, src, loading_id=1, load_date=D2)


def test_timestamp_partition_is_selected_by_typed_value(spark, workdir):
    spec = _spec(workdir, partition_type=TimestampType())
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D2)
    out = spark.table(spec.table)
    assert out.where(F.col("ctl_validfrom") == F.lit("2021-10-25 00:00:00").cast("timestamp")).count() == src.count()


def test_merchant_load(spark, workdir):
    spec = merchant_spec(unique_name("mm"), f"{workdir}/mm")
    src = merchant_source(spark, SF_SMALL)
    res = load_snapshot(spark, spec, src, loading_id=7, load_date=D2, rebalance=False)
    assert spark.table(spec.table).count() == res.source_rows
    cols = [f.name for f in spark.table(spec.table).schema.fields]
    assert cols == ["merch_id", "inn", "gosb_id", "src_ctl_loading", "ctl_loading", "ctl_validfrom"]


def test_force_load_clears_every_partition(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=dt.date(2021, 10, 1))
    load_snapshot(spark, spec, src, loading_id=2, load_date=D1)
    force_load(spark, spec, src, loading_id=3, load_date=D2)
    spark.sql(spec.repair_statement())
    assert _counts(spark, spec) == {D2: src.count()}


def test_force_load_with_empty_source_leaves_mart(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D1)
    with pytest.raises(EmptySourceError):
        force_load(spark, spec, src.limit(0), loading_id=3, load_date=D2)
    assert _counts(spark, spec) == {D1: src.count()}


def test_failed_rerun_keeps_previous_rows(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D2)
    bad = src.withColumn(
        "amt", F.when(F.col("enrollment_type") == 3, F.raise_error(F.lit("bad row"))).otherwise(F.col("amt"))
    )
    with pytest.raises(Exception):
        load_snapshot(spark, spec, bad, loading_id=2, load_date=D2)
    spark.catalog.refreshTable(spec.table)
    assert _counts(spark, spec) == {D2: src.count()}
    assert [r[0] for r in spark.table(spec.table).select("ctl_loading").distinct().collect()] == [1]
    # the caller's session setting is left as it was
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_failed_force_load_leaves_mart(spark, workdir):
    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D1)
    bad = src.withColumn(
        "amt", F.when(F.col("enrollment_type") == 3, F.raise_error(F.lit("bad row"))).otherwise(F.col("amt"))
    )
    with pytest.raises(Exception):
        force_load(spark, spec, bad, loading_id=3, load_date=D2)
    spark.catalog.refreshTable(spec.table)
    assert _counts(spark, spec) == {D1: src.count()}


def test_copies_of_one_row_spread_over_tasks(spark, workdir):
    """A third of the source rows are copies of one row: they must not land in
    one task (a hash of the values would put them together)."""
    import os

    from martlet.session import local_path

    base = payroll_source(spark, SF_SMALL)
    one = base.limit(1).collect()[0].asDict()
    copies = base.where(F.col("enrollment_type") <= 2).select(
        *[F.lit(v).cast(base.schema[k].dataType).alias(k) for k, v in one.items()]
    )
    n_copies = copies.count()
    src_path = f"{workdir}/src"
    base.unionByName(copies).repartition(8, "epk_id").write.parquet(src_path)
    spec = _spec(workdir)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        load_snapshot(spark, spec, spark.read.parquet(src_path), loading_id=1, load_date=D2, rebalance=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    per_file = (
        spark.table(spec.table).where(F.col("epk_id") == one["epk_id"]).where(F.col("amt") == one["amt"])
        .groupBy(F.input_file_name()).count().collect()
    )
    assert sum(r[1] for r in per_file) >= n_copies
    assert len(per_file) > 1 and max(r[1] for r in per_file) < n_copies
    part = local_path(f"{spec.location}/ctl_validfrom=2021-10-25")
    assert len([f for f in os.listdir(part) if f.endswith(".parquet")]) > 1


def test_path_source_facts_come_from_footers(spark, workdir):
    from martlet.operators.load import footer_session, source_facts

    path = f"{workdir}/src"
    payroll_source(spark, SF_SMALL).repartition(3, "epk_id").write.parquet(path)
    from martlet.sources.tables import read_source

    facts = source_facts(read_source(footer_session(spark), path), "ctl_loading")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "BatchScan" in line]
    assert scan and "max(ctl_loading)" in scan[0] and "count(" in scan[0]  # footers answer it
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    spec = _spec(workdir)
    res = load_snapshot(spark, spec, path, loading_id=9, load_date=D2)
    src = spark.read.parquet(path)
    assert res.source_rows == src.count()
    assert res.src_loading_id == src.agg(F.max("ctl_loading")).first()[0]
    assert res.rows_written == res.source_rows


def test_parallel_loads_in_one_session(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor

    src = payroll_source(spark, SF_SMALL)
    specs = [payroll_spec(unique_name(f"par{i}"), f"{workdir}/par{i}") for i in range(3)]
    with ThreadPoolExecutor(max_workers=3) as pool:
        results = list(pool.map(
            lambda sp: load_snapshot(spark, sp, src, loading_id=5, load_date=D2), specs
        ))
    n = src.count()
    assert [r.rows_written for r in results] == [n, n, n]
    assert all(spark.table(sp.table).count() == n for sp in specs)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_facts_of_a_name_come_from_the_callers_session(spark, workdir):
    from martlet.operators.load import facts_of

    db = unique_name("db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{workdir}/db'")
    name = unique_name("src")
    spark.range(1000).withColumnRenamed("id", "ctl_loading").write.saveAsTable(f"{db}.{name}")
    spark.range(7).withColumnRenamed("id", "ctl_loading").write.saveAsTable(f"default.{name}")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(db)
    try:
        assert tuple(facts_of(spark, name, "ctl_loading")) == (1000, 999)
        spark.range(50).withColumnRenamed("id", "ctl_loading").createOrReplaceTempView(name)
        assert tuple(facts_of(spark, name, "ctl_loading")) == (50, 49)
    finally:
        spark.catalog.dropTempView(name)
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {db} CASCADE")
        spark.sql(f"DROP TABLE default.{name}")


def test_default_load_plan_has_no_exchange(spark, workdir):
    from martlet.operators.load import snapshot_rows

    rows = snapshot_rows(payroll_source(spark, SF_SMALL), _spec(workdir), 1, 2)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_changed_source_raises(spark, workdir):
    from martlet.operators.load import SourceChangedError

    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    facts = Row(source_rows=src.count() + 5, src_loading_id=1)
    with pytest.raises(SourceChangedError):
        load_snapshot(spark, spec, src, loading_id=1, load_date=D2, pinned=(src, facts))


def test_reload_replaces_a_short_named_timestamp_directory(spark, workdir):
    import os

    from martlet.session import local_path

    spec = _spec(workdir, partition_type=TimestampType())
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D2)
    root = local_path(spec.location)
    full = f"{root}/ctl_validfrom=2021-10-25 00%3A00%3A00"
    os.rename(full, f"{root}/ctl_validfrom=2021-10-25")
    spark.sql(spec.repair_statement())
    load_snapshot(spark, spec, src, loading_id=2, load_date=D2)
    out = spark.table(spec.table)
    assert out.count() == src.count() and out.select("ctl_loading").distinct().count() == 1
    assert [n for n in os.listdir(root) if "=" in n] == [os.path.basename(full)]


def test_force_load_drops_the_null_partition(spark, workdir):
    import os

    from martlet.session import local_path

    spec = _spec(workdir)
    src = payroll_source(spark, SF_SMALL)
    load_snapshot(spark, spec, src, loading_id=1, load_date=D1)
    root = local_path(spec.location)
    os.rename(f"{root}/ctl_validfrom={D1}", f"{root}/ctl_validfrom=__HIVE_DEFAULT_PARTITION__")
    spark.sql(spec.repair_statement())
    force_load(spark, spec, src, loading_id=2, load_date=D2)
    assert _counts(spark, spec) == {D2: src.count()}
    assert [n for n in os.listdir(root) if "=" in n] == [f"ctl_validfrom={D2}"]


# -- pinned sources, names of the date ------------------------------------------------
def _rows(spark, lo, hi, load_id):
    return spark.range(lo, hi).selectExpr(
        "id AS epk_id", "id AS inn", "1 AS gosb_id", "2 AS enrollment_type", "id AS amt", "'2021-01-01' AS report_dt", f"{load_id}L AS ctl_loading"
    )


def test_facts_and_rows_come_from_one_listing(spark, workdir):
    from martlet.operators.load import pinned_source

    path = f"{workdir}/source"
    _rows(spark, 0, 100, 7).write.partitionBy("gosb_id").parquet(path)
    src, facts = pinned_source(spark, path, "ctl_loading")
    _rows(spark, 100, 150, 8).write.mode("append").partitionBy("gosb_id").parquet(path)
    assert tuple(facts) == (100, 7) and src.count() == 100
    spec = payroll_spec(unique_name("pin"), f"{workdir}/pin")
    res = load_snapshot(spark, spec, path, loading_id=1, load_date="2021-10-25", pinned=(src, facts))
    assert (res.rows_written, res.src_loading_id) == (100, 7)
    assert load_snapshot(spark, spec, path, loading_id=2, load_date="2021-10-25").rows_written == 150


def test_source_replaced_by_as_many_rows_raises(spark, workdir):
    from martlet.operators.load import SourceChangedError, pinned_source

    path = f"{workdir}/source"
    _rows(spark, 0, 100, 7).coalesce(1).write.parquet(path)
    src, facts = pinned_source(spark, path, "ctl_loading")
    _rows(spark, 0, 100, 9).createOrReplaceTempView("swapped_source")
    spec = payroll_spec(unique_name("rep"), f"{workdir}/rep")
    with pytest.raises(SourceChangedError):
        load_snapshot(spark, spec, "swapped_source", loading_id=1, load_date="2021-10-25", pinned=(spark.table("swapped_source"), facts))
    spark.catalog.dropTempView("swapped_source")


def test_only_names_of_the_date_are_listed(spark, workdir):
    from martlet.operators.load import _same_date_files
    from martlet.plans.spec import ensure_table
    from pyspark.sql.types import TimestampType

    spec = payroll_spec(unique_name("names"), f"{workdir}/names", partition_type=TimestampType())
    ensure_table(spark, spec)
    fs = HadoopFS(spark)
    for name in ("2021-01-05", "2021-1-5", "2021-01-05 00%3A00%3A00", "2021-01-05 00%3A00%3A00.0", "2021-01-05 01%3A00%3A00", "2021-01-15", "2021-1-50", "x"):
        fs.touch(f"{workdir}/names/ctl_validfrom={name}/part-0")
    found = _same_date_files(spark, spec, dt.date(2021, 1, 5))
    assert sorted(found) == [f"ctl_validfrom={n}" for n in ("2021-01-05", "2021-01-05 00%3A00%3A00", "2021-01-05 00%3A00%3A00.0", "2021-1-5")]

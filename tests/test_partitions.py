"""Partition lifecycle: typed selection, open-interval retention, drop with purge."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from martlet.operators.partitions import (
    apply_retention,
    apply_retention_to_path,
    catalog_partitions,
    drop_all_partitions,
    drop_partitions,
    partition_row_counts,
)
from martlet.plans.analogs import lineitem_by_year
from martlet.plans.spec import recreate, spec_for_frame
from martlet.session import local_path, unique_name
from martlet.sources.hadoop_fs import HadoopFS
from martlet.sources.files import list_partition_files, partition_value_from_path

from conftest import SF_SMALL


def _year_table(spark, workdir):
    df = lineitem_by_year(spark, SF_SMALL)
    df.write.partitionBy("ctl_validfrom").parquet(f"{workdir}/y")
    spec = spec_for_frame(df, unique_name("y"), f"{workdir}/y")
    recreate(spark, spec)
    return spec, df


def _dates(spark, spec):
    return sorted(r[0] for r in partition_row_counts(spark.table(spec.table), spec.partition_column).collect())


def test_catalog_partitions_are_typed(spark, workdir):
    spec, df = _year_table(spark, workdir)
    parts = catalog_partitions(spark, spec.table, "ctl_validfrom", "date")
    assert parts.schema["ctl_validfrom"].dataType.simpleString() == "date"
    assert sorted(r[0] for r in parts.select("ctl_validfrom").collect()) == sorted(
        r[0] for r in df.select("ctl_validfrom").distinct().collect()
    )


def test_retention_excludes_both_ends(spark, workdir):
    spec, df = _year_table(spark, workdir)
    all_dates = _dates(spark, spec)
    dropped = apply_retention(spark, spec, dt.date(1996, 1, 1), dt.date(1999, 1, 1))
    assert dropped == ["ctl_validfrom=1997-01-01", "ctl_validfrom=1998-01-01"]
    recreate(spark, spec)  # files gone: a repair does not bring them back
    kept = _dates(spark, spec)
    assert kept == [d for d in all_dates if not (dt.date(1996, 1, 1) < d < dt.date(1999, 1, 1))]
    assert dt.date(1996, 1, 1) in kept and dt.date(1999, 1, 1) in kept


def test_retention_open_bounds(spark, workdir):
    spec, _ = _year_table(spark, workdir)
    apply_retention(spark, spec, None, dt.date(1997, 1, 1))
    assert min(_dates(spark, spec)) == dt.date(1997, 1, 1)
    apply_retention(spark, spec, dt.date(2000, 1, 1), "")
    assert max(_dates(spark, spec)) == dt.date(2000, 1, 1)


def test_drop_without_purge_comes_back_on_repair(spark, workdir):
    spec, _ = _year_table(spark, workdir)
    doomed = catalog_partitions(spark, spec.table, "ctl_validfrom", "date").where(
        F.col("ctl_validfrom") == F.lit("1995-01-01").cast("date")
    )
    drop_partitions(spark, spec, doomed, purge=False)
    assert dt.date(1995, 1, 1) not in _dates(spark, spec)
    spark.sql(spec.repair_statement())
    spark.catalog.refreshTable(spec.table)
    assert dt.date(1995, 1, 1) in _dates(spark, spec)


def test_drop_then_repair_stays_gone_with_purge(spark, workdir):
    spec, _ = _year_table(spark, workdir)
    doomed = catalog_partitions(spark, spec.table, "ctl_validfrom", "date").where(
        F.col("ctl_validfrom") == F.lit("1995-01-01").cast("date")
    )
    drop_partitions(spark, spec, doomed, purge=True)
    recreate(spark, spec)
    assert dt.date(1995, 1, 1) not in _dates(spark, spec)
    assert not os.path.exists(local_path(f"{spec.location}/ctl_validfrom=1995-01-01"))


def test_drop_all_partitions(spark, workdir):
    spec, _ = _year_table(spark, workdir)
    drop_all_partitions(spark, spec)
    recreate(spark, spec)
    assert spark.table(spec.table).count() == 0


def test_retention_on_bare_path(spark, workdir):
    root = f"{workdir}/bare"
    lineitem_by_year(spark, SF_SMALL).write.partitionBy("ctl_validfrom").parquet(root)
    gone = apply_retention_to_path(spark, root, "ctl_validfrom", "1996-01-01", "1999-01-01")
    assert gone == ["ctl_validfrom=1997-01-01", "ctl_validfrom=1998-01-01"]
    left = sorted(n for n in os.listdir(local_path(root)) if n.startswith("ctl_validfrom="))
    assert "ctl_validfrom=1997-01-01" not in left and "ctl_validfrom=1996-01-01" in left


def test_odd_partition_values_round_trip(spark, workdir):
    root = f"{workdir}/odd"
    values = ["a=b", "50%", "x y", "c+d", None, "é:1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, k string")
    df.write.partitionBy("k").parquet(root)
    listed = list_partition_files(spark, root, "k", "string").select("k").distinct().collect()
    assert sorted((r[0] for r in listed), key=str) == sorted(values, key=str)


def test_two_level_path_value(spark):
    df = spark.createDataFrame([("/t/a=1/b=x%3Dy/part-0.parquet",)], "p string")
    row = df.select(
        partition_value_from_path(F.col("p"), "a", "int").alias("a"),
        partition_value_from_path(F.col("p"), "b").alias("b"),
    ).first()
    assert (row["a"], row["b"]) == (1, "x=y")


def test_stray_directories_do_not_break_listing_or_retention(spark, workdir):
    root = f"{workdir}/stray"
    lineitem_by_year(spark, SF_SMALL).write.partitionBy("ctl_validfrom").parquet(root)
    for name in ("ctl_validfrom=garbage", "ctl_validfrom=50%zz"):
        os.makedirs(os.path.join(local_path(root), name))
    got = apply_retention_to_path(spark, root, "ctl_validfrom", "1996-01-01", "1999-01-01")
    assert got == ["ctl_validfrom=1997-01-01", "ctl_validfrom=1998-01-01"]
    left = sorted(n for n in os.listdir(local_path(root)) if n.startswith("ctl_validfrom="))
    assert "ctl_validfrom=garbage" in left and "ctl_validfrom=50%zz" in left
    df = spark.createDataFrame([("/r/k=50%zz/f",), ("/r/k=a%3Db/f",)], "p string")
    vals = [r[0] for r in df.select(partition_value_from_path(F.col("p"), "k")).collect()]
    assert vals == ["50%zz", "a=b"]


def test_rename_refuses_existing_target(spark, workdir):
    import pytest

    from martlet.sources.hadoop_fs import HadoopFS

    fs = HadoopFS(spark)
    a, b = f"{workdir}/a", f"{workdir}/b"
    fs.mkdirs(a)
    fs.mkdirs(b)
    with pytest.raises(FileExistsError):
        fs.rename(a, b)  # would nest a inside b and still report success
    assert not os.path.exists(os.path.join(local_path(b), "a"))


def test_retention_touches_only_listed_directories(spark, workdir):
    root = f"{workdir}/r"
    sibling = f"{workdir}/r_old"
    for path in (root, sibling):
        lineitem_by_year(spark, SF_SMALL).write.partitionBy("ctl_validfrom").parquet(path)
    apply_retention_to_path(spark, root, "ctl_validfrom", "1996-01-01", "1999-01-01")
    assert "ctl_validfrom=1997-01-01" in os.listdir(local_path(sibling))
    assert "ctl_validfrom=1997-01-01" not in os.listdir(local_path(root))


def test_repair_issues_statements_for_the_difference_only(spark, workdir, monkeypatch):
    from martlet.operators import partitions as P

    spec = _repair_mart(spark, workdir, 30)
    said = []
    sql = type(spark).sql

    def counted(self, text, *args, **kwargs):
        if text.startswith("ALTER"):
            said.append(text)
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", counted)
    assert P.repair_partitions(spark, spec) == ([], []) and said == []
    for day in (1, 2):
        spark.range(5).write.parquet(f"{workdir}/r/d=2022-01-0{day}")
    HadoopFS(spark).delete(f"{workdir}/r/d=2021-01-03")
    assert P.repair_partitions(spark, spec) == (["d=2022-01-01", "d=2022-01-02"], ["d=2021-01-03"])
    assert len(said) == 2
    assert spark.table(spec.table).count() == 29 * 3 + 10
    monkeypatch.setattr(P, "DROP_BATCH", 10)
    HadoopFS(spark).delete(f"{workdir}/r")
    assert len(P.repair_partitions(spark, spec)[1]) == 31 and len(said) == 2 + 4
    assert spark.sql(f"SHOW PARTITIONS {spec.table}").count() == 0


def _repair_mart(spark, workdir, days):
    from martlet.plans.spec import recreate, spec_for_frame
    from martlet.session import unique_name

    df = spark.range(days * 3).selectExpr("id", f"date_add(date'2021-01-01', cast(id % {days} AS int)) AS d")
    df.repartition(1).write.partitionBy("d").parquet(f"{workdir}/r")
    spec = spec_for_frame(df, unique_name("repair"), f"{workdir}/r", "d")
    recreate(spark, spec)
    return spec


def test_repair_handles_null_and_escaped_names(spark, workdir):
    from martlet.operators.partitions import repair_partitions
    from martlet.plans.spec import recreate, spec_for_frame
    from martlet.session import unique_name

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "x:y z")], "id int, p string")
    spec = spec_for_frame(df, unique_name("odd"), f"{workdir}/odd", "p")
    recreate(spark, spec)
    df.write.mode("append").partitionBy("p").parquet(f"{workdir}/odd")
    added, dropped = repair_partitions(spark, spec)
    assert len(added) == 3 and dropped == []
    assert sorted(str(r[0]) for r in spark.table(spec.table).select("p").collect()) == ["None", "a", "x:y z"]
    assert repair_partitions(spark, spec) == ([], [])

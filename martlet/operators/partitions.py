"""Partition lifecycle: inventory, drop (catalog and files), retention.

Partitions are always selected by their *typed* value (a date compared with a
date), never by the text of a directory name. Dropping is done in one
``ALTER TABLE … DROP IF EXISTS PARTITION (…), PARTITION (…)`` and, with
``purge`` (the default), the partition directories are deleted too – an external
table keeps its files on drop and a later repair would bring the rows back.

The driver only handles partition names: one row per partition, never row data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from martlet.plans.spec import MartSpec
from martlet.sources.files import NULL_PARTITION_NAME, partition_value_from_path
from martlet.sources.hadoop_fs import HadoopFS
from martlet.sources.tables import quote_identifier, table_location


DROP_BATCH = 500  # partition specs per ALTER TABLE statement


def catalog_partitions(
    spark: SparkSession, table: str, column: str, data_type: DataType | str | None = None
) -> DataFrame:
    """``(fragment, <column>)`` for every partition the catalog knows."""
    shown = spark.sql(f"SHOW PARTITIONS {quote_identifier(table)}")
    return shown.select(
        F.col("partition").alias("fragment"),
        partition_value_from_path(F.col("partition"), column, data_type).alias(column),
    )


def disk_partitions(
    spark: SparkSession, root: str, column: str, data_type: DataType | str | None = None
) -> DataFrame:
    """``(fragment, <column>)`` for every ``column=value`` directory directly below ``root``."""
    names = HadoopFS(spark).child_dir_names(root, column + "=")
    frame = spark.createDataFrame(
        [(n,) for n in names], StructType([StructField("fragment", StringType())])
    )
    return frame.select(
        "fragment", partition_value_from_path(F.col("fragment"), column, data_type).alias(column)
    )


def partition_row_counts(df: DataFrame, column: str) -> DataFrame:
    """``(<column>, row_count)``: rows per partition value of a mart DataFrame."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def footer_row_counts(
    spark: SparkSession, root: str, column: str, data_type: DataType | str | None = None
) -> DataFrame:
    """``(<column>, row_count)`` of a partitioned Parquet folder from the file
    footers alone: ``count(*) … GROUP BY <partition column>`` is pushed into the
    V2 Parquet scan (see ``load.footer_session``), so no row data is read."""
    from martlet.operators.load import footer_session

    counts = partition_row_counts(footer_session(spark).read.parquet(root), column)
    if data_type is not None:
        counts = counts.withColumn(column, F.col(column).cast(data_type))
    return counts


def open_interval(value: Column, from_value=None, to_value=None) -> Column:
    """``from < value < to``; a missing bound is unbounded. Both ends excluded."""
    cond = F.lit(True)
    if from_value not in (None, ""):
        cond = cond & (value > F.lit(_as_date(from_value)))
    if to_value not in (None, ""):
        cond = cond & (value < F.lit(_as_date(to_value)))
    return cond


def drop_partitions(
    spark: SparkSession,
    spec: MartSpec,
    doomed: DataFrame,
    purge: bool = True,
) -> list[str]:
    """Drop the partitions listed in ``doomed`` (a ``fragment`` column) from
    catalog and, with ``purge``, from disk. Returns the dropped fragments."""
    fragments = sorted({r["fragment"] for r in doomed.select("fragment").collect()})
    if not fragments:
        return []
    root = table_location(spark, spec.table).rstrip("/")
    paths = [f"{root}/{f}" for f in fragments] + (_version_paths(spark, root, fragments) if purge else [])
    for i in range(0, len(fragments), DROP_BATCH):
        spark.sql(
            f"ALTER TABLE {quote_identifier(spec.table)} DROP IF EXISTS "
            + ", ".join(partition_clause(f) for f in fragments[i : i + DROP_BATCH])
        )
    if purge:
        HadoopFS(spark).delete_many(paths)
    spark.catalog.refreshTable(spec.table)
    return fragments


def _version_paths(spark: SparkSession, root: str, fragments: list[str]) -> list[str]:
    """Directories of the partitions' versions (``martlet.operators.versions``)."""
    fs, doomed = HadoopFS(spark), set(fragments)
    return [p.path for v in fs.list(f"{root}/_versions") for p in fs.list(v.path) if p.name in doomed]


def repair_partitions(spark: SparkSession, spec: MartSpec) -> tuple[list[str], list[str]]:
    """Bring catalog and disk together by their difference only.

    Directories that the catalog does not know are added; partitions without a
    directory are dropped, unless their pointer names another directory that
    exists. Partitions known to both cost no statement and keep their pointer.
    Returns the added and the dropped fragments.
    """
    from martlet.operators.versions import partition_location

    col = spec.partition_column
    root = table_location(spark, spec.table).rstrip("/")
    disk = disk_partitions(spark, root, col, spec.partition_type)
    known = catalog_partitions(spark, spec.table, col, spec.partition_type)
    # By typed value: a directory may spell a timestamp another way than the catalog.
    same = F.col("d.value").eqNullSafe(F.col("k.value"))
    both = [df.select("fragment", F.col(col).alias("value")).alias(a) for df, a in ((disk, "d"), (known, "k"))]
    added = sorted(r["fragment"] for r in both[0].join(both[1], same, "left_anti").collect())
    gone = sorted(r["fragment"] for r in both[1].join(both[0], same, "left_anti").collect())
    fs = HadoopFS(spark)

    def lost(fragment: str) -> bool:
        at = partition_location(spark, spec.table, fragment)
        return at is None or not fs.exists(at)

    dropped = [f for f in gone if lost(f)]
    name = quote_identifier(spec.table)
    for i in range(0, len(added), DROP_BATCH):
        clauses = [f"{partition_clause(f)} LOCATION '{_sql_string(f'{root}/{f}')}'" for f in added[i : i + DROP_BATCH]]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(clauses))
    for i in range(0, len(dropped), DROP_BATCH):
        clauses = [partition_clause(f) for f in dropped[i : i + DROP_BATCH]]
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(clauses))
    if added or dropped:
        spark.catalog.refreshTable(spec.table)
    return added, dropped


def drop_all_partitions(spark: SparkSession, spec: MartSpec, purge: bool = True) -> list[str]:
    """Drop every partition, the ones only on disk included (with ``purge``)."""
    known = catalog_partitions(spark, spec.table, spec.partition_column, spec.partition_type)
    if purge:
        on_disk = disk_partitions(
            spark, table_location(spark, spec.table), spec.partition_column, spec.partition_type
        )
        known = known.unionByName(on_disk)
    return drop_partitions(spark, spec, known, purge=purge)


def apply_retention(
    spark: SparkSession,
    spec: MartSpec,
    from_date=None,
    to_date=None,
    purge: bool = True,
) -> list[str]:
    """Drop the partitions whose date lies strictly between ``from_date`` and
    ``to_date`` (open interval; an empty bound is unbounded)."""
    col = spec.partition_column
    candidates = catalog_partitions(spark, spec.table, col, spec.partition_type)
    if purge:
        candidates = candidates.unionByName(
            disk_partitions(spark, table_location(spark, spec.table), col, spec.partition_type)
        )
    doomed = candidates.where(open_interval(F.col(col).cast("date"), from_date, to_date))
    return drop_partitions(spark, spec, doomed, purge=purge)


def apply_retention_to_path(
    spark: SparkSession,
    root: str,
    column: str,
    from_date=None,
    to_date=None,
    data_type: DataType | str = "date",
) -> list[str]:
    """Retention on a bare partitioned directory (no catalog): delete the
    ``column=value`` directories whose date lies strictly inside the interval."""
    doomed = disk_partitions(spark, root, column, data_type).where(
        open_interval(F.col(column).cast("date"), from_date, to_date)
    )
    fragments = sorted(r["fragment"] for r in doomed.collect())
    HadoopFS(spark).delete_many([f"{root.rstrip('/')}/{f}" for f in fragments])
    return fragments


def partition_clause(fragment: str) -> str:
    """``PARTITION (a = 'x', b = 'y')`` from an escaped path fragment."""
    from urllib.parse import unquote

    parts = []
    for level in fragment.split("/"):
        name, _, raw = level.partition("=")
        value = unquote(raw)
        null = value == NULL_PARTITION_NAME
        parts.append(f"`{name}` = " + ("null" if null else f"'{_sql_string(value)}'"))
    return "PARTITION (" + ", ".join(parts) + ")"


def _sql_string(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])

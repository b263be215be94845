"""Load statistics: one-pass table facts, the scalar edge, and ``load_stats`` rows.

Facts are computed as one-row DataFrames with a single aggregate pass (count,
max of the load id, max of the business date together), so a table is scanned
once for all of them and only the referenced columns are read. A value reaches
the driver only through :func:`scalar`, at the edge.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


# Statistic ids published after a load.
STAT_APPLICATION_ID = 15
STAT_LAST_LOADED_TIME = 11
STAT_CHANGE = 2
STAT_BUSINESS_DATE = 5
STAT_MAX_CDC_DATE = 1

LOAD_STATS_SCHEMA = StructType(
    [
        StructField("loading_id", LongType()),
        StructField("entity_id", LongType()),
        StructField("stat_id", IntegerType()),
        StructField("avalue", ArrayType(StringType())),
        StructField("load_date", DateType()),
    ]
)


def scalar(df: DataFrame):
    """Row 0, column 0 of ``df``; ``None`` only when there is no row.

    A failing job raises: it is not mistaken for an empty result.
    """
    rows = df.take(1)
    if not rows:
        return None
    return rows[0][0]


def scalar_sql(spark: SparkSession, query: str, **args):
    """Scalar of a parameterised query (``:name`` markers, ``IDENTIFIER(:t)``)."""
    return scalar(spark.sql(query, args=args or None))


def query_text(spark: SparkSession, path: str) -> str:
    """Text of a stored query file (any Hadoop file system), read as one value."""
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise FileNotFoundError(path)
    return row[0]


def scalar_from(spark: SparkSession, path: str, **args):
    """Scalar of a stored, parameterised query: ``:name`` markers filled from ``args``
    (table names through ``IDENTIFIER(:name)``)."""
    return scalar_sql(spark, query_text(spark, path), **args)


def row_count(df: DataFrame) -> DataFrame:
    """``count(*)`` as a one-row DataFrame (``row_count``)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def table_row_count(spark: SparkSession, table: str) -> int:
    """Rows of a catalog table; a missing table counts 0 rows."""
    if not spark.catalog.tableExists(table):
        return 0
    return int(scalar_sql(spark, "SELECT count(*) FROM IDENTIFIER(:t)", t=table))


def table_stats(
    df: DataFrame,
    load_id_column: str = "ctl_loading",
    business_date_column: str = "report_dt",
) -> DataFrame:
    """``row_count, src_loading_id, business_date`` in one aggregate pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(load_id_column).cast("bigint").alias("src_loading_id"),
        F.max(business_date_column).alias("business_date"),
    )


def max_cdc_date(df: DataFrame, column: str = "ctl_validfrom") -> DataFrame:
    """Newest load date as ``yyyy-MM-dd`` text: first ten characters of ``max``."""
    return df.agg(
        F.substring(F.max(column).cast("string"), 1, 10).alias("max_cdc_date")
    )


def stat_rows(
    facts: DataFrame,
    values: dict[int, Column],
    loading_id: int,
    entity_id: int,
    load_date: _dt.date,
) -> DataFrame:
    """Turn a one-row facts DataFrame into ``load_stats`` rows, one per stat id.

    ``values`` maps a stat id to a column expression over ``facts`` (or a
    literal); each value is published as a one-element array of string.
    """
    entries = [
        F.struct(F.lit(stat_id).cast("int").alias("stat_id"), value.cast("string").alias("v"))
        for stat_id, value in values.items()
    ]
    return (
        facts.select(F.explode(F.array(*entries)).alias("s"))
        .select(
            F.lit(loading_id).cast("bigint").alias("loading_id"),
            F.lit(entity_id).cast("bigint").alias("entity_id"),
            F.col("s.stat_id").alias("stat_id"),
            F.array(F.col("s.v")).alias("avalue"),
            F.lit(load_date).cast("date").alias("load_date"),
        )
    )


def newest_partition(spark: SparkSession, table: str, column: str, data_type="date"):
    """Newest partition value of a catalog table, from the catalog alone (no scan)."""
    from martlet.operators.partitions import catalog_partitions

    return scalar(catalog_partitions(spark, table, column, data_type).agg(F.max(column)))


def load_stat_rows(
    mart: DataFrame,
    *,
    loading_id: int,
    entity_id: int,
    load_date: _dt.date,
    app_id: str,
    partition_column: str = "ctl_validfrom",
    business_date_column: str | None = "report_dt",
    newest_partition_value=None,
) -> DataFrame:
    """The five statistics of a finished load, computed from the loaded partition.

    Only the loaded partition is read (a partition filter): last-loaded time is
    the load date; change is ``1`` when the partition holds rows; business date is
    ``max`` of the business date column there (the load date when no such column
    is given). The CDC date is the newest partition of the mart: pass it in from
    the catalog (:func:`newest_partition`) to avoid touching other partitions;
    otherwise it is read from the partition column.
    """
    part_type = mart.schema[partition_column].dataType
    loaded = mart.where(F.col(partition_column) == F.lit(load_date).cast(part_type))
    aggs = [F.count(F.lit(1)).alias("rows_loaded")]
    if business_date_column:
        aggs.append(F.max(business_date_column).alias("business_date"))
    facts = loaded.agg(*aggs)
    if newest_partition_value is None:
        newest_partition_value = scalar(mart.agg(F.max(partition_column)))
    cdc = None if newest_partition_value is None else str(newest_partition_value)[:10]
    business = F.col("business_date") if business_date_column else F.lit(load_date.isoformat())
    return stat_rows(
        facts,
        {
            STAT_APPLICATION_ID: F.lit(app_id),
            STAT_LAST_LOADED_TIME: F.lit(load_date.isoformat()),
            STAT_CHANGE: F.when(F.col("rows_loaded") > 0, F.lit("1")).otherwise(F.lit("0")),
            STAT_BUSINESS_DATE: business,
            STAT_MAX_CDC_DATE: F.lit(cdc),
        },
        loading_id=loading_id,
        entity_id=entity_id,
        load_date=load_date,
    )


#: What identifies a load: publishing again replaces exactly its rows.
STATS_KEY = ["load_date", "loading_id", "entity_id"]


def publish_stats(rows: DataFrame, path: str) -> None:
    """Publish statistic rows to the ``load_stats`` Parquet folder, one partition a
    load (``STATS_KEY``). A rerun of a load replaces its rows and leaves all others
    alone: the write overwrites the partitions it has rows for, at its commit."""
    (
        rows.select([F.col(f.name).cast(f.dataType) for f in LOAD_STATS_SCHEMA.fields])
        .coalesce(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*STATS_KEY)
        .parquet(path)
    )


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOAD_STATS_SCHEMA).parquet(path).select(LOAD_STATS_SCHEMA.fieldNames())

"""Analogs of the mart sources and run-log records, built from the test tables.

These map the generated tables onto the shapes the toolkit works on, so every
registered query reads whole given tables and grows with them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test runs.
LOADING_ID = 42
LOAD_DATE = _dt.date(2021, 10, 25)
APP_ID = "app"
ENTITY_ID = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def payroll_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll source from ``lineitem``; ``ctl_loading`` is the order key."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("epk_id"),
        F.col("l_partkey").alias("inn"),
        F.col("l_suppkey").cast("int").alias("gosb_id"),
        F.col("l_linenumber").alias("enrollment_type"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amt"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("report_dt"),
        F.col("l_orderkey").alias("ctl_loading"),
    )


def merchant_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant source from ``supplier``; ``ctl_loading`` is the supplier key."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_name").alias("merch_id"),
        F.col("s_suppkey").alias("inn"),
        F.col("s_nationkey").alias("gosb_id"),
        F.col("s_suppkey").alias("ctl_loading"),
    )


def year_start(ts: Column) -> Column:
    """First day of the year of a timestamp, as a date (load-date analog)."""
    return F.trunc(ts.cast("date"), "year")


def lineitem_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``lineitem`` columns plus ``ctl_validfrom`` = first day of the ship year."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("ctl_validfrom", year_start(F.col("l_shipdate")))


def level_of_event(event_type: Column) -> Column:
    """Log level analog of an event type: error 40, signup 25, others 20."""
    return (
        F.when(event_type == "error", F.lit(40))
        .when(event_type == "signup", F.lit(25))
        .otherwise(F.lit(20))
    )


def log_records(events: DataFrame) -> DataFrame:
    """Run-log records from ``events``: created, levelno, message, name, record_id."""
    return events.select(
        F.col("event_id").alias("record_id"),
        F.col("ts").alias("created"),
        level_of_event(F.col("event_type")).alias("levelno"),
        F.col("props").alias("message"),
        F.concat(F.lit("user."), F.col("user_id").cast("string")).alias("name"),
    )

"""Table scans addressed by run parameters."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_IDENT_PART = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quote_identifier(name: str) -> str:
    """Back-quote a (possibly qualified) table name after validating each part."""
    parts = name.split(".")
    for part in parts:
        if not _IDENT_PART.match(part):
            raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def is_path(source: str) -> bool:
    """True for a path (it has a ``/`` or a scheme), False for a catalog name."""
    return "/" in source or ":" in source


def read_source(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A source given as a catalog name, a Parquet path or a DataFrame.

    A name is looked up in the catalog; anything with a ``/`` or a scheme is read
    as Parquet. Column pruning and filters still reach the scan, as the plan is
    built lazily on top of it.
    """
    if isinstance(source, DataFrame):
        return source
    if is_path(source):
        return spark.read.parquet(source)
    return spark.table(source)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_identifier(table)}").collect()
    for row in rows:
        if row["col_name"] == "Location":
            return row["data_type"]
    raise ValueError(f"table {table} has no location")

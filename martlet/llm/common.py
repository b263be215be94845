"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlet.session import checkpointed, new_work_dir

__all__ = ["WORD_PATTERN", "checkpointed", "stored", "table", "text_bytes"]

#: A word everywhere in this subpackage: a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder: smaller than a
    checkpoint, for what is large and read more than once."""
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(value: str | None) -> bytes:
    """UTF-8 of a text (null: empty). ``bytes.split`` and ``bytes.lower`` are
    ASCII-only, which is exactly the word rule and the A-Z lower-casing."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")

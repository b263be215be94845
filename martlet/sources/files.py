"""File listings as DataFrames.

The ``binaryFile`` source lists files in a distributed way (Spark parallelises
the listing of many directories) and, when only ``path`` and ``length`` are
selected, never opens a file. Partition values are taken from the path with
built-in functions and cast to their declared type, so a partition is always
addressed by its typed value, never by the text of the directory name.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# The directory name Spark and Hive use for a NULL partition value.
NULL_PARTITION_NAME = "__HIVE_DEFAULT_PARTITION__"


def unescape_partition_value(raw: Column) -> Column:
    """Undo Spark's ``%XX`` escaping of a partition directory value.

    ``url_decode`` would also turn ``+`` into a space, which Spark never writes
    for a space, so ``+`` is protected first. The NULL marker becomes NULL; a
    name that is not valid escaping (a directory not written by Spark) is kept
    as it is.
    """
    decoded = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw == F.lit(NULL_PARTITION_NAME), F.lit(None)).otherwise(
        F.coalesce(decoded, raw)
    )


def partition_value_from_path(path: Column, column: str, data_type: DataType | str | None = None) -> Column:
    """Typed value of ``column`` from a file or directory path (any nesting level).

    A value that does not parse as ``data_type`` becomes NULL, so a stray
    directory falls outside every typed range instead of failing the job.
    """
    pattern = r"(?:^|/)" + regex_escape(column) + r"=([^/]*)(?:/|$)"
    raw = F.regexp_extract(path, pattern, 1)
    value = unescape_partition_value(raw)
    return value.try_cast(data_type) if data_type is not None else value


def list_files(spark: SparkSession, *roots: str) -> DataFrame:
    """``(path, length)`` of every data file below each of ``roots``.

    Spark skips names starting with ``_`` or ``.`` (``_SUCCESS``, ``.crc``) on its
    own. Row-less Parquet files are listed too, unlike ``_metadata`` of a scan.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(roots))
        .select("path", "length")
    )


def list_partition_files(
    spark: SparkSession,
    root: str,
    partition_column: str | None,
    partition_type: DataType | str | None = None,
) -> DataFrame:
    """``(path, length, <partition_column>)``; an unpartitioned root has no value column."""
    files = list_files(spark, root)
    if not partition_column:
        return files
    return files.withColumn(
        partition_column, partition_value_from_path(F.col("path"), partition_column, partition_type)
    )


def partition_file_stats(
    spark: SparkSession,
    root: str,
    partition_column: str | None,
    partition_type: DataType | str | None = None,
) -> DataFrame:
    """Files and bytes per partition: ``(<partition_column>, files, bytes)``.

    A partial aggregate runs next to each listing task, so only one row per
    partition value and task is shuffled.
    """
    listed = list_partition_files(spark, root, partition_column, partition_type)
    keys = [partition_column] if partition_column else []
    return listed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("bytes")
    )


def row_position(df: DataFrame) -> Column | None:
    """A deterministic per-row key from where the row is stored, or ``None``.

    For file-based sources this is ``xxhash64(_metadata.file_path,
    _metadata.row_index)``: the same on every recomputation of a task (safe
    under executor loss), different for every stored row - also for rows that
    are exact copies of each other, which a hash of the row's values would
    send to a single task.
    """
    try:
        meta = df.select("_metadata").schema["_metadata"].dataType  # analysis only
    except AnalysisException:  # not a file source
        return None
    if not {"file_path", "row_index"} <= set(meta.fieldNames()):
        return None  # a file source without row positions (e.g. binaryFile)
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def base_name(path: Column) -> Column:
    """Last path component."""
    return F.substring_index(path, "/", -1)


def regex_escape(text: str) -> str:
    out = []
    for ch in text:
        if ch.isalnum() or ch == "_":
            out.append(ch)
        else:
            out.append("\\" + ch)
    return "".join(out)

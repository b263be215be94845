"""Append sinks for run-log shapes, batch and Structured Streaming.

The shaping functions in ``martlet.functions.runlog`` are stateless, so a
streaming DataFrame of log records goes through them unchanged; here only the
sink differs. Streaming sinks use the file sink with a checkpoint, so a restart
on the same checkpoint neither loses nor repeats a micro-batch, and readers of
the output folder see committed files only (the sink's metadata log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def append_text(df: DataFrame, path: str, column: str) -> None:
    """Batch: append one text line per row (``column``) below ``path``."""
    df.select(column).write.mode("append").text(path)


def append_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stream_text(
    df: DataFrame,
    path: str,
    column: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Streaming: write ``column`` as text lines through the file sink."""
    return _start(
        df.select(column).writeStream.format("text"),
        path,
        checkpoint,
        available_now,
        processing_time,
        query_name,
    )


def stream_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Streaming: append rows as Parquet through the file sink."""
    return _start(
        df.writeStream.format("parquet"), path, checkpoint, available_now, processing_time, query_name
    )


def read_stream_like(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    *,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A file stream over the folder ``path`` (files matching ``glob``), fixed schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def _start(writer, path, checkpoint, available_now, processing_time, query_name) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)

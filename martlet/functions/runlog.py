"""Run-log shapes over DataFrames of log records.

A log record DataFrame has ``created`` (timestamp), ``levelno`` (int),
``message`` and ``name`` (logger name). Three shapes are built from it, all
stateless per row, so the same functions serve batch and streaming DataFrames:

* :func:`envelope` – JSON event ``{app_id, timestamp, type_id, subtype_id,
  value, message, name}`` with the timestamp in whole epoch seconds; null fields
  are written as ``null``;
* :func:`status_events` – run-status rows for records above INFO, ``status``
  ERROR from level ERROR up, else RUNNING;
* :func:`log_lines` – text lines ``time - name [LEVEL]: message``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Logging level numbers and names, with the extra CTL_INFO level
# between INFO and WARNING.
LEVELS = {
    10: "DEBUG",
    20: "INFO",
    25: "CTL_INFO",
    30: "WARNING",
    40: "ERROR",
    50: "CRITICAL",
}
INFO = 20
CTL_INFO = 25
ERROR = 40
TYPE_ID = "Tech"
STATUS_ERROR = "ERROR"
STATUS_RUNNING = "RUNNING"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Fixed value: what a missing part of a text line reads as.
MISSING = "None"
_KEEP_NULLS = {"ignoreNullFields": "false"}


def level_name(levelno: Column) -> Column:
    """Level name of a level number; unknown numbers read ``Level <n>``."""
    names = F.create_map(*[x for k, v in LEVELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(
        F.element_at(names, levelno.cast("int")),
        F.concat(F.lit("Level "), levelno.cast("string")),
    )


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since the epoch, independent of the session time zone.

    A timestamp without time zone is read as UTC wall time; one with time zone is
    an instant already.
    """
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return F.timestamp_diff(
            "SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(column)
        )
    return F.unix_seconds(F.col(column))


def envelope(
    records: DataFrame, app_id: str, *, keep: list[str] | None = None
) -> DataFrame:
    """``payload``: one compact JSON document per record."""
    doc = F.struct(
        F.lit(str(app_id)).alias("app_id"),
        epoch_seconds(records, "created").cast("bigint").alias("timestamp"),
        F.lit(TYPE_ID).alias("type_id"),
        level_name(F.col("levelno")).alias("subtype_id"),
        F.col("levelno").cast("int").alias("value"),
        F.col("message").alias("message"),
        F.col("name").alias("name"),
    )
    return records.select(*(keep or []), F.to_json(doc, _KEEP_NULLS).alias("payload"))


def status_events(
    records: DataFrame, loading_id: int | str | Column, *, keep: list[str] | None = None
) -> DataFrame:
    """``loading_id, effective_from, status, log`` for records with level > INFO.

    ``loading_id`` is the run's id (an int) or a column name / column.
    """
    if isinstance(loading_id, int):
        lid = F.lit(loading_id)
    elif isinstance(loading_id, str):
        lid = F.col(loading_id)
    else:
        lid = loading_id
    return records.where(F.col("levelno") > INFO).select(
        *(keep or []),
        lid.cast("bigint").alias("loading_id"),
        F.date_format("created", TIME_FORMAT).alias("effective_from"),
        F.when(F.col("levelno") >= ERROR, F.lit(STATUS_ERROR))
        .otherwise(F.lit(STATUS_RUNNING))
        .alias("status"),
        F.col("message").alias("log"),
    )


def status_json(status: DataFrame) -> DataFrame:
    """The status rows as JSON documents (``payload``)."""
    return status.select(
        F.to_json(F.struct("loading_id", "effective_from", "status", "log"), _KEEP_NULLS).alias("payload")
    )


def log_lines(records: DataFrame, *, keep: list[str] | None = None) -> DataFrame:
    """``line``: ``yyyy-MM-dd HH:mm:ss - name [LEVEL]: message``; a null part
    reads ``None``."""
    def part(value: Column) -> Column:
        return F.coalesce(value, F.lit(MISSING))

    return records.select(
        *(keep or []),
        F.concat(
            part(F.date_format("created", TIME_FORMAT)),
            F.lit(" - "),
            part(F.col("name")),
            F.lit(" ["),
            part(level_name(F.col("levelno"))),
            F.lit("]: "),
            part(F.col("message")),
        ).alias("line"),
    )

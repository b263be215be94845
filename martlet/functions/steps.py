"""Numbered names: the single digit run in a name is its step; order by step.

A valid name holds exactly one run of digits (``stat1.sql``, ``1stat.sql``,
``stat12.sql``); names with none or several (``stat.sql``, ``stat1_1.sql``,
``12stat1.sql``) are invalid. ``on_bad="raise"`` fails on the first invalid
name, ``on_bad="reject"`` leaves them out. A step too large for a bigint counts
as invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.sources.files import base_name, row_position

DIGIT_RUN = r"(\d+)"


def digit_runs(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit(DIGIT_RUN), 1)


def step_of(name: Column) -> Column:
    """The step of a name, or NULL when the name is not validly numbered."""
    runs = digit_runs(name)
    return F.when(F.size(runs) == 1, F.element_at(runs, 1).try_cast("bigint"))


def with_steps(df: DataFrame, name_column: str = "name", on_bad: str = "raise") -> DataFrame:
    """Add ``step``; order by it (smallest first). With ``on_bad="raise"`` the
    job fails when it meets an invalid name."""
    if on_bad not in ("raise", "reject"):
        raise ValueError("on_bad must be 'raise' or 'reject'")
    name = F.col(name_column)
    if on_bad == "raise":
        message = F.concat(F.lit("expected exactly one number in name: "), F.coalesce(name, F.lit("null")))
        valid = df.withColumn("step", F.coalesce(step_of(name), F.raise_error(message).cast("bigint")))
    else:
        valid = df.withColumn("step", step_of(name)).where(F.col("step").isNotNull())
    # The storage position breaks ties, so the range partitioner of the sort can
    # split a name repeated in a large share of the rows over several tasks.
    position = row_position(df)
    if position is None:
        return valid.orderBy("step", name_column)
    return valid.withColumn("_pos", position).orderBy("step", name_column, "_pos").drop("_pos")


def numbered_files(
    spark: SparkSession, root: str, glob: str = "*", on_bad: str = "raise", name: Column | None = None
) -> DataFrame:
    """``(path, name, step)`` of the files below ``root`` (recursive) matching
    ``glob``. ``name`` is what holds the number, as a column over ``path``; by
    default the file's own name."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path")
    )
    names = base_name(F.col("path")) if name is None else name
    return with_steps(files.withColumn("name", names), "name", on_bad)


def run_numbered_sql(
    spark: SparkSession, root: str, glob: str = "*.sql", on_bad: str = "raise", **args
) -> list[tuple[str, int, DataFrame]]:
    """Run the numbered SQL files below ``root`` in step order (smallest first).

    Each file holds one statement with ``:name`` markers (table names through
    ``IDENTIFIER(:name)``), filled from ``args``. The texts are read through
    Spark, so ``root`` may be on any Hadoop file system; only the file names
    and texts reach the driver. Returns ``(path, step, result)`` per file.
    """
    ordered = numbered_files(spark, root, glob, on_bad).select("path", "step").collect()
    if not ordered:
        return []
    texts = {
        _same_path(r["path"]): r["value"]
        for r in spark.read.text([r["path"] for r in ordered], wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), "value")
        .collect()
    }
    out = []
    for row in ordered:
        text = texts[_same_path(row["path"])].strip().rstrip(";")
        used = {k: v for k, v in args.items() if f":{k}" in text}
        out.append((row["path"], row["step"], spark.sql(text, args=used or None)))
    return out


def _same_path(path: str) -> str:
    """One spelling per path: ``file:///x`` and ``file:/x`` name the same file."""
    import re

    return re.sub(r"^([a-z][a-z0-9+.-]*):/+", lambda m: m.group(1) + ":/", path)

"""Snapshot load: a full copy of a source into the partition of one load date.

One aggregate pass over the source's load-id column gives the row count and the
newest source load id (the lineage value); an empty source or one without load
ids stops the load before anything is written. The data then flows as a single
lazy plan – projection, lineage literals, ANSI store assignment – into an
``INSERT OVERWRITE … BY NAME`` that replaces that one partition, leaves every
other partition alone, and swaps the new files in only when the job commits.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlet.functions.calendar import launch_date
from martlet.plans.spec import MartSpec, ensure_table, partition_literal
from martlet.sources.files import partition_value_from_path, row_position
from martlet.session import child_session
from martlet.sources.hadoop_fs import HadoopFS
from martlet.sources.tables import is_path, quote_identifier, read_source, table_location


class EmptySourceError(ValueError):
    """The source has no rows or no load id; the old partition is kept."""


class SourceChangedError(RuntimeError):
    """The rows written are not those the lineage id was taken from: the source
    changed during the load. Run the load again."""


@dataclass(frozen=True)
class LoadResult:
    table: str
    load_date: _dt.date
    source_rows: int
    src_loading_id: int | None
    loading_id: int
    rows_written: int | None = None


def source_facts(source: DataFrame, load_id_column: str) -> DataFrame:
    """``source_rows, src_loading_id`` of a source in one pass (one column read)."""
    return source.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.max(load_id_column).alias("src_loading_id"),
    )


def footer_session(spark: SparkSession) -> SparkSession:
    """A child session (own SQL conf) whose Parquet scans answer ``count`` and
    ``max``/``min`` from file footers: the V2 Parquet reader with aggregate
    pushdown. The caller's session is not changed. It has neither the caller's
    temporary views nor its current database, so it is for paths only."""
    return child_session(spark, {
        "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
        "spark.sql.parquet.aggregatePushdown": "true",
    })


def facts_of(spark: SparkSession, source: str | DataFrame, load_id_column: str):
    """``source_rows, src_loading_id`` of a source as one Row.

    A Parquet path is read in :func:`footer_session`, so the two facts come from
    the file footers and no data is scanned. A table or view name is resolved in
    the caller's session, as the load resolves it, and scanned for its one
    column, like a DataFrame.
    """
    reader = footer_session(spark) if isinstance(source, str) and is_path(source) else spark
    return source_facts(read_source(reader, source), load_id_column).first()


def observed_facts(load_id_column: str) -> list[Column]:
    """What a write observes of the rows it reads: their count and newest load id."""
    return [F.count(F.lit(1)).alias("rows"), F.max(load_id_column).alias("newest")]


def pinned_source(spark: SparkSession, source: str | DataFrame, load_id_column: str):
    """``(source, facts)`` with both from one file listing where there is one.

    The files of a path are listed once, when the DataFrame is made: rows come from
    that listing, and the facts from the footers of exactly those files, so files
    that appear later are in neither. A table or view name resolves to one DataFrame
    for both. What its provider lists at run time, and files rewritten under the
    same name, are caught by what the write observes (:func:`observed_facts`).
    """
    src = read_source(spark, source)
    if isinstance(source, str) and is_path(source):
        files = [unquote(f) for f in src.inputFiles()]
        reader = footer_session(spark).read
        if HadoopFS(spark).is_dir(source):
            reader = reader.option("basePath", source)
        if files:
            return src, source_facts(reader.parquet(*files), load_id_column).first()
    return src, source_facts(src, load_id_column).first()


def check_columns(df: DataFrame, expected: list[str]) -> None:
    """The projected column set must equal the mart's: no missing, no extra."""
    have = [c.lower() for c in df.columns]
    want = [c.lower() for c in expected]
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    if missing or extra:
        raise ValueError(f"column mismatch: missing={missing} extra={extra}")


def with_lineage(
    projected: DataFrame, spec: MartSpec, src_loading_id: int | None, loading_id: int
) -> DataFrame:
    """Append the source load id and the current load id as bigint literals."""
    return projected.select(
        *projected.columns,
        F.lit(src_loading_id).cast("bigint").alias(spec.lineage_column),
        F.lit(loading_id).cast("bigint").alias(spec.load_id_column),
    )


def file_layout(rows: DataFrame, rebalance: bool = False, position: str | None = None) -> DataFrame:
    """The output layout of a load.

    By default rows are written as they are read: no shuffle, and the compaction
    merges small files once. With ``rebalance`` (for sources of very many small
    files, instead of a compaction) one shuffle lets adaptive execution cut the
    output into evenly sized files in the same job; set
    ``spark.sql.adaptive.coalescePartitions.parallelismFirst=false`` and an
    advisory size that matches the target file size, or it aims at the core
    count. Rows are spread by ``position`` (a per-row storage key, see ``row_position``): a hash
    that is stable when a lost task is recomputed, so no local sort is needed,
    and that keeps apart rows which are copies of each other - a hash of the
    values would put a group of copies holding a third of the rows into one
    task. Without a position the rows are dealt round robin (Spark sorts each
    task locally to keep that stable under retries).
    """
    if not rebalance:
        return rows.drop(position) if position else rows
    if position:
        return rows.hint("rebalance", position).drop(position)
    return rows.hint("rebalance")


def snapshot_rows(
    source: DataFrame, spec: MartSpec, src_loading_id: int | None, loading_id: int,
    rebalance: bool = False,
) -> DataFrame:
    """The rows a snapshot load writes: business columns, lineage, layout."""
    position = row_position(source) if rebalance else None
    extra = [position.alias(_POSITION)] if position is not None else []
    rows = with_lineage(source.select(*spec.business_columns, *extra), spec, src_loading_id, loading_id)
    return file_layout(rows, rebalance, _POSITION if extra else None)


_POSITION = "_martlet_row_position"


def insert_partition(
    spark: SparkSession,
    spec: MartSpec,
    rows: DataFrame,
    load_date,
    rebalance: bool = False,
    staged: bool = True,
) -> int:
    """Replace exactly the ``load_date`` partition of ``spec.table`` with ``rows``.

    ``BY NAME`` matches columns by name; the session's ANSI store assignment makes
    overflow and bad casts raise. ``rebalance`` applies :func:`file_layout`
    (round robin; :func:`snapshot_rows` already lays out a load's rows).

    ``staged`` (default): the partition value travels as a column and the insert
    runs with dynamic partition overwrite, so Spark writes into a staging folder
    and swaps the partition in only when the job commits. A job that fails
    (lost executors beyond retries, bad data) leaves the previous rows of that
    date in place. Only the partitions present in ``rows`` are replaced - here
    exactly the load date. ``staged=False`` uses a static ``PARTITION (…)``
    clause, which empties the partition before the job runs; it is needed to
    replace a partition with zero rows.

    Returns the rows written, observed in the write stage itself (each task
    counted once, also after retries).
    """
    if rebalance:
        rows = file_layout(rows, True, None)
    check_columns(rows, [f.name for f in spec.columns.fields])
    written = Observation(f"load_{uuid.uuid4().hex[:12]}")
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    table = quote_identifier(spec.table)
    part = f"`{spec.partition_column}`"
    literal = partition_literal(spec, load_date)
    if staged:
        rows = rows.select("*", F.expr(literal).alias(spec.partition_column))
        with _session_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            spark.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION ({part}) BY NAME SELECT * FROM {{rows}}",
                rows=rows,
            )
    else:
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({part} = {literal}) "
            "BY NAME SELECT * FROM {rows}",
            rows=rows,
        )
    return int(written.get["rows"])


_conf_lock = threading.Lock()
_conf_users: dict[tuple[int, str], list] = {}


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str):
    """Hold a SQL conf at ``value`` while the block runs, then restore it.

    Reference-counted per session and key: when several threads load marts in
    the same session at once, the value stays set until the last of them is
    done, and only then is the caller's value put back.
    """
    slot = (id(spark), key)
    with _conf_lock:
        users = _conf_users.get(slot)
        if users is None:
            users = _conf_users[slot] = [0, spark.conf.get(key, None)]
            spark.conf.set(key, value)
        users[0] += 1
    try:
        yield
    finally:
        with _conf_lock:
            users[0] -= 1
            if users[0] == 0:
                del _conf_users[slot]
                if users[1] is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, users[1])


def load_snapshot(
    spark: SparkSession,
    spec: MartSpec,
    source: str | DataFrame,
    *,
    loading_id: int,
    load_date: _dt.date | str | None = None,
    allow_empty: bool = False,
    rebalance: bool = False,
    pinned=None,
) -> LoadResult:
    """Publish a full snapshot of ``source`` into the ``load_date`` partition.

    Re-running with the same date replaces that partition only (idempotent),
    also where its directory is named in another form of the same typed value
    (``2021-10-25`` for a timestamp partition). Raises
    :class:`EmptySourceError` when the source has no load id, unless
    ``allow_empty`` – then the partition is replaced by an empty one – and
    :class:`SourceChangedError` when the rows written are not as many as the
    lineage id was taken from, or hold another newest load id. ``pinned`` takes a
    :func:`pinned_source` made earlier instead of making one.
    """
    if load_date is None:
        load_date = launch_date()
    if isinstance(load_date, str):
        load_date = _dt.date.fromisoformat(load_date)
    src, facts = pinned or pinned_source(spark, source, spec.source_load_id_column)
    src_loading_id = facts["src_loading_id"]
    if src_loading_id is None and not allow_empty:
        raise EmptySourceError(
            f"source has no {spec.source_load_id_column} ({facts['source_rows']} rows); nothing loaded"
        )
    ensure_table(spark, spec)
    read = Observation(f"source_{uuid.uuid4().hex[:12]}")
    rows = snapshot_rows(src.observe(read, *observed_facts(spec.source_load_id_column)), spec, src_loading_id, loading_id, rebalance)
    # An empty source (allowed) must still empty the partition: static insert.
    empty = int(facts["source_rows"]) == 0
    before = _same_date_files(spark, spec, load_date)
    rows_written = insert_partition(spark, spec, rows, load_date, staged=not empty)
    _drop_stale_names(spark, spec, load_date, before, empty)
    if rows_written != int(facts["source_rows"]) or read.get["newest"] != src_loading_id:
        raise SourceChangedError(
            f"{rows_written} rows written to {spec.table} for {load_date} with newest load id {read.get['newest']}, "
            f"but the lineage id was taken from {facts.asDict()}"
        )
    return LoadResult(
        table=spec.table,
        load_date=load_date,
        source_rows=int(facts["source_rows"]),
        src_loading_id=None if src_loading_id is None else int(src_loading_id),
        loading_id=loading_id,
        rows_written=rows_written,
    )


def _same_date_files(spark: SparkSession, spec: MartSpec, load_date) -> dict[str, set[str]]:
    """File names of every partition directory whose typed value is the load date.

    Only names that begin with the date are looked up (with and without leading
    zeros), so the cost does not grow with the mart's partitions. The names Spark
    writes need no check; any other is compared by its typed value.
    """
    root = table_location(spark, spec.table).rstrip("/")
    fs, col, day = HadoopFS(spark), spec.partition_column, load_date.isoformat()
    begins = {f"{load_date.year:04d}-{m}-{d}" for m in (f"{load_date:%m}", load_date.month) for d in (f"{load_date:%d}", load_date.day)}
    names = {n for b in begins for n in fs.child_dir_names(root, f"{col}={b}")}
    plain = {f"{col}={day}", f"{col}={day} 00%3A00%3A00"}
    other = sorted(names - plain)
    if other:
        frame = spark.createDataFrame([(n,) for n in other], "fragment string")
        value = partition_value_from_path(F.col("fragment"), col, spec.partition_type)
        other = [r[0] for r in frame.where(value == F.expr(partition_literal(spec, load_date))).collect()]
    return {f: {e.name for e in fs.list(f"{root}/{f}")} for f in sorted((names & plain) | set(other))}


def _drop_stale_names(spark: SparkSession, spec: MartSpec, load_date, before: dict[str, set[str]], empty: bool) -> None:
    """Delete directories of the load date that the load did not write to."""
    after = _same_date_files(spark, spec, load_date)
    stale = [f for f, names in after.items() if before.get(f) == names]
    if empty or len(after) < 2 or len(stale) == len(after):
        return
    root = table_location(spark, spec.table).rstrip("/")
    HadoopFS(spark).delete_many([f"{root}/{f}" for f in stale])
    spark.sql(spec.repair_statement())
    spark.catalog.refreshTable(spec.table)


def force_load(
    spark: SparkSession,
    spec: MartSpec,
    source: str | DataFrame,
    *,
    loading_id: int,
    load_date: _dt.date | str | None = None,
    rebalance: bool = False,
) -> LoadResult:
    """Leave the mart holding only this load: every other partition is dropped
    (catalog and files).

    The new partition is loaded first (staged, swapped in at commit) and the
    others are dropped only after that succeeded, so a failed force load leaves
    the mart as it was. An empty source raises before anything changes.
    """
    from martlet.operators.partitions import (
        catalog_partitions,
        disk_partitions,
        drop_partitions,
    )
    pinned = pinned_source(spark, source, spec.source_load_id_column)
    if pinned[1]["src_loading_id"] is None:
        raise EmptySourceError("source has no load id; mart not cleared")
    result = load_snapshot(
        spark,
        spec,
        pinned[0],
        loading_id=loading_id,
        load_date=load_date,
        rebalance=rebalance,
        pinned=pinned,
    )
    col = spec.partition_column
    others = catalog_partitions(spark, spec.table, col, spec.partition_type).unionByName(
        disk_partitions(spark, table_location(spark, spec.table), col, spec.partition_type)
    )
    keep = F.lit(result.load_date).cast(spec.partition_type)
    drop_partitions(spark, spec, others.where(~F.col(col).eqNullSafe(keep)), purge=True)
    return result

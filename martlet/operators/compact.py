"""Compaction: rewrite small Parquet files into ``bytes div target + 1`` files
per partition, verify the copy, then swap it into place.

Layout. The folder's own layout decides: ``name=value`` directories, on any
number of levels, are partitions whether or not a partition column is named. A
partition is known by its unescaped directory values as text, so NULL, odd and
short-named values go back into the directory they came from; only the ``start``
bound compares typed values.

Plan. A ``binaryFile`` listing (file statuses only, no file opened) is grouped
into ``(partition, files, bytes)``; partitions on or after ``start`` with data
are kept and get ``n_files = bytes div target + 1``.

Schema. The declared schema of ``table`` where one is given, otherwise the merged
schema of every selected file. A column that the target schema lacks, or a type
that differs, raises before anything is written.

Rewrite – waves of at most ``WAVE_PARTITIONS`` partitions and ``WAVE_FILES`` output
files, one write job a wave:

* ``packed`` (partitioned folders): no shuffle. Every partition is a scan of its own
  whose splits are whole files packed up to the target size (largest first; only a
  file beyond the target is cut, at its row groups), reduced by ``coalesce`` to
  ``n_files`` bins; a bin is read by one task and written as one file. The bins of
  a wave's partitions are one union. Nothing is joined, sorted or moved between
  executors, and a partition that holds most rows is most of the tasks.
* ``salted`` (on request, where single files are too uneven to pack): a salt
  ``pmod(position, n_files)`` by storage position (copies of one row spread too) and
  ``repartition(sum(n_files), partition, salt)``. ``n_files`` comes from the wave's
  plan, at most ``WAVE_PARTITIONS`` rows, as a broadcast. Deterministic under retries.
* ``coalesce`` (flat folders): ``coalesce(n_files)``, no shuffle.
* ``rebalance`` (on request, when exact counts do not matter): one shuffle with
  the ``rebalance`` hint; adaptive execution sizes the files.

Isolation. With ``on_error="isolate"`` a partition that cannot be read, merged or
rewritten is left as it is and reported in ``quarantined``; the others go on. Bad
ones are found by halving, so a bad one among P costs about log2(P) more attempts.
Partitions whose types clash with each other, and with no declared schema, are
rewritten apart, each with the schema of its own kind.

Journal. With ``journal`` (a folder), every wave appends what it staged and swapped.
A restart with the same journal first finishes an interrupted swap and then leaves
out the partitions whose files are those an earlier wave wrote.

Verify. Rows per partition of the sources, from their footers, must equal those
of the staged copy; with ``verify="checksum"`` the sum of whole-row hashes,
observed at the scan, must too.

Swap (``publish="swap"``). Partitions whose files are not those the rewrite read (by name, length and
time) are left alone and reported. For the others: source → backup, staged →
source; the backup is listed once more, and a partition that got new files in
between is put back. On any failure every touched partition is restored. Staging
and backup are siblings of the table folder, never inside it. Readers that list
the folder during the rename window may miss a partition; ``publish="pointer"``
(for a catalog table) moves nothing: the staged directories are a version of their
own (``martlet.operators.versions``) and the catalog is pointed to them, so a query
finds either the old files or the new ones.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from martlet.session import child_session
from martlet.sources.files import NULL_PARTITION_NAME, partition_value_from_path, regex_escape, row_position
from martlet.sources.hadoop_fs import HadoopFS

# Target file size (the HDFS block size the reference configures).
DEFAULT_TARGET_BYTES = 128 * 1024 * 1024

MIN_ROW_GROUP = 1024 * 1024

#: A wave's limits: partitions (scans of one plan) and output files (tasks).
WAVE_PARTITIONS, WAVE_FILES = 200, 10_000
_KEY, _POSITION, _N = "__martlet_key", "__martlet_position", "__martlet_n"

_JOURNAL = "run string, fragment string, phase string, files long, state decimal(38,0), at timestamp"


class CompactionVerifyError(RuntimeError):
    """The staged copy does not hold the source rows; nothing was swapped."""


class CompactionSchemaError(ValueError):
    """The files do not fit one schema; nothing was written."""


class CompactionLayoutError(ValueError):
    """The folder's directories are not one partition layout; nothing was written."""


@dataclass
class CompactionResult:
    root: str
    plan: list[dict] = field(default_factory=list)
    rows_source: int = 0
    rows_staged: int = 0
    strategy: str = "none"
    swapped: list[str] = field(default_factory=list)
    conflicts: list[str] = field(default_factory=list)
    quarantined: dict[str, str] = field(default_factory=dict)
    resumed: list[str] = field(default_factory=list)
    waves: int = 0
    timings: dict[str, float] = field(default_factory=dict)
    rewrite_jobs: int = 0

    @property
    def bytes_before(self) -> int:
        return int(sum(int(p["bytes"]) for p in self.plan))

    @property
    def files_before(self) -> int:
        return int(sum(int(p["files"]) for p in self.plan))


class _Clock:
    def __init__(self, sink: dict[str, float]):
        self._sink = sink
        self._t = time.perf_counter()

    def lap(self, label: str) -> None:
        now = time.perf_counter()
        self._sink[label] = round(self._sink.get(label, 0.0) + now - self._t, 4)
        self._t = now


def files_for(bytes_col, target_bytes: int):
    """Target file count: ``bytes div target + 1`` (an exact multiple gets one more)."""
    return (F.col(bytes_col) / F.lit(target_bytes)).cast("bigint") + F.lit(1)


# -- layout and plan ----------------------------------------------------------
def partition_levels(fs: HadoopFS, root: str) -> list[str]:
    """Partition column names of a folder, outermost first; empty if it is flat.

    The names are read along one branch; a directory that carries another column
    at its level shows up in the plan and raises there.
    """
    levels: list[str] = []
    at = root
    while True:
        children = [e for e in fs.list(at) if not e.name.startswith(("_", "."))]
        dirs = [e for e in children if e.is_dir]
        if not dirs:
            return levels
        names = {e.name.partition("=")[0] for e in dirs if "=" in e.name}
        if len(names) != 1 or len(dirs) != len(children) or any("=" not in e.name for e in dirs):
            raise CompactionLayoutError(f"{at}: not one partition column a level: {sorted(e.name for e in children)[:5]}")
        levels.append(names.pop())
        at = dirs[0].path


def fragment_key(fragment: str) -> str:
    """Unescaped form of a partition's directory names."""
    return "/".join(unquote(level) for level in fragment.split("/"))


def _key_of(levels: list[str]) -> Column:
    """:func:`fragment_key` of a row's partition columns (read as text)."""
    return F.concat_ws("/", *[
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION_NAME))) for c in levels
    ])


def _listing(spark: SparkSession, levels: list[str], roots: list[str]) -> DataFrame:
    """``fragment, path, length, state`` of every data file below ``roots``;
    ``state`` hashes what tells a file from a later one."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
        .select("path", "length", "modificationTime")
    )
    depth = r"/(" + "/".join(regex_escape(c) + "=[^/]*" for c in levels) + r")/[^/]*$"
    fragment = F.regexp_extract("path", depth, 1) if levels else F.lit("")
    name = F.substring_index("path", "/", -1)
    return files.select(
        fragment.alias("fragment"), "path", "length",
        F.xxhash64(name, "length", F.unix_micros("modificationTime")).alias("state"),
    )


def _states(spark: SparkSession, levels: list[str], roots: list[str]) -> dict[str, tuple]:
    """File count and summed state of each partition, by fragment key."""
    rows = _listing(spark, levels, roots).groupBy("fragment").agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.col("state").cast("decimal(38,0)")).alias("state")
    )
    return {fragment_key(r["fragment"]): (r["files"], r["state"]) for r in rows.collect()}


def compaction_plan(
    spark: SparkSession,
    root: str,
    partition_column: str | None = None,
    partition_type: DataType | str | None = "date",
    start=None,
    target_bytes: int | None = DEFAULT_TARGET_BYTES,
    only_fragmented: bool = False,
    _levels: list[str] | None = None,
    _roots: list[str] | None = None,
) -> DataFrame:
    """``(<partition_column>, fragment, files, bytes, n_files)`` per partition to rewrite.

    ``start`` is an inclusive lower bound on the typed partition value. Where the
    column is the outermost level, only the directories on or after it are
    listed, so compacting today's partition never lists a year of history. Empty
    partitions are left out; ``only_fragmented`` also leaves out partitions that
    already have no more than ``n_files`` files. ``target_bytes=None`` takes the
    file system's default block size at ``root``.
    """
    root = root.rstrip("/")
    fs = HadoopFS(spark)
    if target_bytes is None:
        target_bytes = fs.default_block_size(root)
    levels = partition_levels(fs, root) if _levels is None else _levels
    if partition_column and levels and partition_column not in levels:
        raise CompactionLayoutError(f"{root} is partitioned by {levels}, not by {partition_column}")
    if _roots is not None:
        roots = _roots
    elif partition_column and levels[:1] == [partition_column]:
        roots = [f"{root}/{f}" for f in _selected_fragments(spark, root, partition_column, partition_type, start)]
    else:
        roots = [root] if levels or not partition_column else []
    if not roots:
        return spark.createDataFrame([], _plan_schema(partition_column, partition_type))
    listed = _listing(spark, levels, roots)
    keys = ["fragment"]
    if partition_column:
        value = partition_value_from_path(F.col("path"), partition_column, partition_type)
        listed = listed.withColumn(partition_column, value)
        keys = [partition_column, "fragment"]
        if start not in (None, ""):
            listed = listed.where(F.col(partition_column) >= F.lit(start).cast(partition_type or "string"))
    stats = listed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("bytes"),
        F.sum(F.col("state").cast("decimal(38,0)")).alias("state"),
    )
    plan = stats.where(F.col("bytes") > 0).withColumn("n_files", files_for("bytes", target_bytes))
    if only_fragmented:
        plan = plan.where(F.col("files") > F.col("n_files"))
    return plan.select(*keys, "files", "bytes", "n_files", "state")


def compact(
    spark: SparkSession,
    root: str,
    partition_column: str | None = None,
    partition_type: DataType | str | None = "date",
    start=None,
    target_bytes: int | None = DEFAULT_TARGET_BYTES,
    *,
    strategy: str = "auto",
    verify: str = "count",
    only_fragmented: bool = False,
    table: str | None = None,
    publish: str = "swap",
    on_error: str = "raise",
    journal: str | None = None,
    wave_partitions: int = WAVE_PARTITIONS,
    wave_files: int = WAVE_FILES,
    _fs: HadoopFS | None = None,
) -> CompactionResult:
    """Compact ``root`` (partitioned or flat, as its directories say) from ``start``.

    ``strategy``: ``"auto"`` is ``"packed"`` for partitioned and ``"coalesce"`` for
    flat folders, at every size. ``verify`` is ``"count"`` (footers only) or
    ``"checksum"`` (adds a whole-row ``xxhash64`` sum, one more scan).
    ``target_bytes`` is also the Parquet row group size of the new files.
    ``table`` gives the declared schema and is refreshed after the swap; with
    ``publish="pointer"`` its catalog locations are read and switched instead of
    directories below ``root`` being moved. ``on_error="isolate"`` goes on without
    the partitions that fail (an error only when all do). One compaction of a
    folder runs at a time; ``journal`` lets the next one continue it.
    """
    root = root.rstrip("/")
    if publish not in ("swap", "pointer") or on_error not in ("raise", "isolate"):
        raise ValueError(f"publish={publish!r}, on_error={on_error!r}")
    if publish == "pointer" and not (table and partition_column):
        raise ValueError("publish='pointer' needs a table and its partition column")
    fs = _fs or HadoopFS(spark)
    if target_bytes is None:
        target_bytes = fs.default_block_size(root)
    timings: dict[str, float] = {}
    clock = _Clock(timings)
    written = _journal_states(spark, fs, journal, root) if journal else {}
    base: dict[str, str] = {}  # fragment key -> folder the fragment lies in, if not root
    roots = None
    if publish == "pointer":
        from martlet.operators.versions import partition_locations

        levels = [partition_column]
        chosen = _selected(catalog_fragments(spark, table, partition_column, partition_type), partition_column, partition_type, start)
        located = partition_locations(spark, table, chosen)
        base = {fragment_key(f): at[: -len(f) - 1] for f, at in located.items() if at.endswith("/" + f)}
        roots = [at for f, at in located.items() if fragment_key(f) in base and fs.exists(at)]
    else:
        levels = partition_levels(fs, root)
    plan_rows = [
        r.asDict()
        for r in compaction_plan(
            spark, root, partition_column, partition_type, start, target_bytes, only_fragmented, levels, roots
        ).collect()
    ]
    result = CompactionResult(root=root, plan=plan_rows, timings=timings)
    by_key = {fragment_key(r["fragment"]): r for r in plan_rows}
    if len(by_key) < len(plan_rows) or any(levels and not r["fragment"] for r in plan_rows):
        raise CompactionLayoutError(f"{root}: partition directories that name one value twice, or files beside them")
    for key, row in by_key.items():
        row["path"] = f"{base.get(key, root)}/{row['fragment']}" if levels else root
    done = {k for k, r in by_key.items() if (r["files"], r["state"]) in written.get(k, ())}
    result.resumed = sorted(by_key[k]["path"] for k in done)
    todo = [r for k, r in by_key.items() if k not in done]
    clock.lap("plan")
    if not todo:
        return result
    if strategy == "auto":
        strategy = "packed" if levels else "coalesce"
    known = ("packed", "salted", "rebalance") if levels else ("coalesce", "salted", "rebalance")
    if strategy not in known:
        raise ValueError(f"unknown strategy {strategy!r} for this layout")
    result.strategy = strategy

    failed: dict[str, Exception] = {}
    groups = _schema_groups(spark, todo, levels, table, failed if on_error == "isolate" else None)
    clock.lap("schema")
    job = _Job(spark, fs, result, levels, strategy, verify, target_bytes, table, publish, journal, clock)
    for data_schema, rows in groups:
        for wave in _waves(rows, wave_partitions, wave_files):
            if on_error == "isolate":
                _halving(wave, lambda some: job.run_wave(some, data_schema), failed)
            else:
                job.run_wave(wave, data_schema)
    result.quarantined = {path: f"{type(e).__name__}: {str(e)[:500]}" for path, e in failed.items()}
    if len(failed) == len(todo):
        raise next(iter(failed.values()))
    spark.catalog.refreshByPath(root)
    if table:
        spark.catalog.refreshTable(table)
    return result


def _waves(rows: list[dict], partitions: int, files: int) -> list[list[dict]]:
    """Consecutive rows of at most ``partitions`` rows and ``files`` output files."""
    out: list[list[dict]] = []
    held = 0
    for row in rows:
        n = int(row["n_files"])
        if not out or len(out[-1]) == partitions or held + n > files:
            out.append([])
            held = 0
        out[-1].append(row)
        held += n
    return out


def _halving(rows: list[dict], attempt: Callable[[list[dict]], None], failed: dict[str, Exception]) -> None:
    """``attempt`` over ``rows``; where it fails over halves, down to single rows,
    whose errors go to ``failed`` by path. ``attempt`` must change nothing when it
    raises."""
    try:
        attempt(rows)
    except Exception as exc:
        if len(rows) == 1:
            failed[rows[0]["path"]] = exc
            return
        for half in (rows[: len(rows) // 2], rows[len(rows) // 2 :]):
            _halving(half, attempt, failed)


@dataclass
class _Job:
    """What the waves of one compaction share."""

    spark: SparkSession
    fs: HadoopFS
    result: CompactionResult
    levels: list[str]
    strategy: str
    verify: str
    target_bytes: int
    table: str | None
    publish: str
    journal: str | None
    clock: _Clock

    def run_wave(self, rows: list[dict], data_schema: StructType) -> None:
        """Rewrite, verify and publish some partitions; no change when it raises."""
        spark, fs, result, levels = self.spark, self.fs, self.result, self.levels
        run = uuid.uuid4().hex[:12]
        stage, backup = f"{result.root}__stage_{run}", f"{result.root}__backup_{run}"
        if self.publish == "pointer":
            from martlet.operators.versions import new_version

            stage = new_version(result.root)
        schema = StructType(data_schema.fields + [StructField(c, StringType()) for c in levels])
        obs = Observation(f"compact_{run}")
        metrics = [F.count(F.lit(1)).alias("rows")]
        if self.verify == "checksum":
            metrics.append(_checksum(data_schema).alias("checksum"))
        session = packing_session(spark, self.target_bytes) if self.strategy == "packed" else spark

        def scan(some: list[dict]) -> DataFrame:
            return _scan_rows(session, some, levels, schema)

        out = _rewritten(scan, rows, levels, self.strategy, lambda df: df.observe(obs, *metrics))
        # A file of the target size is one row group.
        writer = out.write.mode("errorifexists").option("parquet.block.size", str(max(self.target_bytes, MIN_ROW_GROUP)))
        if levels:
            writer = writer.partitionBy(*levels)
        with _job_group(spark, f"martlet-compact-{run}", f"compaction rewrite of {result.root}") as group:
            try:
                writer.parquet(stage)
            except Exception:
                fs.delete(stage)  # the source was not touched; drop the partial copy
                raise
        result.rewrite_jobs += len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        observed = obs.get
        self.clock.lap("rewrite")
        try:
            had = self._verify(rows, stage, data_schema, observed)
        except Exception:
            fs.delete(stage)
            raise
        self.clock.lap("verify")
        moving = {fragment_key(r["fragment"]): r for r in rows if had.get(fragment_key(r["fragment"]))}
        staged = _states(spark, levels, [stage])
        self._note(run, "staged", {r["fragment"]: staged[k] for k, r in moving.items()})
        swap = _point if self.publish == "pointer" else _swap
        swapped, conflicts = swap(spark, fs, self, stage, backup, moving)
        self._note(run, "published", {moving[k]["fragment"]: staged[k] for k in swapped})
        result.conflicts = sorted(result.conflicts + [moving[k]["path"] for k in conflicts])
        result.swapped = sorted(result.swapped + [moving[k]["path"] for k in swapped])
        result.rows_source += sum(had.values())
        result.rows_staged += sum(had.values())
        result.waves += 1
        self.clock.lap("swap")

    def _verify(self, rows: list[dict], stage: str, data_schema: StructType, observed: dict) -> dict[str, int]:
        """Rows per partition of the sources, which the staged copy must have, too."""
        spark, levels = self.spark, self.levels
        had: dict[str, int] = {}
        for base, some in _by_base(rows).items():
            had |= _footer_rows(spark, base, [r["path"] for r in some], levels)
        got = _footer_rows(spark, stage, [stage], levels)
        if had != got or int(observed["rows"]) != sum(had.values()):
            wrong = sorted(k for k in had.keys() | got.keys() if had.get(k) != got.get(k))
            raise CompactionVerifyError(
                f"staged rows {sum(got.values())}, source rows {sum(had.values())}, read {observed['rows']}; differ in {wrong[:5]}"
            )
        if self.verify == "checksum":
            staged = spark.read.schema(data_schema).option("recursiveFileLookup", "true").parquet(stage)
            if staged.agg(_checksum(data_schema).alias("c")).first()["c"] != observed["checksum"]:
                raise CompactionVerifyError("staged checksum differs from source")
        return had

    def _note(self, run: str, phase: str, states: dict[str, tuple]) -> None:
        if self.journal and states:
            now = _dt.datetime.now(_dt.timezone.utc)
            notes = [(run, f, phase, files, state, now) for f, (files, state) in states.items()]
            self.spark.createDataFrame(notes, _JOURNAL).coalesce(1).write.mode("append").parquet(self.journal)


def read_journal(spark: SparkSession, journal: str) -> DataFrame:
    """``run, fragment, phase, files, state, at`` of all waves noted so far."""
    return spark.read.schema(_JOURNAL).parquet(journal)


def _journal_states(spark: SparkSession, fs: HadoopFS, journal: str, root: str) -> dict[str, set]:
    """File states that earlier waves wrote, by fragment key; a swap that did not
    come to its end is finished first."""
    if not fs.exists(journal):
        return {}
    notes = read_journal(spark, journal).groupBy("fragment").agg(
        F.collect_set(F.struct("files", "state")).alias("states"),  # one a wave that rewrote the partition
        F.count_if(F.col("phase") == "staged").alias("staged"), F.count_if(F.col("phase") == "published").alias("published"),
    ).collect()
    if any(r["staged"] > r["published"] for r in notes):
        recover_interrupted_swap(spark, root, fs)
    return {fragment_key(r["fragment"]): {tuple(s) for s in r["states"]} for r in notes}


def recover_interrupted_swap(spark: SparkSession, root: str, _fs: HadoopFS | None = None) -> list[str]:
    """Finish the cleanup of a compaction whose driver died during the swap.

    For every ``<root>__backup_<run>`` sibling: a partition whose directory is
    missing gets its backup back (the old files); one already replaced keeps the
    new files (same rows, verified before the swap). Staging and backup folders
    are removed. Returns the restored paths.
    """
    fs = _fs or HadoopFS(spark)
    root = root.rstrip("/")
    parent, name = root.rsplit("/", 1)
    restored: list[str] = []

    def restore(saved: str, target: str) -> None:
        if not fs.exists(target):
            fs.rename(saved, target)
            restored.append(target)
            return
        for part in fs.list(saved):  # inner levels of a partition tree
            if part.is_dir and "=" in part.name:
                restore(part.path, f"{target}/{part.name}")

    for entry in fs.list(parent):
        if not entry.is_dir or not entry.name.startswith(name + "__"):
            continue
        run_dir = f"{parent}/{entry.name}"
        if entry.name.startswith(name + "__backup_"):
            restore(run_dir, root)
            if fs.exists(run_dir):
                fs.delete(run_dir)
        elif entry.name.startswith(name + "__stage_"):
            fs.delete(run_dir)
    spark.catalog.refreshByPath(root)
    return restored


def compact_directory(
    spark: SparkSession, directory: str, target_bytes: int = DEFAULT_TARGET_BYTES, **kwargs
) -> CompactionResult:
    """Compact one flat directory of Parquet files (no partition column)."""
    return compact(spark, directory, None, None, None, target_bytes, **kwargs)


# -- schema, scan and rewrite ---------------------------------------------------
def _schema_groups(
    spark: SparkSession, rows: list[dict], levels: list[str], table: str | None, failed: dict[str, Exception] | None
) -> list[tuple[StructType, list[dict]]]:
    """Schemas of the rewritten files and the partitions that each is for: one
    group, unless errors are isolated (``failed``) and partitions do not fit."""
    if failed is None:
        return [(_data_schema(spark, [r["path"] for r in rows], levels, table), rows)]
    found: list[tuple[StructType, list[dict]]] = []

    def probe(some: list[dict]) -> None:
        found.append((_data_schema(spark, [r["path"] for r in some], levels, table), some))

    _halving(rows, probe, failed)
    groups: list[tuple[StructType, list[dict]]] = []
    for schema, some in sorted(found, key=lambda x: -len(x[1])):
        for i, (known, others) in enumerate(groups):
            fused = _fused(known, schema)
            if fused is not None:
                groups[i] = (fused, others + some)
                break
        else:
            groups.append((schema, some))
    return groups


def _fused(a: StructType, b: StructType) -> StructType | None:
    """Both schemas' columns; ``None`` where a column has two types."""
    types = {f.name.lower(): f for f in a.fields}
    if any(f.name.lower() in types and types[f.name.lower()].dataType != f.dataType for f in b.fields):
        return None
    return StructType(a.fields + [f for f in b.fields if f.name.lower() not in types])


def _data_schema(spark: SparkSession, paths: list[str], levels: list[str], table: str | None) -> StructType:
    """Schema of the rewritten files: declared, or merged over all of them."""
    try:
        # Leaf directories are their own base: no partition columns are added.
        merged = spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except Exception as exc:
        if "CANNOT_MERGE" in str(exc) or "merge" in str(exc).lower():
            raise CompactionSchemaError(f"files of different types: {exc}") from exc
        raise
    clash = [f.name for f in merged.fields if f.name in levels]
    if clash:
        raise CompactionSchemaError(f"partition columns {clash} are stored in the files, too")
    if not table:
        return merged
    declared = StructType([f for f in spark.table(table).schema.fields if f.name not in levels])
    known = {f.name.lower(): f for f in declared.fields}
    for f in merged.fields:
        if f.name.lower() not in known:
            raise CompactionSchemaError(f"{table} does not declare column {f.name}, which files hold")
        if _plain(known[f.name.lower()].dataType) != _plain(f.dataType):
            raise CompactionSchemaError(f"{table} declares {f.name} as {known[f.name.lower()].dataType}, files hold {f.dataType}")
    return declared


def _plain(data_type: DataType) -> str:
    return data_type.simpleString().lower()


def packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A child session whose scans pack whole files into splits of ``target_bytes``
    at any number of cores, and whose writes need no sort by the partition columns
    (a task holds one partition's rows)."""
    return child_session(spark, {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.maxConcurrentOutputFileWriters": "4",
    })


def _by_base(rows: list[dict]) -> dict[str, list[dict]]:
    """Plan rows by the folder their fragments lie in."""
    out: dict[str, list[dict]] = {}
    for r in rows:
        base = r["path"][: -len(r["fragment"]) - 1] if r["fragment"] else r["path"]
        out.setdefault(base, []).append(r)
    return out


def _scan(spark: SparkSession, root: str, paths: list[str], schema: StructType) -> DataFrame:
    """The selected files with their partition values as text."""
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _scan_rows(spark: SparkSession, rows: list[dict], levels: list[str], schema: StructType) -> DataFrame:
    return _union([_scan(spark, base, [r["path"] for r in some], schema) for base, some in _by_base(rows).items()])


def _union(frames: list[DataFrame]) -> DataFrame:
    """Union as a balanced tree, so that building it stays cheap."""
    while len(frames) > 1:
        frames = [a.unionAll(b) for a, b in zip(frames[::2], frames[1::2])] + frames[len(frames) // 2 * 2 :]
    return frames[0]


def _rewritten(scan, plan_rows: list[dict], levels: list[str], strategy: str, watched=lambda df: df) -> DataFrame:
    """The rows of ``scan(plan_rows)`` laid out for the write; ``watched`` is
    applied at the scan."""
    total = int(sum(int(r["n_files"]) for r in plan_rows))
    if strategy == "packed":
        return watched(_union([scan([r]).coalesce(int(r["n_files"])) for r in plan_rows]))
    data = scan(plan_rows)
    if strategy == "coalesce":
        return watched(data).coalesce(total)
    if strategy == "rebalance":
        return watched(data).hint("rebalance", *levels)
    columns = data.columns
    data = watched(data.withColumn(_POSITION, row_position(data)))
    if not levels:
        return data.repartition(total, F.pmod(_POSITION, F.lit(total))).select(*columns)
    # One row a partition of the wave: at most WAVE_PARTITIONS.
    plan = data.sparkSession.createDataFrame(
        [(fragment_key(r["fragment"]), int(r["n_files"])) for r in plan_rows], f"{_KEY} string, {_N} long"
    )
    keyed = data.withColumn(_KEY, _key_of(levels)).join(F.broadcast(plan), _KEY)
    salt = F.pmod(F.xxhash64(_POSITION), F.col(_N))
    return keyed.repartition(total, _KEY, salt).select(*columns)


@contextmanager
def _job_group(spark: SparkSession, group: str, description: str):
    """Tag the jobs run inside with ``group``; restore the caller's tags after."""
    sc = spark.sparkContext
    keys = ("spark.jobGroup.id", "spark.job.description")
    before = {k: sc.getLocalProperty(k) for k in keys}
    sc.setLocalProperty("spark.jobGroup.id", group)
    sc.setLocalProperty("spark.job.description", description)
    try:
        yield group
    finally:
        for k, v in before.items():
            sc.setLocalProperty(k, v)


# -- verification ------------------------------------------------------------------
def _footer_rows(spark: SparkSession, root: str, paths: list[str], levels: list[str]) -> dict[str, int]:
    """Rows per partition (by fragment key) from the file footers; partitions
    without rows are left out."""
    reader = child_session(spark, {
        "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }).read
    data = reader.option("basePath", root).parquet(*paths)
    if not levels:
        n = data.count()
        return {"": n} if n else {}
    counts = data.groupBy(*levels).agg(F.count(F.lit(1)).alias("n")).select(_key_of(levels).alias("k"), "n")
    return {r["k"]: int(r["n"]) for r in counts.where("n > 0").collect()}


def _holds_map(data_type: DataType) -> bool:
    if isinstance(data_type, MapType):
        return True
    if isinstance(data_type, ArrayType):
        return _holds_map(data_type.elementType)
    return isinstance(data_type, StructType) and any(_holds_map(f.dataType) for f in data_type.fields)


def _checksum(schema: StructType):
    """Sum of whole-row hashes; columns that hold maps are hashed as JSON."""
    parts = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if _holds_map(f.dataType) else F.col(f"`{f.name}`") for f in schema.fields]
    return F.sum(F.xxhash64(*parts).cast("decimal(38,0)"))


# -- swap -----------------------------------------------------------------------
def _changed(spark, levels: list[str], by_key: dict[str, dict]) -> set[str]:
    """Partitions whose files are no longer those the plan saw."""
    now = _states(spark, levels, [r["path"] for r in by_key.values()])
    return {k for k, r in by_key.items() if now.get(k) != (r["files"], r["state"])}


def _staged_fragments(spark, levels: list[str], stage: str) -> dict[str, str]:
    found = _listing(spark, levels, [stage]).select("fragment").distinct().collect()
    return {fragment_key(r["fragment"]): r["fragment"] for r in found}


def _point(spark, fs, job: _Job, stage, backup, by_key: dict[str, dict]) -> tuple[list[str], list[str]]:
    """Point the catalog to the staged partitions. Returns the keys of the switched
    partitions and of those left alone because their files changed."""
    from martlet.operators.versions import Switch

    changed = _changed(spark, job.levels, by_key) if by_key else set()
    staged = _staged_fragments(spark, job.levels, stage) if by_key else {}
    switch = Switch(spark, job.table)
    try:
        for key, row in by_key.items():
            if key not in changed:
                switch.point(row["fragment"], f"{stage}/{staged[key]}", old=row["path"])
        # A writer that had listed the old directory may have finished since.
        for key in _changed(spark, job.levels, {k: r for k, r in by_key.items() if k not in changed}):
            switch.undo(by_key[key]["fragment"])
            changed.add(key)
    except Exception:
        switch.undo_all()
        raise
    return [k for k in by_key if k not in changed], sorted(changed)


def _swap(spark, fs, job: _Job, stage, backup, by_key: dict[str, dict]) -> tuple[list[str], list[str]]:
    """Move the staged partitions in. Returns the keys of the swapped partitions
    and of those left alone because their files changed."""
    root, levels = job.result.root, job.levels
    read = {k: (r["files"], r["state"]) for k, r in by_key.items()}
    changed = _changed(spark, levels, by_key) if by_key else set()
    if levels:
        staged = _staged_fragments(spark, levels, stage)
        pairs = {
            k: (f"{root}/{r['fragment']}", f"{stage}/{staged[k]}", f"{backup}/{r['fragment']}")
            for k, r in by_key.items() if k not in changed
        }
    else:
        pairs = {k: (root, stage, backup) for k in by_key if k not in changed}
    # state per partition: 0 untouched, 1 source moved to backup, 2 staged installed
    state = dict.fromkeys(pairs, 0)

    def swap_one(key: str) -> None:
        target, new, saved = pairs[key]
        fs.rename(target, saved)
        state[key] = 1
        fs.rename(new, target)
        state[key] = 2

    def put_back(key: str) -> None:
        target, _new, saved = pairs[key]
        if state[key] == 2 or (state[key] and fs.exists(target)):
            fs.delete(target)
        if state[key]:
            fs.rename(saved, target)

    try:
        _run_all(swap_one, list(pairs))
        if pairs:
            # A writer that listed the folder before the rename may have finished since.
            late = _states(spark, levels, [saved for _, _, saved in pairs.values()])
            for key in [k for k in pairs if late.get(k) != read[k]]:
                put_back(key)
                changed.add(key)
    except Exception:
        for key in pairs:
            put_back(key)
        raise
    fs.delete(backup)
    fs.delete(stage)
    return [k for k in pairs if k not in changed], sorted(changed)


def _run_all(fn, items, threads: int = 16) -> None:
    """Run ``fn`` over ``items`` on a small driver thread pool (metadata calls
    only); every call finishes before the first error is raised."""
    items = list(items)
    if len(items) <= 1:
        for item in items:
            fn(item)
        return
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(threads, len(items))) as pool:
        futures = [pool.submit(fn, item) for item in items]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]


def _selected_fragments(spark, root, column, data_type, start) -> list[str]:
    """Partition directory names below ``root`` on or after ``start`` (typed)."""
    from martlet.operators.partitions import disk_partitions

    return _selected(disk_partitions(spark, root, column, data_type), column, data_type, start)


def catalog_fragments(spark, table, column, data_type) -> DataFrame:
    from martlet.operators.partitions import catalog_partitions

    return catalog_partitions(spark, table, column, data_type)


def _selected(dirs: DataFrame, column, data_type, start) -> list[str]:
    if start not in (None, ""):
        dirs = dirs.where(F.col(column) >= F.lit(start).cast(data_type or "string"))
    return sorted(r["fragment"] for r in dirs.select("fragment").collect())


def _plan_schema(column: str | None, data_type) -> StructType:
    from pyspark.sql.types import DecimalType, LongType, _parse_datatype_string

    if isinstance(data_type, str):
        data_type = _parse_datatype_string(data_type)
    first = [StructField(column, data_type or StringType())] if column else []
    return StructType(first + [
        StructField("fragment", StringType()),
        StructField("files", LongType()),
        StructField("bytes", LongType()),
        StructField("n_files", LongType()),
        StructField("state", DecimalType(38, 0)),
    ])

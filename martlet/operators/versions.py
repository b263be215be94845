"""Versioned partitions: new files beside the old ones, and a catalog pointer.

A load or a compaction that moves directories leaves a moment in which a reader
misses a partition. Here it writes the partition into a directory of its own,
``<location>/_versions/<version>/<column>=<value>``, and then points the catalog
there (``ALTER TABLE … PARTITION … SET LOCATION``, or ``ADD PARTITION … LOCATION``
for a new one). A query takes the location when it is planned, so it reads the old
files or the new ones, and both are there: old versions go only in
:func:`vacuum_versions`, after a time that outlasts the queries.

Several tables are published together by one :class:`Switch`: their rows are
staged and checked first, which is the long part; then the pointers are switched,
and whatever fails takes the ones already switched back.

``_versions`` is hidden from directory listings, so a versioned mart is read
through the catalog. Repairs must not point a partition back to a retired directory:
:func:`martlet.operators.partitions.repair_partitions` leaves partitions that the
catalog knows alone, and :func:`recreate_versioned` keeps the pointers over a drop
and create.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlet.operators.load import (
    EmptySourceError,
    LoadResult,
    SourceChangedError,
    check_columns,
    observed_facts,
    pinned_source,
    snapshot_rows,
)
from martlet.operators.partitions import catalog_partitions, disk_partitions, partition_clause, repair_partitions
from martlet.functions.calendar import launch_date
from martlet.plans.spec import MartSpec, ensure_table, partition_literal
from martlet.session import unique_name
from martlet.sources.hadoop_fs import HadoopFS
from martlet.sources.tables import quote_identifier, table_location

VERSIONS = "_versions"


def new_version(root: str) -> str:
    """A folder for one version's partitions; its name tells when it was made."""
    return f"{root.rstrip('/')}/{VERSIONS}/v{time.time_ns() // 1_000_000}-{uuid.uuid4().hex[:12]}"


def partition_location(spark: SparkSession, table: str, fragment: str) -> str | None:
    """Where the catalog has one partition; ``None`` if it does not know it."""
    shown = spark.sql(f"SHOW PARTITIONS {quote_identifier(table)} {partition_clause(fragment)}")
    if shown.isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_identifier(table)} {partition_clause(fragment)}")
    at = [r["data_type"] for r in described.where("col_name = 'Location'").collect()]
    # The partition's own details come before the table's.
    return at[0].rstrip("/") if at else None


def partition_locations(spark: SparkSession, table: str, fragments: list[str]) -> dict[str, str]:
    """Locations of the given partitions that the catalog knows."""
    found = {f: partition_location(spark, table, f) for f in fragments}
    return {f: at for f, at in found.items() if at is not None}


class Switch:
    """Pointer changes that can be taken back, over any number of tables."""

    def __init__(self, spark: SparkSession, table: str | None = None):
        self._spark, self._table = spark, table
        self._undo: list[tuple[str, str, str | None]] = []

    def point(self, fragment: str, location: str, table: str | None = None, old: str | None = None) -> None:
        """Point a partition to ``location``; ``old`` saves a look-up where known."""
        table = table or self._table
        if old is None:
            old = partition_location(self._spark, table, fragment)
        self._set(table, fragment, location, known=old is not None)
        self._undo.append((table, fragment, old))

    def undo(self, fragment: str, table: str | None = None) -> None:
        """Take back the last change of one partition."""
        table = table or self._table
        for i in range(len(self._undo) - 1, -1, -1):
            if self._undo[i][:2] == (table, fragment):
                self._back(*self._undo.pop(i))
                return

    def undo_all(self) -> None:
        """Take every change back, the last one first."""
        while self._undo:
            self._back(*self._undo.pop())

    def _back(self, table: str, fragment: str, old: str | None) -> None:
        if old is None:
            self._spark.sql(f"ALTER TABLE {quote_identifier(table)} DROP IF EXISTS {partition_clause(fragment)}")
        else:
            self._set(table, fragment, old, known=True)
        self._spark.catalog.refreshTable(table)

    def _set(self, table: str, fragment: str, location: str, known: bool) -> None:
        clause, at = partition_clause(fragment), location.replace("\\", "\\\\").replace("'", "\\'")
        name = quote_identifier(table)
        if known:
            self._spark.sql(f"ALTER TABLE {name} {clause} SET LOCATION '{at}'")
        else:
            self._spark.sql(f"ALTER TABLE {name} ADD {clause} LOCATION '{at}'")
        self._spark.catalog.refreshTable(table)


@dataclass(frozen=True)
class StagedLoad:
    """A checked snapshot that no reader sees yet."""

    spec: MartSpec
    fragment: str
    path: str
    result: LoadResult


def stage_snapshot(
    spark: SparkSession, spec: MartSpec, source: str | DataFrame, *, loading_id: int, load_date: _dt.date | str | None = None
) -> StagedLoad:
    """Write the snapshot of ``source`` as a version of the ``load_date`` partition.

    The lineage id and the rows come from one pinned file set where the source has
    one; the write observes count and newest load id of what it read, and a
    difference raises :class:`SourceChangedError` before anything is published.
    """
    if load_date is None:
        load_date = launch_date()
    if isinstance(load_date, str):
        load_date = _dt.date.fromisoformat(load_date)
    ensure_table(spark, spec)
    src, facts = pinned_source(spark, source, spec.source_load_id_column)
    if facts["src_loading_id"] is None:
        raise EmptySourceError(f"source has no {spec.source_load_id_column} ({facts['source_rows']} rows); nothing staged")
    written = Observation(f"stage_{uuid.uuid4().hex[:12]}")
    rows = snapshot_rows(src.observe(written, *observed_facts(spec.source_load_id_column)), spec, facts["src_loading_id"], loading_id)
    check_columns(rows, [f.name for f in spec.columns.fields])
    fragment = _fragment(spark, spec, load_date)
    root = table_location(spark, spec.table).rstrip("/")
    path = f"{new_version(root)}/{fragment}"
    # An unpartitioned table over the version's directory: the insert checks types
    # as any other insert does, and its files stay when the table is dropped.
    stage = unique_name("martlet_stage")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.columns.fields)
    spark.sql(f"CREATE TABLE {stage} ({columns}) USING parquet LOCATION '{path}'")
    try:
        spark.sql(f"INSERT INTO {stage} BY NAME SELECT * FROM {{rows}}", rows=rows)
    except Exception:
        HadoopFS(spark).delete(path.rsplit("/", 1)[0])
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
    seen = written.get
    if (seen["rows"], seen["newest"]) != (facts["source_rows"], facts["src_loading_id"]):
        HadoopFS(spark).delete(path.rsplit("/", 1)[0])
        raise SourceChangedError(f"{seen} read for {spec.table}, but the lineage id was taken from {facts.asDict()}")
    result = LoadResult(
        table=spec.table, load_date=load_date, source_rows=int(facts["source_rows"]),
        src_loading_id=int(facts["src_loading_id"]), loading_id=loading_id, rows_written=int(seen["rows"]),
    )
    return StagedLoad(spec, fragment, path, result)


def _fragment(spark: SparkSession, spec: MartSpec, load_date: _dt.date) -> str:
    """The partition's name in the catalog: the known one, or as Spark writes it."""
    value = F.expr(partition_literal(spec, load_date))
    known = catalog_partitions(spark, spec.table, spec.partition_column, spec.partition_type)
    names = sorted(r["fragment"] for r in known.where(F.col(spec.partition_column) == value).collect())
    if names:
        return names[0]
    text = spark.range(1).select(value.cast("string")).first()[0]
    return f"{spec.partition_column}={text.replace(':', '%3A')}"


def publish_staged(spark: SparkSession, staged: list[StagedLoad]) -> list[LoadResult]:
    """Switch all staged partitions in, or none: an error takes back what was
    switched and is raised."""
    switch = Switch(spark)
    try:
        for s in staged:
            switch.point(s.fragment, s.path, table=s.spec.table)
    except Exception:
        switch.undo_all()
        raise
    return [s.result for s in staged]


def load_together(
    spark: SparkSession, targets: list[tuple[MartSpec, str | DataFrame]], *, loading_id: int, load_date: _dt.date | str | None = None
) -> list[LoadResult]:
    """Snapshots of several marts, published together: when one of them cannot be
    loaded or switched, every mart still shows its earlier rows."""
    load_date = load_date or launch_date()
    staged: list[StagedLoad] = []
    try:
        for spec, source in targets:
            staged.append(stage_snapshot(spark, spec, source, loading_id=loading_id, load_date=load_date))
        return publish_staged(spark, staged)
    except Exception:
        for s in staged:
            HadoopFS(spark).delete(s.path.rsplit("/", 1)[0])
        raise


def recreate_versioned(spark: SparkSession, spec: MartSpec) -> None:
    """Drop and create a versioned mart; the pointers are put back, and partitions
    only the disk knows are added."""
    pointers: dict[str, str] = {}
    if spark.catalog.tableExists(spec.table):
        shown = catalog_partitions(spark, spec.table, spec.partition_column)
        pointers = partition_locations(spark, spec.table, [r["fragment"] for r in shown.collect()])
    HadoopFS(spark).mkdirs(spec.location)
    spark.sql(spec.drop_statement())
    spark.sql(spec.create_statement())
    switch = Switch(spark, spec.table)
    for fragment, location in pointers.items():
        switch.point(fragment, location)
    repair_partitions(spark, spec)


def vacuum_versions(spark: SparkSession, spec: MartSpec, older_than_hours: float = 24.0) -> list[str]:
    """Delete the directories that no pointer names and that are older than the
    given time, by their version's name; the directory a partition had below the
    mart itself goes once its pointer is a version that old. Returns the paths."""
    fs, root = HadoopFS(spark), table_location(spark, spec.table).rstrip("/")
    limit = time.time() * 1000 - older_than_hours * 3_600_000

    def old(path: str) -> bool:
        version = path.rsplit("/", 2)[1]
        return version.startswith("v") and int(version[1:].partition("-")[0]) <= limit

    found: dict[str, list[str]] = {}
    for version in fs.list(f"{root}/{VERSIONS}"):
        for part in fs.list(version.path):
            if "=" in part.name and part.is_dir:
                found.setdefault(part.name, []).append(part.path)
    on_disk = {r["fragment"] for r in disk_partitions(spark, root, spec.partition_column).collect()}
    doomed = []
    for fragment, paths in found.items():
        at = partition_location(spark, spec.table, fragment)
        doomed += [p for p in paths if old(p) and (at is None or not _same(fs, p, at))]
        if at is not None and fragment in on_disk and any(_same(fs, p, at) and old(p) for p in paths):
            doomed.append(f"{root}/{fragment}")
    fs.delete_many(doomed)
    for version in fs.list(f"{root}/{VERSIONS}"):
        if not [e for e in fs.list(version.path) if e.is_dir]:
            fs.delete(version.path)
    return sorted(doomed)


def _same(fs: HadoopFS, a: str, b: str) -> bool:
    return fs.qualify(a).rstrip("/") == fs.qualify(b).rstrip("/")

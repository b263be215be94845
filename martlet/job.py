"""The whole snapshot-mart run as one library call.

One run: count the marts, load a full snapshot of each source into the launch
date's partition (optionally clearing everything else first), compact the new
files, rediscover partitions, count again, publish the five load statistics and
the run-status events. Every step is an operator of this package; the driver
holds only scalars, partition names and the handful of run-log records.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from martlet.functions.calendar import launch_date
from martlet.functions.runlog import (
    CTL_INFO,
    ERROR,
    INFO,
    envelope,
    log_lines,
    status_events,
)
from martlet.operators.compact import DEFAULT_TARGET_BYTES, compact
from martlet.operators.load import LoadResult, force_load, load_snapshot
from martlet.operators.stats import (
    load_stat_rows,
    newest_partition,
    publish_stats,
    table_row_count,
)
from martlet.operators.versions import load_together
from martlet.plans.spec import MartSpec, ensure_table, refreshed
from martlet.sources.tables import table_location
from martlet.streaming.runlog_sinks import append_parquet, append_text

@dataclass(frozen=True)
class MartTarget:
    spec: MartSpec
    source: str | DataFrame
    business_date_column: str | None = None


@dataclass
class JobConfig:
    targets: list[MartTarget]
    loading_id: int
    entity_id: int
    load_date: _dt.date | str | None = None
    force: bool = False
    rebalance: bool = False
    parallel_loads: bool = False
    together: bool = False  # publish all marts or none, as versions (see operators.versions)
    compact_files: bool = True
    repair: bool = False  # drop, create and rediscover every partition, before and after
    count_rows: bool = False  # whole-mart counts, before and after
    target_file_bytes: int | None = DEFAULT_TARGET_BYTES
    stats_path: str | None = None
    status_path: str | None = None
    lines_path: str | None = None
    events_path: str | None = None
    app_id: str | None = None


@dataclass
class JobReport:
    load_date: _dt.date
    counts_before: dict[str, int] = field(default_factory=dict)
    counts_after: dict[str, int] = field(default_factory=dict)
    loads: dict[str, LoadResult] = field(default_factory=dict)
    compacted_partitions: dict[str, int] = field(default_factory=dict)
    quarantined: dict[str, str] = field(default_factory=dict)
    log: list[tuple] = field(default_factory=list)


_LOG_SCHEMA = StructType(
    [
        StructField("created", TimestampType()),
        StructField("levelno", IntegerType()),
        StructField("message", StringType()),
        StructField("name", StringType()),
    ]
)


def run_mart_job(spark: SparkSession, cfg: JobConfig) -> JobReport:
    """Run the snapshot-mart job; raises on the first failing step (after
    recording an ERROR status event when a status sink is configured)."""
    day = cfg.load_date or launch_date()
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    report = JobReport(load_date=day)

    def log(level: int, message: str) -> None:
        report.log.append((_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), level, message, "martlet.job"))

    try:
        if cfg.count_rows:
            # Whole-mart counts, as the reference logs them (footer row counts;
            # skip on very large marts - the rows of each load are known anyway).
            for t in cfg.targets:
                report.counts_before[t.spec.table] = table_row_count(spark, t.spec.table)
        if cfg.repair:
            # The declared schema and any partition directories written by others.
            refreshed(spark, *[t.spec for t in cfg.targets])
        else:
            for t in cfg.targets:
                ensure_table(spark, t.spec)
        loader = force_load if cfg.force else load_snapshot

        def load_one(t: MartTarget) -> LoadResult:
            return loader(
                spark, t.spec, t.source, loading_id=cfg.loading_id, load_date=day,
                rebalance=cfg.rebalance,
            )

        if cfg.together and cfg.force:
            raise ValueError("a force load drops partitions and cannot be published together")
        if cfg.together:
            results = load_together(spark, [(t.spec, t.source) for t in cfg.targets], loading_id=cfg.loading_id, load_date=day)
        elif cfg.parallel_loads and len(cfg.targets) > 1:
            # Independent Spark jobs; overlapping them fills the cluster's slack.
            from concurrent.futures import ThreadPoolExecutor

            with ThreadPoolExecutor(max_workers=len(cfg.targets)) as pool:
                results = list(pool.map(load_one, cfg.targets))
        else:
            results = [load_one(t) for t in cfg.targets]
        for t, res in zip(cfg.targets, results):
            report.loads[t.spec.table] = res
            log(INFO, f"loaded {res.rows_written} rows into {t.spec.table} for {day}")
        if cfg.compact_files:
            for t in cfg.targets:
                done = compact(
                    spark,
                    table_location(spark, t.spec.table),
                    t.spec.partition_column,
                    t.spec.partition_type,
                    day,
                    cfg.target_file_bytes,
                    only_fragmented=True,
                    table=t.spec.table,
                    publish="pointer" if cfg.together else "swap",
                    on_error="isolate",
                )
                for path, reason in done.quarantined.items():
                    log(CTL_INFO, f"not compacted: {path}: {reason}")
                report.quarantined |= done.quarantined
                report.compacted_partitions[t.spec.table] = len(done.swapped)
        if cfg.repair:
            # Again after the compaction; it costs a listing and the statements of
            # the difference, usually none.
            refreshed(spark, *[t.spec for t in cfg.targets])
        if cfg.count_rows:
            for t in cfg.targets:
                report.counts_after[t.spec.table] = table_row_count(spark, t.spec.table)
        if cfg.stats_path and cfg.targets:
            first = cfg.targets[0]
            rows = load_stat_rows(
                spark.table(first.spec.table),
                loading_id=cfg.loading_id,
                entity_id=cfg.entity_id,
                load_date=day,
                app_id=cfg.app_id or spark.sparkContext.applicationId,
                partition_column=first.spec.partition_column,
                business_date_column=first.business_date_column,
                newest_partition_value=newest_partition(
                    spark, first.spec.table, first.spec.partition_column, first.spec.partition_type
                ),
            )
            publish_stats(rows, cfg.stats_path)
        loaded = {k: v.rows_written for k, v in report.loads.items()}
        log(CTL_INFO, f"SUCCESS: loaded {loaded}, mart rows {report.counts_after or 'not counted'}")
    except Exception as exc:
        log(ERROR, f"FAILED: {type(exc).__name__}: {exc}")
        try:
            _publish_status(spark, cfg, report)
        except Exception as sink_error:  # the step's own error is the one to raise
            exc.add_note(f"the run status could not be published: {sink_error}")
        raise
    _publish_status(spark, cfg, report)
    return report


def job_log(spark: SparkSession, report: JobReport) -> DataFrame:
    """The run's own log records as a DataFrame (a handful of rows)."""
    return spark.createDataFrame(report.log, _LOG_SCHEMA)


def _publish_status(spark: SparkSession, cfg: JobConfig, report: JobReport) -> None:
    """Ship the run's log records: status rows above INFO, text lines, JSON events."""
    if not report.log:
        return
    records = job_log(spark, report)
    if cfg.status_path:
        append_parquet(status_events(records, cfg.loading_id), cfg.status_path)
    if cfg.lines_path:
        append_text(log_lines(records), cfg.lines_path, "line")
    if cfg.events_path:
        app_id = cfg.app_id or spark.sparkContext.applicationId
        append_text(envelope(records, app_id), cfg.events_path, "payload")

"""martlet: publish source tables into partitioned Parquet marts with Spark.

Sub-packages:

* ``plans``      – mart specifications and the DDL derived from them
* ``sources``    – table scans, file listings, driver-side file-system metadata
* ``operators``  – snapshot load, statistics, partition lifecycle, compaction
* ``functions``  – column builders: report-date windows, numbered names, run-log shapes
* ``streaming``  – run-log sinks for batch and Structured Streaming DataFrames

The most used entry points are re-exported here.
"""

from martlet.functions.calendar import launch_date, month_window
from martlet.functions.runlog import envelope, log_lines, status_events
from martlet.functions.steps import numbered_files, run_numbered_sql, with_steps
from martlet.job import JobConfig, MartTarget, run_mart_job
from martlet.operators.compact import compact, compact_directory, compaction_plan, recover_interrupted_swap
from martlet.operators.load import EmptySourceError, force_load, load_snapshot
from martlet.operators.partitions import apply_retention, apply_retention_to_path, drop_all_partitions
from martlet.operators.stats import load_stat_rows, max_cdc_date, publish_stats, scalar, table_stats
from martlet.plans.spec import MartSpec, merchant_spec, payroll_spec, recreate
from martlet.session import get_session, new_work_dir, work_root

__all__ = [
    "EmptySourceError",
    "JobConfig",
    "MartSpec",
    "MartTarget",
    "apply_retention",
    "apply_retention_to_path",
    "compact",
    "compact_directory",
    "compaction_plan",
    "drop_all_partitions",
    "envelope",
    "force_load",
    "get_session",
    "launch_date",
    "load_snapshot",
    "load_stat_rows",
    "log_lines",
    "max_cdc_date",
    "merchant_spec",
    "month_window",
    "new_work_dir",
    "numbered_files",
    "payroll_spec",
    "publish_stats",
    "recover_interrupted_swap",
    "recreate",
    "run_mart_job",
    "run_numbered_sql",
    "scalar",
    "status_events",
    "table_stats",
    "with_steps",
    "work_root",
]

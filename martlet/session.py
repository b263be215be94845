"""Session helpers and the shared work folder.

Everything the toolkit writes on its own behalf (staging copies, backups, the
fixtures of the registered queries) goes below the folder the cluster names in
``spark.checkpoint.dir``. That setting is read from the session; only when it is
unset (unit tests, a bare local session) do we point it at a fresh local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WORK_SUBDIR = "martlet-work"


def get_session(
    app_name: str = "martlet",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the toolkit relies on.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster leave them to the submit configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # ANSI store assignment: overflow and bad casts raise on insert.
        "spark.sql.storeAssignmentPolicy": "ANSI",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for the toolkit's own files, from ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # A bare local session (tests): pick a private folder. Later calls find
        # it through getCheckpointDir(). A local-cluster has its executors on
        # this machine, too.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martlet-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def child_session(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A session of the same context and catalog with the caller's run-time SQL
    settings and ``conf`` on top; the caller's session is not changed."""
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            child.conf.set(key, value)
    for key, value in conf.items():
        child.conf.set(key, value)
    return child


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(work_root(df.sparkSession))
    return df.checkpoint()


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the work root."""
    return f"{work_root(spark)}/{_WORK_SUBDIR}/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A catalog-safe unique table name."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect the local disk)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return os.path.abspath(path)

"""Session helpers: builder for local runs, per-query defaults, shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "skiff",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session. On a cluster the launcher provides master and memory;
    this only fills in what is unset."""
    master = master or os.environ.get("SKIFF_MASTER", "local[8]")
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Runtime settings every skiff query relies on.

    Naive timestamps in the inputs are read as UTC wall-clock time, so the session
    zone is pinned to UTC (event time → epoch seconds → window bounds → text).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``. Only when none is configured on a
    local master (tests) a private directory is created and registered as the
    checkpoint dir; a cluster without the setting is refused.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir returns <dir>/<uuid>; the parent is the shared folder
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        # executors cannot see a folder on the driver's disk
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a shared folder (e.g. on the "
            "cluster file system) for materialised tables and stream checkpoints"
        )
    local = tempfile.mkdtemp(prefix="skiff-ckpt-")
    sc.setCheckpointDir(local)
    return local


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the scratch root for one run."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"

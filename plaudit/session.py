"""Session helpers.

Library code never creates its own session; these helpers exist for tests,
the benchmark and the command line. On a cluster the submitter owns the
configuration, and ``checkpoint_root`` only reads ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import warnings

from pyspark.sql import SparkSession


def _default_driver_memory() -> str:
    """60 % of physical memory, at most 16g (local mode runs in the driver)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "plaudit", event_log_dir: str | None = None) -> SparkSession:
    """Local session used by tests and bench; AQE on, UI off.

    ``event_log_dir`` turns on Spark's event log there (stage and task times
    without the web UI)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PLAUDIT_DRIVER_MEMORY", _default_driver_memory()))
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses the cluster's ``spark.checkpoint.dir``. Only when that is unset and
    the master is local (a test run) a scratch folder is created; on a
    cluster an unset folder is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: plaudit writes its lineage cuts there and "
                "needs a folder every executor can read (for example on HDFS or S3)")
        root = tempfile.mkdtemp(prefix="plaudit-ckpt-")
    elif root.startswith("file:") and not sc.master.startswith("local"):
        # a shared mount looks like this too, so the setting is followed
        warnings.warn(f"spark.checkpoint.dir is {root}: every executor must see this folder", stacklevel=2)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root

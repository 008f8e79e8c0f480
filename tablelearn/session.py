"""Session helpers: one place for the Spark settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "tablelearn",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session tuned for aggregation-heavy jobs.

    On a cluster the master and most settings come from spark-submit; here we
    only fill in what is unset so cluster configuration always wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # model parameters enter plans as literal expressions built from Python;
        # per-call stack capture for error context costs more than the job itself
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # tree levels, boosting rounds and A3 write checkpoints; drop them once
        # the checkpointed DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in defaults.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only pick a local one when the
    setting is absent (tests, local runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tablelearn-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tablelearn", name)

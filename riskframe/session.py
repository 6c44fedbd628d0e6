"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a laptop and on a cluster alike; cluster-specific sizes
# (executor memory, shuffle partitions at scale) come from the submitting job.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Long jobs: let the context cleaner drop unreferenced shuffles, broadcasts
    # and checkpoint files instead of accumulating them for the whole session.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.cleaner.periodicGC.interval": "2min",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskframe", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a local one only when unset.

    On a cluster the setting must name a shared folder every executor can reach;
    without it this raises. The fallback is for local masters (tests, laptops).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

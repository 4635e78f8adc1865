"""Session helpers: one place for the runtime settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs need for correct results (UTC wall clock, dynamic
# partition replace) and for scale (AQE coalescing, skew-join splitting).
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot ip's join feeds an aggregate on the same keys; split it even so.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # Partition values are text ('01', not 1), as the jobs compare and concatenate them.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent).  Cluster
    settings such as ``spark.checkpoint.dir`` are left as the cluster set them."""
    for k, v in _RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables, as named by
    the cluster in ``spark.checkpoint.dir``.  Only local sessions built by
    ``get_session`` (tests, bench) fill it in themselves."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in
    ``spark.checkpoint.dir``.  Where that is unset a local session gets a scratch folder; on a
    cluster, whose executors would write to disks of their own, it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
        named = tempfile.mkdtemp(prefix="adpulse-shared-", dir=os.environ.get("ADPULSE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "adpulse") -> SparkSession:
    """Build (or reuse) a session for tests and the bench; clusters pass their own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.default.parallelism", str(parts))
         .config("spark.driver.memory", os.environ.get("ADPULSE_DRIVER_MEM", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in _RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        # Local session only (tests, bench): a scratch folder on this machine.
        spark.conf.set("spark.checkpoint.dir",
                       tempfile.mkdtemp(prefix="adpulse-ckpt-", dir=os.environ.get("ADPULSE_SCRATCH", "/tmp")))
    return configure(spark)

"""Session settings and the checkpoint folder.

On a cluster the checkpoint folder is the shared one the cluster names in
``spark.checkpoint.dir``; it is read from the session and never replaced.
Only when it is unset (local tests) do we point it at a folder the caller
gives.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "vitalwatch", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        # local mode runs every task in the driver JVM
        builder = builder.config("spark.driver.memory", os.environ.get("VW_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting ``fallback`` only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    target = configured or fallback
    if not target:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; pass a shared folder (tests pass a scratch one)")
    sc.setCheckpointDir(target)  # creates the folder through the Hadoop file system
    return sc.getCheckpointDir() or target


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for ``name`` under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vitalwatch/{name}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, a temporary one in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_dir(spark)
    if not (sc.master == "local" or sc.master.startswith("local[")):
        return checkpoint_dir(spark)  # raises: executors would not share a folder of this machine
    return checkpoint_dir(spark, tempfile.mkdtemp(prefix="vitalwatch-"))

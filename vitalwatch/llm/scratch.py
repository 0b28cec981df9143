"""Shared folder for intermediate tables."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named in ``spark.checkpoint.dir``; a local one only where it is unset in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="vw-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts the lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(key, make):
    """One object per Python worker and key, kept from task to task: what a lost worker held is made anew.

    Held by ``sys``, since a worker without this package gets its functions by value, with globals of their own.
    """
    held = sys.__dict__.setdefault("_vitalwatch_kept", {})
    if key not in held:
        held[key] = make()
    return held[key]

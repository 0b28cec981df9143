"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b"), F.col("a"))).toDF("u", "v")
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return joined.union(low.select("u", "m")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes of ``links`` (long a, b) other than it."""
    e, state = stored(links.where("a <> b").select("a", "b").distinct(), "links"), None
    while True:
        e = stored(_small(_large(e)), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now

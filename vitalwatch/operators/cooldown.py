"""Alert cooldown: at most one alert per device per ``gap`` seconds (event time).

Greedy rule of the deployed job: an anomaly alerts when the device has never
alerted or its last alert is more than ``gap`` earlier (strict). Ties in time
are broken by the tie column, so the first of equal-time anomalies alerts.

Plan.
* Devices with at most ``chunk_rows`` anomalies: grouped by device (the
  detection output is already hash-partitioned by device, so no new
  exchange), then per device an Arrow/numpy walk that jumps from alert to
  alert with ``searchsorted`` (work per device ~ alerts x log anomalies).
  The group is bounded by ``chunk_rows``.
* Hotter devices are never gathered in one task. Every alert is either the
  start of a session (previous anomaly more than ``gap`` earlier, or none)
  or the successor ``nxt(p)`` of a previous alert ``p`` in the same session,
  where ``nxt(p)`` is the first anomaly after ``p + gap``. ``nxt`` is found
  with an as-of window inside time buckets of width ``gap`` (the probe of
  ``p`` lies in the next bucket, the answer in that bucket or the one after).
  The alerts are then the nodes reachable from the session starts, found by
  pointer doubling: log2(longest chain) self-joins, each level checkpointed
  to the shared checkpoint folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .sizing import HotKeys, broadcast_if_small, hot_keys, micros

DEFAULT_CHUNK_ROWS = 1_000_000


def cooldown(anomalies: DataFrame, gap_seconds: float, key: str = "device_id",
             ts: str = "reading_ts", tie: str = "event_id",
             chunk_rows: int = DEFAULT_CHUNK_ROWS, broadcast_rows: int = 2_000_000,
             hot: HotKeys | None = None) -> DataFrame:
    """The rows of ``anomalies`` that raise an alert; same columns as the input.

    ``hot`` may carry a hot-key check made on the input the anomalies come
    from (a superset of rows per key, so every truly hot key is in it).
    """
    gap_us = int(round(gap_seconds * 1_000_000))
    cols = anomalies.columns
    a = anomalies.withColumn("_u", micros(anomalies, ts))
    if tie not in cols:
        # no order tie given: number the rows (fixed by the checkpoint below on
        # the hot path; on the cold path it only orders equal-time anomalies)
        tie = "_tie"
        a = a.withColumn(tie, F.monotonically_increasing_id())
    if hot is None:
        hot = hot_keys(anomalies, key, chunk_rows)
    if not hot:
        return _grouped(a, gap_us, key, tie).select(*cols)
    hot_df, n_hot = hot.table, hot.n_keys
    keys = broadcast_if_small(hot_df.select(key), n_hot, broadcast_rows)
    # the anomalies feed four branches below (cold walk, doubling nodes, roots,
    # final semi-join): write them once instead of re-running their upstream
    ensure_checkpoint_dir(anomalies.sparkSession)
    # the row id, fixed by the checkpoint, tells rows of equal time and tie apart
    a = _cut(a.withColumn("_node", F.struct(F.col(tie).alias("tie"),
                                            F.monotonically_increasing_id().alias("row"))))
    cold = _grouped(a.drop("_node").join(keys, key, "left_anti"), gap_us, key, tie)
    hot_rows = a.join(keys, key, "left_semi")
    alerts = _doubling(hot_rows.select(key, "_u", "_node"), gap_us, key, "_node")
    kept = hot_rows.join(alerts, [key, "_u", "_node"], "left_semi")
    return cold.select(*cols).unionByName(kept.select(*cols))


def _grouped(a: DataFrame, gap_us: int, key: str, tie: str) -> DataFrame:
    """Per device, on Arrow tables (no pandas frame per group)."""
    schema = a.schema
    keys = [("_u", "ascending")] + ([(tie, "ascending")] if tie in a.columns else [])

    def walk(tbl: pa.Table) -> pa.Table:
        tbl = tbl.take(pc.sort_indices(tbl, sort_keys=keys))
        u = tbl.column("_u").to_numpy()
        keep = []
        i = 0
        while i < len(u):
            keep.append(i)
            i = int(np.searchsorted(u, u[i] + gap_us, side="right"))
        return tbl.take(pa.array(keep, type=pa.int64()))

    return a.groupBy(key).applyInArrow(walk, schema)


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage: a reliable checkpoint in the shared checkpoint folder."""
    return df.checkpoint()


def _doubling(a: DataFrame, gap_us: int, key: str, tie: str) -> DataFrame:
    spark = a.sparkSession
    ensure_checkpoint_dir(spark)  # the cluster's folder; set only when none is configured
    g = F.lit(gap_us)
    nodes = a.select(key, "_u", tie, F.floor(F.col("_u") / F.lit(max(gap_us, 1))).alias("_b"))

    # per bucket: first anomaly (fallback target) and last time (session test)
    buckets = nodes.groupBy(key, "_b").agg(
        F.min(F.struct("_u", tie)).alias("_first"), F.max("_u").alias("_last"))

    # session starts: previous anomaly in the bucket, else the previous bucket's last
    wl = Window.partitionBy(key, "_b").orderBy("_u", tie)
    prev = nodes.select("*", F.lag("_u").over(wl).alias("_prev_in"))
    prev = prev.join(buckets.select(key, (F.col("_b") + 1).alias("_b"), F.col("_last").alias("_pl")),
                     [key, "_b"], "left")
    p = F.coalesce(F.col("_prev_in"), F.col("_pl"))
    roots = prev.where(p.isNull() | (F.col("_u") - p > g)).select(key, "_u", tie)

    # nxt(p): first anomaly with time > p + gap, searched in bucket b+1 by an
    # as-of window (descending, running frame), else the first of bucket b+2
    targets = nodes.select(key, "_b", "_u", F.lit(1).alias("_k"), F.col(tie).alias("_t"),
                           F.struct("_u", tie).alias("_tk"),
                           F.lit(None).cast("long").alias("_src_u"),
                           F.lit(None).cast(a.schema[tie].dataType).alias("_src_t"))
    probes = nodes.select(key, (F.col("_b") + 1).alias("_b"), (F.col("_u") + g).alias("_u"),
                          F.lit(0).alias("_k"), F.col(tie).alias("_t"),
                          F.lit(None).cast(targets.schema["_tk"].dataType).alias("_tk"),
                          F.col("_u").alias("_src_u"), F.col(tie).alias("_src_t"))
    wa = (Window.partitionBy(key, "_b")
          .orderBy(F.col("_u").desc(), F.col("_k").asc(), F.col("_t").desc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (targets.unionByName(probes)
             .select("*", F.last("_tk", ignorenulls=True).over(wa).alias("_n"))
             .where(F.col("_k") == 0))
    found = found.join(buckets.select(key, (F.col("_b") - 1).alias("_b"), "_first"),
                       [key, "_b"], "left")
    nxt = found.select(key, F.col("_src_u").alias("_u"), F.col("_src_t").alias(tie),
                       F.coalesce("_n", "_first").alias("_nx"))
    # chains stop at the next session start, so paths from different roots are disjoint
    rk = roots.select(key, F.struct("_u", tie).alias("_nx"), F.lit(True).alias("_is_root"))
    j0 = (nxt.join(rk, [key, "_nx"], "left")
          .select(key, "_u", tie, F.when(F.col("_is_root").isNull(), F.col("_nx")).alias("_nx")))

    levels = [_cut(j0)]
    while True:
        jk = levels[-1]
        if jk.where(F.col("_nx").isNotNull()).isEmpty():
            break
        nxt_of = jk.select(key, F.struct("_u", tie).alias("_nx"), F.col("_nx").alias("_nx2"))
        jn = jk.join(nxt_of, [key, "_nx"], "left").select(key, "_u", tie,
                                                          F.col("_nx2").alias("_nx"))
        levels.append(_cut(jn))

    # expand from the roots: S_k = S_{k+1} + J_k(S_{k+1}), top level down
    reach = roots
    for jk in reversed(levels):
        step = (reach.join(jk, [key, "_u", tie], "inner").where(F.col("_nx").isNotNull())
                .select(key, F.col("_nx._u").alias("_u"), F.col("_nx").getField(tie).alias(tie)))
        reach = _cut(reach.unionByName(step))
    return reach

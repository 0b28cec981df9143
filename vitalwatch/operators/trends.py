"""Trend rules: the value against the mean of the device's last N values.

Semantics (kept from the deployed job): per device and metric the history
holds the last ``history`` non-null values, the current one included; the
rule fires only when the current value is non-null and the history is full.

Plan. All eight windows share one hash exchange on the device key; each adds
only a sort (``isNotNull`` of the metric is a partition column, so NULL rows
never take a frame slot). The exchange has a partition for every ``TASK_ROWS``
rows, as the eight sorts of a task hold its rows eight times.

Hot devices. One device may hold a large share of all rows; a window
partitioned by device would then run in one task. A cheap aggregate counts
rows per device first. Only the devices above ``chunk_rows`` are cut, into chunks
of at most ``chunk_rows`` rows along (device, order), and the window
runs per (device, chunk). Only the first ``history - 1`` values of a metric
in a chunk see a short frame; they are repaired from the tails of the
preceding chunks in a small table (one row per chunk) that is joined back by
chunk and read by position. The repair is exact: the lead-in of a chunk is taken from the
last ``history - 1`` chunks that hold a value of the metric, which together
hold at least ``history - 1`` values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..thresholds import DEFAULT, Thresholds, TrendRule
from .sizing import TASK_ROWS, HotKeys, broadcast_if_small, dealt, hot_keys

# Rows per window task for one device before it is cut into chunks.
DEFAULT_CHUNK_ROWS = 1_000_000
_CHUNK = "_chunk"


def trend_condition(t: TrendRule, value: Column, avg: Column) -> Column:
    if t.kind == "mul_above":
        return value > avg * F.lit(t.amount)
    if t.kind == "add_above":
        return value > avg + F.lit(t.amount)
    if t.kind == "mul_below":
        return value < avg * F.lit(t.amount)
    raise ValueError(f"unknown trend kind {t.kind}")


def _flags(df: DataFrame, th: Thresholds) -> DataFrame:
    cols = []
    for t in th.trends:
        m = t.metric
        v, a, n = F.col(m), F.col(f"avg_{m}"), F.col(f"cnt_{m}")
        # NaN never compares true in the deployed job; Spark orders it highest
        ok = (n == th.history) & ~F.isnan(v) & ~F.isnan(a)
        cols.append(F.coalesce(ok & trend_condition(t, v, a), F.lit(False)).alias(f"trend_{m}"))
    out = df.select("*", *cols)
    return out.withColumn("trend_any", reduce(lambda a, b: a | b,
                                              [F.col(f"trend_{t.metric}") for t in th.trends]))


def _windows(df: DataFrame, th: Thresholds, part: list[str], order: list[str],
             edges: bool) -> DataFrame:
    """cnt/avg over the last ``history`` non-null values, per ``part``."""
    h = th.history
    pre = [F.col(t.metric).isNotNull().alias(f"_nn_{t.metric}") for t in th.trends]
    out = df.select("*", *pre)
    cols = []
    for t in th.trends:
        m = t.metric
        base = Window.partitionBy(*part, f"_nn_{m}").orderBy(*order)
        frame = base.rowsBetween(-(h - 1), Window.currentRow)
        cols += [F.count(m).over(frame).alias(f"cnt_{m}"),
                 F.avg(F.col(m).cast("double")).over(frame).alias(f"avg_{m}")]
        if edges:
            whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            cols += [F.row_number().over(base).alias(f"_pos_{m}"),
                     F.count(m).over(whole).alias(f"_tot_{m}")]
    return out.select("*", *cols).drop(*[f"_nn_{t.metric}" for t in th.trends])


def add_trend_columns(df: DataFrame, th: Thresholds = DEFAULT,
                      order: tuple[str, ...] = ("reading_ts", "event_id"),
                      key: str = "device_id", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                      broadcast_rows: int = 2_000_000, hot: HotKeys | None = None) -> DataFrame:
    """Append ``cnt_<m>``, ``avg_<m>``, ``trend_<m>`` and ``trend_any``.

    ``hot`` may carry a hot-key check already made on this input.
    """
    # the metrics end the order, so that only rows of equal values tie
    order = [c for c in order if c in df.columns]
    order += [t.metric for t in th.trends if t.metric not in order]
    if hot is None:
        hot = hot_keys(df, key, chunk_rows)
    if not hot:
        # no device is big enough to matter: one exchange on the key, 8 sorts
        return _flags(_windows(dealt(df, hot.n_rows, key), th, [key], order, edges=False), th)
    keys = broadcast_if_small(hot.table, hot.n_keys, broadcast_rows)
    cold = dealt(df.join(keys, key, "left_anti"), hot.n_rows, key)
    whole = _windows(cold, th, [key], order, edges=False)
    cut = _repaired(chunks(df.join(keys, key, "left_semi"), key, order, hot), th, order, key,
                    hot, broadcast_rows)
    return _flags(whole.unionByName(cut), th)


def n_ranges(hot: HotKeys) -> int:
    """Ranges into which the rows of hot devices are sorted: of ``TASK_ROWS`` rows, or of one chunk where that is larger.

    Half as many again as needed keep the sampling error of the cuts below that.
    """
    rows = min(hot.n_rows, hot.n_chunks * hot.chunk_rows)
    return -(-3 * rows // (2 * max(TASK_ROWS, hot.chunk_rows))) + 1


def chunks(rows: DataFrame, key: str, order: list[str], hot: HotKeys) -> DataFrame:
    """Rows of hot devices with ``_chunk``: places of (device, order), each of at most ``chunk_rows`` rows.

    Ranges are cut by sampled row counts, so neither bursts nor wrong clocks make a
    large one; each is sorted, and its rows are counted off in chunks. So there are as many
    tasks as ranges, however short the chunks. Written once, as several branches read the same cut.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    place = F.monotonically_increasing_id()  # of a row in its range, below the number of the range
    within = F.col(_CHUNK).bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.repartitionByRange(n_ranges(hot), key, *order).sortWithinPartitions(key, *order)
            .withColumn(_CHUNK, place).withColumn(_CHUNK, F.col(_CHUNK) - within % F.lit(hot.chunk_rows)).checkpoint())


def _repaired(rep, th, order, key, hot, broadcast_rows) -> DataFrame:
    h = th.history
    rows = min(hot.n_rows, hot.n_chunks * hot.chunk_rows)
    win = _windows(dealt(rep, rows, key, _CHUNK), th, [key, _CHUNK], order, edges=True)

    # edge values of chunks: first and last h-1 non-null values per metric, taken
    # in ONE pass over the windowed rows (one branch, exploded per metric)
    edge_of = []
    for t in th.trends:
        m = t.metric
        pos, tot = F.col(f"_pos_{m}"), F.col(f"_tot_{m}")
        is_edge = F.col(m).isNotNull() & ((pos <= h - 1) | (pos > tot - (h - 1)))
        edge_of.append(F.when(is_edge, F.struct(F.lit(m).alias("_metric"),
                                                F.col(m).cast("double").alias("_v"),
                                                pos.alias("_pos"), tot.alias("_tot"))))
    edges = (win.select(key, _CHUNK, F.explode(F.filter(F.array(*edge_of),
                                                        lambda x: x.isNotNull())).alias("_e"))
             .select(key, _CHUNK, "_e._metric", "_e._v", "_e._pos", "_e._tot"))
    kv = F.struct(F.col("_pos").alias("k"), F.col("_v").alias("v"))
    # one small aggregate per (device, metric, chunk): the first and the last
    # h-1 values, each in order (collect_list skips the NULLs of `when`)
    ends = (edges.groupBy(key, "_metric", _CHUNK)
            .agg(F.array_sort(F.collect_list(F.when(F.col("_pos") <= h - 1, kv))).alias("_head"),
                 F.array_sort(F.collect_list(F.when(F.col("_pos") > F.col("_tot") - (h - 1), kv)))
                 .alias("_tail")))
    # lead-in of chunk c: the last h-1 values of the chunks before it; every
    # chunk listed here holds a value of the metric, so h-1 chunks back suffice
    lw = Window.partitionBy(key, "_metric").orderBy(_CHUNK).rowsBetween(-(h - 1), -1)
    prev = F.array_sort(F.collect_list(F.struct(F.col(_CHUNK), F.col("_tail"))).over(lw))
    ends = (ends.select("*", prev.alias("_prev"))
            .select(key, "_metric", _CHUNK, "_head",
                    F.expr("transform(flatten(transform(_prev, x -> x._tail)), y -> y.v)")
                    .alias("_lead_all"))
            .select(key, "_metric", _CHUNK, "_head",
                    F.expr(f"slice(_lead_all, greatest(size(_lead_all) - {h - 2}, 1), {h - 1})")
                    .alias("_lead")))
    # the i-th head value sees the lead-in, then head values 1..i
    seen = F.expr(f"""transform(_head, (x, i) -> slice(
        concat(_lead, transform(slice(_head, 1, i + 1), y -> y.v)),
        greatest(size(_lead) + i + 1 - {h - 1}, 1), {h}))""")
    fixed = F.expr("""transform(_w, w -> struct(cast(size(w) AS long) AS c,
        aggregate(w, 0D, (a, x) -> a + x) / size(w) AS a))""")
    # one row per chunk, holding per metric what its first h-1 values see
    fix = (ends.select(key, _CHUNK, "_metric", seen.alias("_w"))
           .select(key, _CHUNK, F.struct("_metric", fixed.alias("f")).alias("_p"))
           .groupBy(key, _CHUNK).agg(F.map_from_entries(F.collect_list("_p")).alias("_fix")))
    # bound: the full chunks, the last one of each range, and one more where a chunk holds the end of a device
    out = win.join(broadcast_if_small(fix, hot.n_chunks + n_ranges(hot) + hot.n_keys, broadcast_rows // 64),
                   [key, _CHUNK], "left")
    repl = []
    for t in th.trends:
        m = t.metric
        at = F.when(F.col(m).isNotNull(), F.get(F.col("_fix")[m], F.col(f"_pos_{m}") - 1))
        repl += [F.coalesce(at["c"], F.col(f"cnt_{m}")).alias(f"cnt_{m}"),
                 F.coalesce(at["a"], F.col(f"avg_{m}")).alias(f"avg_{m}")]
    drop = {"_fix", _CHUNK} | {f"{p}_{t.metric}" for t in th.trends
                                for p in ("cnt", "avg", "_pos", "_tot")}
    keep = [c for c in out.columns if c not in drop]
    return out.select(*keep, *repl)

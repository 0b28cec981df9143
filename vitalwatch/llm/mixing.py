"""Mixing sources to target weights by Sainte-Lague apportionment of token blocks.

Each source is cut into shards, each shard's documents into a seeded line of
words, the line into blocks of ``block`` words. Blocks go to sources, then to
the shards of a source, by highest quotients; a shard takes whole passes of
its line and, for the rest, a run of blocks from a seeded start (wrapping).

Null texts have size 0; null sources are one source, the last; null or
repeated ids are ordered by size; a very long text may be taken in part; an empty table gives
an empty result; columns may have any name. The number of shards grows with the words, so a
shard's line, which one task orders, does not. The tables that reach the driver hold one row
per source and per shard: at most ``max_groups`` sources, else it raises, and as many shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import SPACE
from .scratch import stored

WEIGHTS = (3.0, 1.0, 2.0)


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")).cast("long")


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: float = 2.0) -> np.ndarray:
    """``total`` shared by weight; targets stop at ``most`` sizes and the excess is reshared."""
    out, capped = np.zeros(len(sizes)), np.zeros(len(sizes), bool)
    while not capped.all():
        left = total - most * sizes[capped].sum()
        share = np.where(capped, 0.0, left * weights / weights[~capped].sum())
        over = ~capped & (share > most * sizes)
        out = np.where(capped, most * sizes, share)
        if not over.any():
            break
        capped |= over
        out = np.where(capped, most * sizes, out)
    return out


def apportion(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes/(2k+1), none above ``most``; ties to the lower index."""
    seats = int(min(seats, most.sum()))
    votes = votes.astype(float)
    if seats <= 0 or votes.sum() <= 0:
        return np.zeros(len(votes), np.int64)
    # all quotients above a divisor by bisection, then the last seats one by one
    count = lambda d: np.minimum(np.floor(votes / d + 0.5), most).astype(np.int64)
    low, high = votes.sum() / (4.0 * seats + 4.0 * len(votes)), 2.0 * votes.max() + 1.0
    while count(low).sum() < seats and low > 1e-12:
        low /= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if count(mid).sum() >= seats else (low, mid)
    quota = count(high)
    while quota.sum() < seats:
        quotient = np.where(quota < most, votes / (2 * quota + 1), -1.0)
        best = np.flatnonzero(quotient >= quotient.max() * (1 - 1e-12))
        quota[best[: seats - int(quota.sum())]] += 1
    return quota


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: tuple = WEIGHTS, share: float = 1.5, block: int = 8, n_shards: int = 1024,
        shard_words: int = 65536, most_shard_words: int = 1 << 26, seed: int = 42, max_groups: int = 1_000_000) -> DataFrame:
    """doc_id, key (hash of the text), source, size, source_size, target, full (whole passes),
    spans (word ranges taken once more) and taken."""
    spark = docs.sparkSession
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("key"),
                               F.col(source).alias("source"), n_words(F.col(text)).alias("size")), "mix-sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("words")).limit(max_groups + 1).collect()
    if len(by_source) > max_groups:
        raise ValueError(f"more than {max_groups} sources")
    by_source.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    words = np.array([r["words"] for r in by_source], float)
    weight = np.array([weights[i % len(weights)] for i in range(len(words))])
    goal = targets(words, weight, share * words.sum()) if len(words) else words
    n_shards = min(max_groups, max(n_shards, int(words.sum() // most_shard_words)))
    shards = np.maximum(1, np.minimum(np.ceil(n_shards * words / max(1.0, words.sum())),
                                      words // shard_words)).astype(int)
    plan = spark.createDataFrame(
        [(r["source"], i, int(words[i]), float(goal[i]), int(shards[i])) for i, r in enumerate(by_source)],
        "source string, source_no int, source_size long, target double, n int")
    # bounded: one row per source (max_groups)
    dealt = (sized.join(F.broadcast(plan), sized["source"].eqNullSafe(plan["source"]))
             .select("doc_id", "key", sized["source"], "size", "source_no", "source_size", "target",
                     F.pmod(F.xxhash64(F.lit(seed), "doc_id", "key"), F.col("n")).cast("int").alias("shard")))
    lines = dealt.groupBy("source_no", "shard").agg(F.sum("size").alias("words")).collect()
    lines.sort(key=lambda r: (r["source_no"], r["shard"]))
    of = [[] for _ in goal]
    for r in lines:
        of[r["source_no"]].append(r)
    quota = apportion(goal, round(goal.sum() / block), 2 * np.array(
        [sum(-(-r["words"] // block) for r in own) for own in of], dtype=np.int64)) if len(goal) else []
    rows = []
    for i, own in enumerate(of):
        size = np.array([r["words"] for r in own], np.int64)
        n = -(-size // block)
        for r, k, q in zip(own, n.tolist(), apportion(size, int(quota[i]), 2 * n).tolist(), strict=True):
            full, rest = divmod(q, k) if k else (0, 0)
            rows.append((i, r["shard"], int(r["words"]), full, rest, k))
    per = spark.createDataFrame(rows, "source_no int, shard int, line long, full long, rest long, n_blocks long")
    place = (Window.partitionBy("source_no", "shard")
             .orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "key"), "doc_id", "key", "size")
             .rowsBetween(Window.unboundedPreceding, 0))
    at = dealt.withColumn("end", F.sum("size").over(place))
    j = at.join(F.broadcast(per), ["source_no", "shard"])
    begin = F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"), F.greatest("n_blocks", F.lit(1))) * F.lit(block)
    lo, hi = F.col("end") - F.col("size"), F.col("end")
    run = F.col("rest") * F.lit(block)
    around = F.col("n_blocks") * F.lit(block)

    def cut(a: Column, b: Column) -> Column:
        return F.struct((F.greatest(a, lo) - lo).alias("a"), (F.least(b, hi) - lo).alias("b"))

    spans = F.filter(F.array(cut(F.lit(0).cast("long"), begin + run - around), cut(begin, begin + run)),
                     lambda s: s["a"] < s["b"])
    j = j.withColumn("spans", spans)
    extra = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return j.select("doc_id", "key", "source", "size", "source_size", "target", "full", "spans",
                    (F.col("full") * F.col("size") + extra).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per whole pass, and a row per span with
    its words joined by a blank. Documents of which the mix takes nothing go."""
    m = mix(docs, **options).select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "full", "spans", "size")
    m = m.groupBy("_d", "_k").agg(F.sum("full").alias("_full"), F.flatten(F.collect_list("spans")).alias("_spans"),
                                  F.first("size").alias("_size"), F.count("*").alias("_n"))
    # the row travels as one value, so no column of it can meet a name used here
    one = (docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.col("text").alias("t"), F.xxhash64("text").alias("u"))
           .dropDuplicates(["doc_id", "u"]))
    j = one.join(m, one["doc_id"].eqNullSafe(m["_d"]) & (one["u"] == m["_k"]))
    whole = F.filter(F.array_repeat(F.col("t"), F.col("_full").cast("int")), lambda x: x.isNotNull())
    ws = F.filter(F.split("t", SPACE), lambda w: w != "")
    parts = F.transform("_spans", lambda s: F.when((s["b"] - s["a"]) == F.col("_size"), F.col("t")).otherwise(
        F.array_join(F.slice(ws, (s["a"] + 1).cast("int"), (s["b"] - s["a"]).cast("int")), " ")))
    j = j.select("row", F.explode(F.concat(whole, parts)).alias("new"))
    return j.select(*[F.col("new").alias("text") if c == "text" else
                      F.length("new").cast("long").alias("n_chars") if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns])

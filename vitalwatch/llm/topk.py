"""Exact top-k inner products over norm-sorted vectors with rotated partial sums.

Vectors are whole numbers floor(scale * x). They are rotated by the right
singular vectors of all vectors, sorted by descending length and cut into
blocks. A query first meets the block of longest vectors, which gives its
threshold; the blocks it still has to meet are the first ones, up to where |q| |x| falls
below the threshold (a binary search in a list of at most ``max_edges`` norms), and
inside a block a vector is dropped when its leading rotated products plus the
Cauchy-Schwarz bound of the rest stay below it. What is left is scored in whole
numbers. Bounds carry a slack above rounding error, so no hit is lost.

Null vectors and vectors with null or non-finite components take no part;
shorter vectors count as padded with zeros. Repeated ids are rows of their own: a row is a
candidate of every other row, also under its own id, and each query row has its ranks. Ties
go to the smaller vec_id (equal ids in any order); rows without an id are candidates after
all others and no queries; scores beyond a long are clamped. Fewer candidates than ``k``
give fewer ranks; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame, vec: str, vec_id: str, scale: int) -> DataFrame:
    ok = F.col(vec).isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return (vectors.where(F.coalesce(ok, F.lit(False))).select(F.col(vec_id).cast("long").alias("id"), whole.alias("v"))
            .withColumn("row", F.monotonically_increasing_id()))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n, flat = np.diff(a.offsets.to_numpy()), a.flatten().to_numpy()
    out = np.zeros((len(n), dims), np.int64)
    out[np.arange(dims)[None, :] < n[:, None]] = flat
    return out


def rotation(v: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors, strongest first, from the Gram matrix (dims x dims) summed over all rows."""
    def gram(batches):
        g = np.zeros((dims, dims))
        for b in batches:
            m = _matrix(b.column(0), dims).astype(float)
            g += m.T @ m
        i, j = np.divmod(np.arange(dims * dims), dims)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(g.ravel())], names=["i", "j", "x"])

    g = np.zeros((dims, dims))
    for r in v.select("v").mapInArrow(gram, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        g[r["i"], r["j"]] = r["x"]
    values, vectors = np.linalg.eigh(g)
    return vectors[:, np.argsort(-values, kind="stable")]


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products, pair by pair."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2**62:
        return np.einsum("ij,ij->i", q, x)
    return np.array([max(-LONG - 1, min(LONG, sum(int(a) * int(b) for a, b in zip(r, s, strict=True))))
                     for r, s in zip(q, x, strict=True)], np.int64)


def best(q_row, q, c_row, c_place, c, turn, k, tau=None, head=16, at_once=64):
    """(query index, candidate index, score): every hit that can be among the k best of the block; places order ties."""
    qr, cr = q.astype(float) @ turn, c.astype(float) @ turn
    h = min(head, q.shape[1])
    rest = lambda m: np.sqrt((m[:, h:] ** 2).sum(1))
    q_rest, c_rest = rest(qr), rest(cr)
    q_norm, c_norm = np.linalg.norm(qr, axis=1), np.linalg.norm(cr, axis=1)
    out = []
    for a in range(0, len(q), at_once):
        e = min(len(q), a + at_once)
        floor = np.full(e - a, -np.inf) if tau is None else tau[a:e].copy()
        for s in range(0, len(c), 2048):
            t = min(len(c), s + 2048)
            slack = 1e-9 * (1 + q_norm[a:e, None] * c_norm[None, s:t].max(initial=0))
            bound = qr[a:e, :h] @ cr[s:t, :h].T + q_rest[a:e, None] * c_rest[None, s:t] + slack
            i, j = np.nonzero((bound >= floor[:, None]) & (q_row[a:e, None] != c_row[None, s:t]))
            i, j = i + a, j + s
            score = _products(q[i], c[j])
            keep = np.lexsort((c_place[j], -score, i))
            i, j, score = i[keep], j[keep], score[keep]
            start = np.searchsorted(i, i)
            top = np.arange(len(i)) - start < k
            i, j, score = i[top], j[top], score[top]
            full = np.flatnonzero((np.arange(len(i)) - np.searchsorted(i, i)) == k - 1)
            np.maximum.at(floor, i[full] - a, score[full].astype(float))
            out.append((i, j, score))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 3


def top_k(vectors: DataFrame, is_query: Column, vec: str = "embedding", vec_id: str = "vec_id", k: int = 10,
          scale: int = 1024, block: int = 1024, q_block: int = 256, max_edges: int = 10_000) -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on the column ``id``."""
    v = stored(whole_vectors(vectors, vec, vec_id, scale), "topk-vectors")
    n, dims = v.agg(F.count("*"), F.max(F.size("v"))).first()
    dims = max(1, dims or 1)
    turn = rotation(v, dims) if n else np.eye(1)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    parts = max(1, -(-n // block))
    bands = (v.withColumn("norm", norm).repartitionByRange(parts, F.desc("norm"), "row")
             .withColumn("block", F.spark_partition_id()))
    bands = stored(bands, "topk-blocks")
    queries = stored(bands.where(F.col("id").isNotNull() & is_query).select("id", "row", "v", "norm")
                     .withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n // (100 * q_block))))).cast("int")), "topk-queries")
    # norms fall from block to block; several blocks share an entry where there are more than max_edges
    n_blocks = (bands.agg(F.max("block")).first()[0] or 0) + 1
    step = -(-n_blocks // max_edges)
    edge = bands.groupBy(F.floor(F.col("block") / step).alias("e")).agg(F.max("norm").alias("longest")).collect()
    longest = np.full(-(-n_blocks // step), -1.0)
    longest[[r["e"] for r in edge]] = [r["longest"] for r in edge]
    longest = np.maximum.accumulate(longest[::-1])[::-1]  # an empty entry has the norm of the next
    kinds = "query_row long, query_id long, row long, vec_id long, score long"

    def pair(t: pa.Table) -> pa.Table:
        is_q = t.column("is_q").to_numpy().astype(bool)
        ids, rows, m = t.column("id").combine_chunks(), t.column("row").to_numpy(), _matrix(t.column("v"), dims)
        tau = t.column("tau").to_numpy(zero_copy_only=False).astype(float)[is_q]
        at_q, at_c = np.flatnonzero(is_q), np.flatnonzero(~is_q)
        at_c = at_c[np.argsort(-np.linalg.norm(m[at_c].astype(float), axis=1), kind="stable")]
        place = np.lexsort((rows[at_c], ids.fill_null(LONG).to_numpy()[at_c], ids.is_null().to_numpy(zero_copy_only=False)[at_c])).argsort()
        i, j, s = best(rows[at_q], m[at_q], rows[at_c], place, m[at_c], turn, k, tau)
        qi, cj = pa.array(at_q[i]), pa.array(at_c[j])
        return pa.table({"query_row": pa.array(rows[at_q[i]]), "query_id": ids.take(qi), "row": pa.array(rows[at_c[j]]),
                         "vec_id": ids.take(cj), "score": pa.array(s.astype(np.int64))})

    def search(q: DataFrame, blocks: DataFrame) -> DataFrame:
        """q: (id, row, v, qb, block, tau): a query once for each block that it must meet."""
        met = q.select("qb", "block").distinct()
        c = blocks.join(met, "block").select("qb", "block", "id", "row", "v", F.lit(False).alias("is_q"), F.lit(0.0).alias("tau"))
        both = q.select("qb", "block", "id", "row", "v", F.lit(True).alias("is_q"), "tau").unionByName(c)
        return both.groupBy("qb", "block").applyInArrow(pair, kinds)

    first = stored(search(queries.withColumns({"block": F.lit(0), "tau": F.lit(float("-inf"))}),
                          bands.where("block = 0")), "topk-first")
    by_score = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    tau = (first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k)
           .select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("tau")))
    known = queries.join(tau, "row", "left").fillna(float("-inf"), ["tau"]).select("id", "row", "v", "qb", "norm", "tau")

    def blocks_to_meet(batches):
        for b in batches:
            q_norm, low = b.column("norm").to_numpy(), b.column("tau").to_numpy(zero_copy_only=False)
            # entries whose longest vector can reach the threshold come first
            least = np.where(q_norm > 0, (low - 1e-6) / (np.maximum(q_norm, 1e-300) * (1 + 1e-9)), np.where(low <= 1e-6, -np.inf, np.inf))
            last = np.minimum(np.searchsorted(-longest, -least, side="right") * step, n_blocks)
            many = np.maximum(last - 1, 0)  # block 0 is met
            at = np.repeat(np.arange(len(many)), many)
            blocks = 1 + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            for s in range(0, len(at), 4096):
                i = pa.array(at[s : s + 4096])
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(i) for c in ("id", "row", "v", "qb")), pa.array(blocks[s : s + 4096], pa.int32()),
                                                  b.column("tau").take(i)], names=["id", "row", "v", "qb", "block", "tau"])

    later = known.mapInArrow(blocks_to_meet, "id long, row long, v array<long>, qb int, block int, tau double")
    hits = first.unionByName(search(stored(later, "topk-later"), bands.where("block > 0")))
    return (hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

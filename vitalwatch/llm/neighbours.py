"""Approximate nearest neighbours by low-dimensional stable projections and a kd-tree (SRS).

Vectors are projected on ``m`` Gaussian directions. For two vectors at distance d the
squared distance of their projections is d^2 times a chi-square variable of m degrees of
freedom. A search walks the projected neighbours of a query outwards, leaf by leaf of a
kd-tree, and computes original distances; with d_k the k-th best so far it stops at the
projected radius r where the chi-square distribution of r^2 / d_k^2 reaches ``sure``: a
vector nearer than d_k would have shown before with that probability. So the expected
recall is at least ``sure``, whatever the data; there is no cap on what is verified.

Equal vectors become one indexed point (with its k + 1 smallest rows, more can never be
in a result), so a group of copies costs one. The upper part of the tree has at most
``max_cells`` cells and is fitted on ``sample`` points of least hash; every point is
indexed. A cell beyond ``cell_rows`` points is dealt in parts by hash, each searched by
its own lower tree. Queries first meet one part of their own cell, which gives d_k, then
every cell whose box the radius reaches. Queries of near cells travel in blocks, so a
part is sent once for a block, and a search task holds one part and one block.

Null vectors, zero ones (also empty) and those with null or non-finite components take no
part; shorter vectors count as padded with zeros. Repeated ids are rows of their own: a row
is a candidate of every other row, also under its own id, and each query row has its ranks.
Ties go to the smaller vec_id; rows without an id are candidates after all others and no
queries. Fewer candidates than k give fewer ranks; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored


def chi_square(x: float, m: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < p else (low, mid)
    return high


def directions(dims: int, m: int, seed: int = 12) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dims, m))


def matrix(column, dims: int) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n, flat = np.diff(a.offsets.to_numpy()), a.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), dims))
    out[np.arange(dims)[None, :] < n[:, None]] = flat
    return out


def project(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Component by component, so that equal vectors have equal projections wherever they are computed."""
    out = np.zeros((len(x), a.shape[1]))
    for j in range(x.shape[1]):
        out += x[:, j, None] * a[j][None, :]
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances row by row, summed in the order of the components."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j] - y[:, j]
        out += d * d
    return out


class Cells:
    """Upper tree: median splits of a sample along the widest side, leaves numbered from left to right."""

    def __init__(self, points: np.ndarray, n_cells: int):
        self.side, self.cut, self.low, self.high, self.leaf = [], [], [], [], []
        self.n = 0
        self._grow(points, n_cells)

    def _grow(self, points: np.ndarray, n_cells: int) -> int:
        at = len(self.side)
        for x in (self.side, self.cut, self.low, self.high, self.leaf):
            x.append(-1)
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(1)
        side = int(np.argmax(spread))
        if n_cells < 2 or len(points) < 2 or spread[side] == 0:
            self.leaf[at], self.n = self.n, self.n + 1
            return at
        cut = float(np.partition(points[:, side], len(points) // 2)[len(points) // 2])
        below = points[:, side] < cut
        if not below.any():  # many equal values: cut above them
            cut = float(points[points[:, side] > cut, side].min())
            below = points[:, side] < cut
        self.side[at], self.cut[at] = side, cut
        self.low[at] = self._grow(points[below], n_cells // 2)
        self.high[at] = self._grow(points[~below], n_cells - n_cells // 2)
        return at

    def find(self, p: np.ndarray) -> np.ndarray:
        side, cut, low, high, leaf = (np.array(x) for x in (self.side, self.cut, self.low, self.high, self.leaf))
        at = np.zeros(len(p), np.int64)
        while (inner := np.flatnonzero(leaf[at] < 0)).size:
            node = at[inner]
            at[inner] = np.where(p[inner, side[node]] < cut[node], low[node], high[node])
        return leaf[at]


def leaves(points: np.ndarray, size: int = 64) -> np.ndarray:
    """Lower tree: one row per leaf, its points from the left, -1 where it has fewer than the largest."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) > size:
            half = rows[np.argsort(points[rows, int(np.argmax(np.ptp(points[rows], axis=0)))], kind="stable")]
            todo += [half[len(half) // 2 :], half[: len(half) // 2]]
        else:
            out.append(rows)
    table = np.full((len(out), max(len(r) for r in out)), -1)
    for i, r in enumerate(out):
        table[i, : len(r)] = r
    return table


def box_distance(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(p), len(low)))
    for j in range(p.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, j] - p[:, j, None], p[:, j, None] - high[None, :, j]), 0)
        out += gap * gap
    return out


def search(q: np.ndarray, qp: np.ndarray, limit: np.ndarray, x: np.ndarray, xp: np.ndarray, rows: np.ndarray, first: np.ndarray,
           k: int, stop: float, at_once: int = 32768):
    """(query, point, squared distance) of the best points of each query, and the number of distances computed.

    ``limit`` is d_k^2 known before; ``rows`` counts the rows of a point, ``first`` orders ties. A query is
    done when the next leaf lies beyond sqrt(stop) d_k; of an opened leaf only points within are verified.
    """
    table = leaves(xp)
    # an empty place repeats the first point of its leaf
    filled = np.where(table < 0, table[:, :1], table)
    low, high = xp[filled].min(1), xp[filled].max(1)
    near = box_distance(qp, low, high)
    order = np.argsort(near, axis=1, kind="stable")
    near = np.take_along_axis(near, order, 1)
    slack = 1e-9 * (1 + (qp * qp).sum(1))
    n, done = len(q), 0
    best_d, best_x = np.full((n, k), np.inf), np.full((n, k), -1)
    best_f = np.full((n, k), np.iinfo(np.int64).max)
    limit = limit.copy()
    live = np.arange(n)
    for turn in range(len(table)):
        live = live[near[live, turn] <= limit[live] * stop + slack[live]]
        if not len(live):
            break
        found_q, found_x = [], []
        for a in range(0, len(live), 512):
            qs = live[a : a + 512]
            leaf = order[qs, turn]
            gap = np.zeros((len(qs), table.shape[1]))
            for j in range(qp.shape[1]):
                g = qp[qs, j, None] - xp[:, j][filled[leaf]]
                gap += g * g
            i, j = np.nonzero((gap <= (limit[qs] * stop + slack[qs])[:, None]) & (table[leaf] >= 0))
            found_q.append(qs[i])
            found_x.append(table[leaf[i], j])
        fq, fx = np.concatenate(found_q), np.concatenate(found_x)
        fd = np.concatenate([distances(q[fq[a : a + at_once]], x[fx[a : a + at_once]]) for a in range(0, len(fq), at_once)] or [np.zeros(0)])
        done += len(fq)
        keep = fd <= limit[fq]
        fq, fx, fd = fq[keep], fx[keep], fd[keep]
        if not len(fq):
            continue
        who = np.unique(fq)
        q_all = np.r_[np.repeat(who, k), fq]
        x_all, d_all, f_all = np.r_[best_x[who].ravel(), fx], np.r_[best_d[who].ravel(), fd], np.r_[best_f[who].ravel(), first[fx]]
        by = np.lexsort((f_all, d_all, q_all))
        q_all, x_all, d_all, f_all = q_all[by], x_all[by], d_all[by], f_all[by]
        place = np.arange(len(q_all)) - np.searchsorted(q_all, q_all)
        top = place < k
        best_x[who], best_d[who], best_f[who] = (z[top].reshape(-1, k) for z in (x_all, d_all, f_all))
        # d_k: where the rows of the points reach k
        have = np.cumsum(np.where(best_x[who] >= 0, rows[best_x[who]], 0), axis=1) >= k
        at = np.argmax(have, axis=1)
        full = have.any(1)
        limit[who[full]] = np.minimum(limit[who[full]], best_d[who[full], at[full]])
    i, j = np.nonzero(best_x >= 0)
    return i, best_x[i, j], best_d[i, j], done


def nearest(vectors: DataFrame, is_query: Column, vec: str = "embedding", vec_id: str = "vec_id", k: int = 10, m: int = 8,
            sure: float = 0.97, cell_rows: int = 8192, max_cells: int = 4096, sample: int = 20000, q_block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on the column ``id``."""
    spark = vectors.sparkSession
    want = k + 1  # a query's own row is among its candidates
    x = F.col(vec)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    taken = F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))
    rows = stored(vectors.where(taken).select(F.col(vec_id).cast("long").alias("id"), F.transform(x, lambda c: c.cast("double")).alias("v"))
                  .withColumn("row", F.monotonically_increasing_id()), "near-rows")
    kinds = "query_id long, rank int, vec_id long, score double"
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    if dims is None:
        return spark.createDataFrame([], kinds)
    a = directions(dims, m)
    stop = chi_square_quantile(sure, m)
    # equal vectors: one point; a partial limit goes before the shuffle
    same = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last(), "row")
    points = (rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= want)
              .groupBy("v").agg(F.sort_array(F.collect_list(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row"))).alias("members"),
                                F.count("*").cast("int").alias("rows"))
              .select(F.monotonically_increasing_id().alias("u"), "v", "members", "rows"))

    def projected(batches):
        for b in batches:
            p = project(matrix(b.column("v"), dims), a)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), m).cast(pa.list_(pa.float64()))],
                                             names=[*b.schema.names, "p"])

    shape = "u long, v array<double>, members array<struct<unnamed:boolean,id:long,row:long>>, rows int"
    points = stored(points.mapInArrow(projected, f"{shape}, p array<double>"), "near-points")
    n = points.count()
    chosen = [r["p"] for r in points.select("p").orderBy(F.xxhash64("p"), "p").limit(sample).collect()]
    cells = Cells(np.array(chosen), min(max_cells, max(1, -(-n // cell_rows))))

    def celled(batches):
        for b in batches:
            c = cells.find(matrix(b.column("p"), m))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c, pa.int32())], names=[*b.schema.names, "cell"])

    index = stored(points.mapInArrow(celled, f"{shape}, p array<double>, cell int"), "near-index")
    # one row per cell, at most max_cells: box and parts
    boxes = index.groupBy("cell").agg(F.count("*").alias("n"), *[F.min(F.col("p")[j]).alias(f"l{j}") for j in range(m)],
                                      *[F.max(F.col("p")[j]).alias(f"h{j}") for j in range(m)]).orderBy("cell").collect()
    number = np.array([r["cell"] for r in boxes])
    low, high = (np.array([[r[f"{e}{j}"] for j in range(m)] for r in boxes]) for e in "lh")
    n_parts = {int(r["cell"]): -(-r["n"] // cell_rows) for r in boxes}
    part_of = spark.createDataFrame(list(n_parts.items()), "cell int, parts int")
    dealt = (index.join(F.broadcast(part_of), "cell").withColumn("part", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int")))
    dealt = stored(dealt.select("u", "v", "p", "rows", "cell", "part", F.struct(
        F.col("members")[0]["unnamed"].cast("int").alias("unnamed"), F.col("members")[0]["id"].alias("id"),
        F.col("members")[0]["row"].alias("row")).alias("first")), "near-parts")
    # queries by their point: a copy searches once
    ids = rows.where(F.col("id").isNotNull() & is_query).select("id", "row", "v")
    asked = stored(ids.join(index.select("u", "v"), "v").select("id", "row", "u"), "near-asked")
    # blocks of queries of near cells: cells are numbered from left to right, one row per cell
    seekers = dealt.join(asked.select("u").distinct(), "u", "left_semi").select("u", "v", "p", "cell", "part")
    base, free, plan = 0, q_block, []
    for r in seekers.groupBy("cell").count().orderBy("cell").collect():
        splits = -(-r["count"] // q_block)
        if splits > 1 or r["count"] > free:
            base, free = base + 1, q_block
        plan.append((r["cell"], base, splits))
        base, free = (base + splits, q_block) if splits > 1 else (base, free - r["count"])
    blocks = spark.createDataFrame(plan, "cell int, base int, splits int")
    queries = stored(seekers.join(F.broadcast(blocks), "cell").withColumn(
        "block", (F.col("base") + F.pmod(F.hash("u"), F.col("splits"))).cast("int")).drop("base", "splits"), "near-queries")

    def meet(t: pa.Table) -> pa.Table:
        asks = t.column("asks").to_numpy().astype(bool)
        u, v, p = t.column("u").to_numpy(), matrix(t.column("v"), dims), matrix(t.column("p"), m)
        limit = t.column("limit").to_numpy(zero_copy_only=False).astype(float)
        row_count, first = t.column("rows").to_numpy(), t.column("first").combine_chunks()
        unnamed, fid, frow = (first.field(j).fill_null(0).to_numpy(zero_copy_only=False) for j in range(3))
        place = np.empty(len(u), np.int64)
        place[np.lexsort((frow, fid, unnamed))] = np.arange(len(u))
        c = ~asks
        if not c.any():
            return pa.table({"q": pa.array([], pa.int64()), "u": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
        i, j, d, _ = search(v[asks], p[asks], limit[asks], v[c], p[c], row_count[c], place[c], want, stop)
        return pa.table({"q": u[asks][i], "u": u[c][j], "d": d})

    columns = ("block", "cell", "part", "u", "v", "p", "rows", "first")

    def search_parts(q: DataFrame) -> DataFrame:
        """q: (block, cell, part, u, v, p, limit), a query once for each part that it meets."""
        met = q.select("block", "cell", "part").distinct()
        points = dealt.join(met, ["cell", "part"]).select(*columns, F.lit(False).alias("asks"), F.lit(0.0).alias("limit"))
        asks = q.select("block", "cell", "part", "u", "v", "p", F.lit(0).alias("rows"),
                        F.lit(None).cast(dealt.schema["first"].dataType).alias("first"), F.lit(True).alias("asks"), "limit")
        return asks.unionByName(points).groupBy("block", "cell", "part").applyInArrow(meet, "q long, u long, d double")

    home = stored(search_parts(queries.withColumn("limit", F.lit(float("inf")))), "near-home")
    # members of a point in rank order; d_k is where the rows reach k
    counts = dealt.select("u", "rows", "first")
    by_distance = Window.partitionBy("q").orderBy("d", "first", "u")
    ranked = lambda hits: hits.join(counts, "u").withColumn("have", F.sum("rows").over(
        by_distance.rowsBetween(Window.unboundedPreceding, 0)))
    known = ranked(home).where(F.col("have") >= want).groupBy("q").agg(F.min("d").alias("limit")).withColumnRenamed("q", "u")

    def route(batches):
        for b in batches:
            p, limit = matrix(b.column("p"), m), b.column("limit").to_numpy(zero_copy_only=False)
            own_cell, own_part = b.column("cell").to_numpy(), b.column("part").to_numpy()
            for s in range(0, len(p), 512):
                t = min(len(p), s + 512)
                slack = 1e-9 * (1 + (p[s:t] ** 2).sum(1))
                i, j = np.nonzero(box_distance(p[s:t], low, high) <= (limit[s:t] * stop + slack)[:, None])
                i, cell = i + s, number[j]
                times = np.array([n_parts[int(c)] for c in cell], np.int64)
                i, cell = np.repeat(i, times), np.repeat(cell, times)
                part = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
                new = (cell != own_cell[i]) | (part != own_part[i])
                i, cell, part = i[new], cell[new], part[new]
                yield pa.RecordBatch.from_arrays([b.column("block").take(pa.array(i)), pa.array(cell, pa.int32()), pa.array(part, pa.int32()),
                                                  *[b.column(c).take(pa.array(i)) for c in ("u", "v", "p", "limit")]],
                                                 names=["block", "cell", "part", "u", "v", "p", "limit"])

    # a query whose part had too few rows has no radius yet and goes everywhere
    todo = queries.join(known, "u", "left").fillna(float("inf"), ["limit"]).select("block", "cell", "part", "u", "v", "p", "limit")
    routed = stored(todo.mapInArrow(route, "block int, cell int, part int, u long, v array<double>, p array<double>, limit double"), "near-routed")
    hits = stored(home.unionByName(search_parts(routed)), "near-hits")
    # points with a rank below want, at most want for a query: every row of the result is a member of one
    best = (hits.join(counts, "u").withColumn("n", F.row_number().over(by_distance)).where(F.col("n") <= want)
            .select("q", "u", "d"))
    members = best.join(index.select("u", F.col("members")), "u").select("q", "d", F.inline("members"))
    pairs = (asked.select(F.col("id").alias("query_id"), F.col("row").alias("query_row"), F.col("u").alias("q")).join(members, "q")
             .where("row <> query_row"))
    ranks = Window.partitionBy("query_id", "query_row").orderBy("d", "unnamed", "id", "row")
    return (pairs.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), F.sqrt("d").alias("score")))

"""Centroid clustering of whole-number vectors with a table of pivot distances (LAESA).

Every vector's distances to a few fixed pivots are computed once and stored beside it.
In a round a centroid's distances to the pivots are known too, and by the triangle
inequality no centroid is nearer than the largest difference of the two rows: centroids
are taken by rising bound, and a vector computes exact whole-number distances only to
those whose bound does not exceed its best so far. Bounds carry a slack above rounding
error, so the assignment is that of a full comparison, ties to the smaller number.

A round sends per task one row per centroid and component (partial sums), and the driver
holds ``k`` centroids; both are bounded by ``k`` and the dimension, not by the rows. Rounds
end early when no centroid moves, as all later ones would be the same.

Vectors of another length than ``dims``, null ones and ones with null or non-finite
components take no part. Whole numbers stop at the ends of a long; distances are exact
whole numbers compared without overflow and stop at the largest long when returned, sums
likewise. Rows without an id are clustered but never start a centroid. Repeated ids and
repeated vectors are rows like others; of equal hashes the smaller vector starts first.
With fewer than ``k`` named vectors there are as many centroids, with none no rows. Start vectors may be equal:
then the smaller number takes the ties and the other keeps its place. An empty table
gives no rows. Extra columns are not read. Vectors have a fixed length, so none is long.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored

LONG = 2**63 - 1
SAFE = 2**26  # |components| up to here: squared distances of 1,024 components fit a long


def whole(vectors: DataFrame, vec: str, vec_id: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the vectors that take part."""
    x = F.col(vec)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return (vectors.where(F.coalesce((F.size(x) == dims) & finite, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("v")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def small(*numbers: np.ndarray) -> bool:
    return all(m.max(initial=0) <= SAFE and m.min(initial=0) >= -SAFE for m in numbers)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row: longs, or Python numbers where a long may overflow."""
    if not small(x, c):
        d = x.astype(object) - c.astype(object)
        return (d * d).sum(1)
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def roots(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances to every point as doubles."""
    return np.stack([np.sqrt(squared(x, np.broadcast_to(p, x.shape)).astype(float)) for p in points], 1)


def nearest(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, centre_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance, exact distances computed) per row; ``far``: distances to the pivots."""
    n, k = len(x), len(centroids)
    low = np.zeros((n, k))
    for p in range(far.shape[1]):
        np.maximum(low, np.abs(far[:, p, None] - centre_far[None, :, p]), out=low)
    # below the true distance whatever the rounding of the roots
    low -= 1e-9 * (1 + far.max(1, initial=0)[:, None] + centre_far.max(1, initial=0)[None, :])
    low = np.maximum(low, 0) ** 2
    order = np.argsort(low, axis=1, kind="stable")
    best = np.full(n, LONG, np.int64) if small(x, centroids) else np.full(n, np.inf, object)
    at, done = np.full(n, k, np.int64), 0
    for turn in range(k):
        number = order[:, turn]
        live = np.flatnonzero(low[np.arange(n), number] <= best.astype(float) * (1 + 1e-12))
        if not len(live):
            break  # bounds rise along every row
        c = number[live]
        d = squared(x[live], centroids[c])
        done += len(live)
        wins = (d < best[live]) | ((d == best[live]) & (c < at[live]))
        best[live[wins]], at[live[wins]] = d[wins], c[wins]
    return at, best, done


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Far apart: each next one has the largest sum of distances to those before."""
    if not len(sample):
        return sample
    chosen, total = [0], np.zeros(len(sample))
    while len(chosen) < min(n, len(sample)):
        total += roots(sample, sample[chosen[-1:]])[:, 0]
        total[chosen] = -1
        chosen.append(int(np.argmax(total)))
    return sample[chosen]


def digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster(vectors: DataFrame, vec: str = "embedding", vec_id: str = "vec_id", dims: int = 64, k: int = 8, rounds: int = 10,
            scale: int = 1024, seed: str = "3", n_pivots: int = 16, sample: int = 2048) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector.

    Pivots come from the ``sample`` vectors of least hash (a bound on what reaches the driver):
    they decide how much is pruned and never the result.
    """
    spark = vectors.sparkSession
    v = whole(vectors, vec, vec_id, dims, scale)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = [r["v"] for r in v.where("id is not null").withColumn("mark", mark).orderBy("mark", "v").limit(max(k, sample)).collect()]
    centroids = np.array(first[:k], np.int64).reshape(-1, dims)
    pivots = choose_pivots(np.array(first, np.int64).reshape(-1, dims), n_pivots)
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):  # no vector with an id
        return spark.createDataFrame([], result)

    def measure(batches):
        for b in batches:
            far = roots(matrix(b.column(1), dims), pivots)
            yield pa.record_batch([b.column(0), b.column(1), pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), len(pivots)).cast(
                pa.list_(pa.float64()))], names=["id", "v", "far"])

    table = stored(v.mapInArrow(measure, "id long, v array<long>, far array<double>"), "pivot-table")

    def assigned(centroids):
        centre_far = roots(centroids, pivots)

        def run(batch):
            x = matrix(batch.column("v"), dims)
            return (x, *nearest(x, matrix(batch.column("far"), len(pivots)), centroids, centre_far)[:2])
        return run

    def moved(centroids: np.ndarray) -> np.ndarray:
        assign = assigned(centroids)

        def sums(batches):
            total, count = np.zeros((len(centroids), dims), object), np.zeros(len(centroids), np.int64)
            for b in batches:
                x, at, _ = assign(b)
                for c in np.unique(at):
                    rows = x[at == c]
                    total[c] += (rows if small(rows) else rows.astype(object)).sum(0)
                    count[c] += len(rows)
            c, i = np.divmod(np.arange(total.size), dims)
            yield pa.record_batch([pa.array(c, pa.int32()), pa.array(i, pa.int32()),
                                   pa.array([Decimal(int(s)) for s in total.ravel()], pa.decimal128(38, 0)),
                                   pa.array(np.repeat(count, dims))], names=["c", "i", "s", "n"])

        rows = (table.select("v", "far").mapInArrow(sums, "c int, i int, s decimal(38,0), n long").where("n > 0")
                .groupBy("c", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
        out = centroids.copy()
        for r in rows:
            out[r["c"], r["i"]] = int(r["s"]) // int(r["n"])
        return out

    for _ in range(rounds):
        old, centroids = centroids, moved(centroids)
        if (old == centroids).all():
            break
    assign = assigned(centroids)

    def last(batches):
        for b in batches:
            _, at, d = assign(b)
            yield pa.record_batch([b.column(0), pa.array(at, pa.int32()), pa.array([min(int(x), LONG) for x in d], pa.int64())],
                                  names=["vec_id", "cluster", "distance"])

    found = stored(table.mapInArrow(last, "vec_id long, cluster int, distance long"), "clusters")
    whole_sum = lambda c: F.least(c, F.lit(LONG).cast("decimal(38,0)")).cast("long")
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s"))
    total = per.agg(F.sum("s").alias("t"))
    names = spark.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    # at most k rows each
    facts = (per.crossJoin(F.broadcast(total)).join(F.broadcast(names), "cluster")
             .select("cluster", whole_sum(F.col("s")).alias("cluster_inertia"), whole_sum(F.col("t")).alias("inertia"), "centroid_sha256"))
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

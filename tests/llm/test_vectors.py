"""Clustering and neighbour search against brute force: nulls, repeats, ties, equal vectors, empty tables."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("vitalwatch.llm")
from vitalwatch.llm import clusters, neighbours  # noqa: E402

VECTORS = "vec_id long, embedding array<double>, cluster int, distance string, far int"


def frame(spark, rows):
    # columns of the operators' own names ride along
    return spark.createDataFrame([(i, v, 5, "x", 1) for i, v in rows], VECTORS)


def plain_clusters(rows, dims, k, rounds):
    kept = [(i, [min(max(math.floor(1024 * x), -(2**63)), 2**63 - 1) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]
    if not centres:
        return Counter()
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((far(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, g in groups.items():
            centres[n] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    last = [(i, *near(v)) for i, v in kept]
    per = Counter()
    for _, d, n in last:
        per[n] += d
    cut = lambda x: min(x, 2**63 - 1)
    return Counter((i, n, cut(d), cut(sum(min(e, 2**63 - 1) for _, e, m in last if m == n)), cut(sum(min(e, 2**63 - 1) for _, e, _ in last)),
                    hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for i, d, n in last)


def found_clusters(spark, rows, **how):
    c = clusters.cluster(frame(spark, rows), **how).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return Counter(map(tuple, c.collect()))


def test_clusters(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(5, 6)) * 3
    rows = [(i, (centre[i % 5] + rng.normal(size=6)).tolist()) for i in range(200)]
    rows += [(300 + i, rows[3][1]) for i in range(60)]  # one vector many times
    rows += [(7, rows[8][1]), (7, rows[7][1]), (None, rows[9][1]), (None, [0.0] * 6)]
    rows += [(900, None), (901, []), (902, [1.0] * 5), (903, [1.0] * 5 + [None]), (904, [float("inf")] * 6), (905, [float("nan")] + [0.0] * 5)]
    assert found_clusters(spark, rows, dims=6, k=4, rounds=10, n_pivots=3, sample=20) == plain_clusters(rows, 6, 4, 10)
    assert found_clusters(spark, rows, dims=6, k=9, rounds=2, n_pivots=1) == plain_clusters(rows, 6, 9, 2)


def test_clusters_at_the_edges(spark):
    assert found_clusters(spark, []) == Counter()
    assert found_clusters(spark, [(None, [1.0, 2.0])], dims=2) == Counter()
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.5])]  # equal start vectors: the smaller number takes both
    assert found_clusters(spark, few, dims=2) == plain_clusters(few, 2, 8, 10)
    wide = [(i, [1e15 * (i - 3), float(i)]) for i in range(8)] + [(9, [1e300, -1e300]), (10, [1e5, 1e5])]
    assert found_clusters(spark, wide, dims=2, k=3, rounds=3) == plain_clusters(wide, 2, 3, 3)


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(2000, 16)) * 300 + rng.choice([-4000, 0, 4000], (2000, 1))).astype(np.int64)
    centroids, pivots = x[:8], clusters.choose_pivots(x[:200], 6)
    at, d, done = clusters.nearest(x, clusters.roots(x, pivots), centroids, clusters.roots(centroids, pivots))
    full = ((x[:, None] - centroids[None]) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and (d == full.min(1)).all()
    assert done < 0.7 * len(x) * len(centroids)


def plain_neighbours(rows, queries, k):
    kept = [(i, np.array(v, float)) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = []
    for n, (q, v) in enumerate(kept):
        if q is None or not queries(q):
            continue
        best = sorted((float(((v - w) ** 2).sum()), i is None, i or 0) for m, (i, w) in enumerate(kept) if m != n)[:k]
        out += [(q, r + 1, None if none else i, round(math.sqrt(d), 9)) for r, (d, none, i) in enumerate(best)]
    return Counter(out)


def found_neighbours(spark, rows, **how):
    got = neighbours.nearest(frame(spark, rows).repartition(3), F.col("id") % 10 == 0, **how).collect()
    return Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got)


def test_neighbours_whole_search(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(120)]  # equal vectors beyond a cell, queries among them
    rows += [(10, rows[20][1]), (10, rows[11][1]), (None, rows[30][1]), (None, rows[5][1])]
    rows += [(2000, None), (2010, []), (2020, [0.0] * 6), (2030, [1.0, None]), (2040, [float("nan")] * 6), (2050, [float("inf")] * 6)]
    # a test that never stops early walks everything: every hit must be there
    got = found_neighbours(spark, rows, m=4, sure=1 - 1e-12, cell_rows=50, q_block=7, sample=100)
    assert got == plain_neighbours(rows, lambda i: i % 10 == 0, 10)


def test_neighbours_at_the_edges(spark):
    assert found_neighbours(spark, []) == Counter()
    assert found_neighbours(spark, [(10, [0.0, 0.0]), (20, None)]) == Counter()
    assert found_neighbours(spark, [(10, [1.0, 0.0])]) == Counter()
    few = [(10, [1.0, 0.0]), (11, [1.0, 0.0]), (20, [0.0, 2.0]), (21, [1.0, 0.0])]
    assert found_neighbours(spark, few) == plain_neighbours(few, lambda i: i % 10 == 0, 10)


def test_neighbours_recall(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 48)) + rng.choice([-2, 0, 2], (3000, 1)))]
    got = found_neighbours(spark, rows, cell_rows=512)
    want = plain_neighbours(rows, lambda i: i % 10 == 0, 10)
    pairs = lambda c: {(q, v) for q, _, v, _ in c}
    assert len(pairs(got) & pairs(want)) >= 0.95 * len(pairs(want)) and sum(got.values()) == sum(want.values())


def test_search_stops_early():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(50, 32)) * 0.05 + c for c in rng.normal(size=(40, 32))])
    xp = neighbours.project(x, neighbours.directions(32, 8))
    one, place = np.ones(len(x), int), np.arange(len(x))
    stop = neighbours.chi_square_quantile(0.97, 8)
    i, j, d, done = neighbours.search(x[::100], xp[::100], np.full(20, np.inf), x, xp, one, place, 10, stop)
    full = ((x[::100, None] - x[None]) ** 2).sum(2)
    right = sum(len(set(j[i == n].tolist()) & set(np.argsort(full[n], kind="stable")[:10].tolist())) for n in range(20))
    assert right >= 190 and done < 0.2 * 20 * len(x)


def test_chi_square():
    # two degrees of freedom: 1 - exp(-x / 2)
    assert abs(neighbours.chi_square_quantile(0.95, 2) + 2 * math.log(0.05)) < 1e-9
    draws = (np.random.default_rng(6).normal(size=(20000, 8)) ** 2).sum(1)
    assert abs((draws < neighbours.chi_square_quantile(0.9, 8)).mean() - 0.9) < 0.01

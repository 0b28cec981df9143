"""SimHash near-dedup by a binary trie self-join.

Fingerprints are grouped first (copies cost one row). The trie's top is cut
into nodes of about equal counts; node pairs are walked together, the bits in
which they differ add up, and a pair is dropped beyond ``max_bits``. Each
surviving pair of nodes is one group, walked on level by level in its task,
which returns a spanning forest of the links that it finds.

Null and empty texts have fingerprint zero and link like any other; repeated
rows and ties share a component; null ids take part as fingerprints but never
name a component (a component of null ids only is null); extra columns of the
input are not read; very long texts are hashed whole; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import stored

WIDTH = 64


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed 64-bit integer."""
    ws = (text or b"").lower().split()  # bytes: only A-Z is lowered, only ASCII white space splits
    if not ws:
        return 0
    line, n = b" ".join(ws), max(1, len(ws) - words + 1)
    ends = list(accumulate(len(w) + 1 for w in ws))
    starts = [0, *ends[: n - 1]]
    hashes = np.array([xxhash.xxh64_intdigest(line[a : b - 1], seed)
                       for a, b in zip(starts, ends[-n:], strict=True)], "<u8")
    count = np.zeros(WIDTH, np.int64)
    for k in range(0, n, 65536):
        count += np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * count > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row."""
    def run(batches):
        for b in batches:
            fps = [fingerprint(x, words) for x in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def top_nodes(distinct: DataFrame, n_nodes: int, node_rows: int) -> list[tuple[int, int]]:
    """Trie nodes (prefix, depth), in order, that hold about 1/n_nodes of the rows each, at most
    node_rows, or are leaves.

    The driver gets counts per prefix: 2^12 at first, then 2^6 for each node that is still too heavy."""
    u = lambda depth: F.shiftrightunsigned("fp", WIDTH - depth)
    counts = {(r[0] & ((1 << 12) - 1), 12): r[1] for r in distinct.groupBy(u(12)).count().collect()}
    cap, depth = max(16, min(node_rows, sum(counts.values()) // n_nodes)), 12
    while heavy := [p for (p, d), c in counts.items() if d == depth and c > cap and depth < WIDTH]:
        deeper = min(WIDTH, depth + 6)
        mask = (1 << deeper) - 1
        signed = [p - (1 << depth) if depth == WIDTH and p >> (WIDTH - 1) else p for p in heavy]
        found = distinct.where(u(depth).isin(signed)).groupBy(u(deeper) if deeper < WIDTH else F.col("fp")).count().collect()
        for p in heavy:
            del counts[p, depth]
        counts |= {(r[0] & mask, deeper): r[1] for r in found}
        depth = deeper

    def merged(prefix: int, d: int, own: list) -> list:
        """The fewest nodes under (prefix, d) that are at most cap or as deep as counted."""
        if not own:
            return []
        if sum(c for _, _, c in own) <= cap or (len(own) == 1 and own[0][1] == d):
            return [(prefix, d)]
        zero = [x for x in own if not (x[0] >> (x[1] - d - 1)) & 1]
        one = [x for x in own if (x[0] >> (x[1] - d - 1)) & 1]
        return merged(2 * prefix, d + 1, zero) + merged(2 * prefix + 1, d + 1, one)

    return merged(0, 0, [(p, d, c) for (p, d), c in counts.items()])


def node_pairs(nodes: list[tuple[int, int]], max_bits: int) -> list[tuple[int, int]]:
    """Index pairs (i <= j) of nodes whose common prefixes differ in at most max_bits."""
    out = []
    first = np.array([p << (WIDTH - d) for p, d in nodes], np.uint64)
    depth = np.array([d for _, d in nodes], np.uint64)
    for i in range(len(nodes)):
        common = np.minimum(depth[i], depth[i:])
        # a common prefix of no bits differs in none
        shift = np.where(common > 0, np.uint64(WIDTH) - common, np.uint64(0))
        differ = np.where(common > 0, (first[i] ^ first[i:]) >> shift, np.uint64(0))
        out += [(i, i + j) for j in np.flatnonzero(np.bitwise_count(differ) <= max_bits).tolist()]
    return out


def walk(a: np.ndarray, b: np.ndarray | None, max_bits: int, chunk: int = 200_000):
    """Arrays (index in a, index in b) of links; sorted distinct uint64 in; b None: within a."""
    own, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return
    # a frame: ranges [a0, a1), [b0, b1) that share `depth` bits each, and the bits that differ
    stack = [(0, np.array([[0, len(a), 0, len(b), 0]], np.int64))]
    while stack:
        depth, f = stack.pop()
        if len(f) > chunk:
            stack += [(depth, f[k : k + chunk]) for k in range(0, len(f), chunk)]
            continue
        small = (f[:, 1] - f[:, 0]) * (f[:, 3] - f[:, 2]) <= 4 if depth < WIDTH else np.ones(len(f), bool)
        for s in (f[small],):
            for x in range(4):
                for y in range(4):
                    ok = (s[:, 0] + x < s[:, 1]) & (s[:, 2] + y < s[:, 3])
                    i, j = s[ok, 0] + x, s[ok, 2] + y
                    near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
                    if own:
                        near &= i < j
                    if near.any():
                        yield i[near], j[near]
        f = f[~small]
        if not len(f):
            continue
        bit = np.uint64(WIDTH - 1 - depth)

        def split(v, lo, hi):
            """First index in [lo, hi) whose next bit is set."""
            lo, hi = lo.copy(), hi.copy()
            while (open_ := lo < hi).any():
                mid = (lo + hi) // 2
                one = (v[np.minimum(mid, len(v) - 1)] >> bit) & np.uint64(1) == 1
                hi = np.where(open_ & one, mid, hi)
                lo = np.where(open_ & ~one, mid + 1, lo)
            return lo

        ma, mb = split(a, f[:, 0], f[:, 1]), split(b, f[:, 2], f[:, 3])
        part = lambda a0, a1, b0, b1, d: np.stack([a0, a1, b0, b1, f[:, 4] + d], 1)
        cross = part(ma, f[:, 1], f[:, 2], mb, 1)
        if own:  # a node with itself: only one of the two crossings
            cross = cross[(f[:, 0] != f[:, 2])]
        kids = np.concatenate([part(f[:, 0], ma, f[:, 2], mb, 0), part(ma, f[:, 1], mb, f[:, 3], 0),
                               part(f[:, 0], ma, mb, f[:, 3], 1), cross])
        kids = kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3]) & (kids[:, 4] <= max_bits)]
        if len(kids):
            stack.append((depth + 1, kids))


def _forest(n: int, links) -> list[tuple[int, int]]:
    root, out = list(range(n)), []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in links:
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((x, y))
    return out


def links(distinct: DataFrame, max_bits: int = 2, n_nodes: int = 128, node_rows: int = 250_000) -> DataFrame:
    """(a, b): a spanning set of the links between distinct fingerprints ``fp``.

    A group holds two nodes, so at most 2 * node_rows fingerprints at any size of the input."""
    nodes = top_nodes(distinct, n_nodes, node_rows)
    if not nodes:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    first = np.array([p << (WIDTH - d) for p, d in nodes], np.uint64)
    of: list[list[tuple[int, int]]] = [[] for _ in nodes]
    for k, (i, j) in enumerate(node_pairs(nodes, max_bits)):
        of[i].append((k, 0))
        if i != j:
            of[j].append((k, 1))

    def deal(batches):
        for b in batches:
            fp = b.column(0).to_numpy().astype(np.int64)
            at = np.searchsorted(first, fp.view(np.uint64), side="right") - 1
            for n in np.unique(at):
                mine = fp[at == n]
                for k, side in of[n]:
                    yield pa.record_batch([pa.array(np.full(len(mine), k, np.int32)), pa.array(np.full(len(mine), side, np.int32)),
                                           pa.array(mine)], names=["pair", "side", "fp"])

    def pair(t: pa.Table) -> pa.Table:
        side, fp = t.column("side").to_numpy(), t.column("fp").to_numpy().view(np.uint64)
        a, b = np.sort(fp[side == 0]), np.sort(fp[side == 1])
        if t.num_rows and not (side == 1).any():
            found = _forest(len(a), walk(a, None, max_bits))
            v = a
        else:
            found = _forest(len(a) + len(b), ((i, j + len(a)) for i, j in walk(a, b, max_bits)))
            v = np.concatenate([a, b])
        x = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": v[x[:, 0]].view(np.int64), "b": v[x[:, 1]].view(np.int64)})

    # an index pair (i, j), i < j, of which one node has no rows cannot occur: nodes are made from counts
    dealt = distinct.select("fp").mapInArrow(deal, "pair int, side int, fp long")
    return dealt.groupBy("pair").applyInArrow(pair, "a long, b long")


def simhash_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3,
                    max_bits: int = 2, n_nodes: int = 128) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    fps = stored(fingerprints(docs, text, doc_id, words), "simhash-fps")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    comp = components(links(distinct, max_bits, n_nodes))
    named = stored(distinct.join(comp, distinct["fp"] == comp["node"], "left")
                   .select("fp", "rep", F.coalesce("component", "fp").alias("c")), "simhash-named")
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    by_fp = named.join(least, "c").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` of which one of each near-duplicate group stays: that of the smallest id, rows
    without an id last. Rows are told apart by id and text, so repeated ids replace each other within a
    group only. Columns may have any name."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(doc_id, text).alias("key"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    groups = simhash_classes(rows.select("key", "text"), doc_id="key", **options).select(F.col("doc_id").alias("key"), "component_id").distinct()
    first = (rows.select("key", "id").distinct().join(groups, "key").groupBy("component_id")
             .agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")).alias("f")).select("f.key", F.col("f.id").alias("kept_id")))
    kept = rows.join(first, (rows["key"] == first["key"]) & rows["id"].eqNullSafe(first["kept_id"]), "left_semi")
    return kept.dropDuplicates(["key", "id"]).select("row.*")

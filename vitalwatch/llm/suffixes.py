"""Suffix-array dedup of byte strings of ``length`` that occur more than once.

Each window of ``length`` bytes belongs to the q-gram in it of the least hash;
neighbouring windows of one q-gram form a run. Runs whose q-gram occurs once
hold nothing repeated. Of the others, runs of equal bytes are repeated as a
whole; different runs of one q-gram travel with their bytes to buckets, where
suffixes are sorted by bucket-pointer refinement: 8-byte buckets first, then
by the bucket ids at offsets 8, 16, 32, ..., each pass reusing the refined ids.
Runs of a q-gram with very many different runs are split by window hash.

Null and empty texts have no bytes; repeated rows are copies of each other;
texts are told apart by id and hash of the text, so rows of one id (or of none) with different
texts are documents of their own; very long texts travel in overlapping pieces; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored

Q, PIECE = 64, 1 << 19
M64 = (1 << 64) - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    odd = 0x9E3779B97F4A7C15
    inverse = pow(odd, -1, 1 << 64)
    out = []
    for x in (odd, inverse):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Runs:
    """Runs of windows in byte buffers of up to PIECE bytes."""

    def __init__(self, length: int):
        self.length, self.w = length, length - Q + 1
        self.table = np.random.default_rng(7).integers(0, M64, 256, np.uint64, endpoint=True) | np.uint64(1)
        self.up, self.down = _powers(PIECE + 4 * length)

    def of(self, buf: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first window, number of windows, q-gram hash); stops: the ends of the texts in buf."""
        n = len(buf) - Q + 1
        if len(buf) < self.length:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        a = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.table[buf] * self.up[: len(buf)], out=a[1:])
        h = (a[Q:] - a[:-Q]) * self.down[:n]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        v = (h >> np.uint64(20) << np.uint64(20)) | np.arange(n, dtype=np.uint64)
        w, full = self.w, -(-n // self.w) * self.w
        pad = np.full(full, M64, np.uint64)
        pad[:n] = v
        rows = pad.reshape(-1, w)
        left = np.minimum.accumulate(rows, axis=1).ravel()
        right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        k = len(buf) - self.length + 1
        least = np.minimum(right[:k], left[w - 1 : w - 1 + k])
        end = stops[np.searchsorted(stops, np.arange(k), side="right")]
        valid = np.arange(k) + self.length <= end
        new = np.r_[True, (least[1:] != least[:-1]) | (end[1:] != end[:-1]) | (valid[1:] != valid[:-1])]
        head = np.flatnonzero(new)
        m = np.diff(np.r_[head, k])
        ok = valid[head]
        return head[ok], m[ok], h[(least[head[ok]] & np.uint64((1 << 20) - 1)).astype(np.int64)]


def runs(docs: DataFrame, length: int) -> DataFrame:
    """(h, c, d, t, s, m): q-gram hash, hash of the run's bytes, document, first window, windows."""
    def flush(r, parts, meta):
        buf = np.frombuffer(b"".join(parts), np.uint8)
        stops = np.cumsum([len(x) for x in parts])
        head, m, h = r.of(buf, stops)
        at = np.searchsorted(stops, head, side="right")
        raw = buf.tobytes()
        c = np.array([xxhash.xxh3_64_intdigest(raw[a : a + n + length - 1]) for a, n in zip(head.tolist(), m.tolist(), strict=True)], np.uint64)
        start = np.r_[0, stops[:-1]]
        off = np.array([x[2] for x in meta], np.int64)
        return pa.record_batch([
            pa.array(h.view(np.int64)), pa.array(c.view(np.int64)),
            pa.array([meta[i][0] for i in at.tolist()], pa.int64()), pa.array([meta[i][1] for i in at.tolist()], pa.int64()),
            pa.array(head - start[at] + off[at]), pa.array(m.astype(np.int32))], names=["h", "c", "d", "t", "s", "m"])

    def run(batches):
        r, parts, meta, held = Runs(length), [], [], 0
        for b in _few(batches):
            for d, t, x in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                step = PIECE - length
                for o in range(0, max(1, len(x) - length + 1), step):
                    y = x[o : o + step + length - 1]
                    if len(y) < length:
                        continue
                    if held + len(y) > PIECE:
                        yield flush(r, parts, meta)
                        parts, meta, held = [], [], 0
                    parts.append(y), meta.append((d, t, o))
                    held += len(y)
        if parts:
            yield flush(r, parts, meta)

    return docs.select("d", "t", "b").mapInArrow(run, "h long, c long, d long, t long, s long, m int")


def _heads(x: np.ndarray) -> np.ndarray:
    """For each place of a sorted array the first place of the same value."""
    out = np.arange(len(x), dtype=np.int32 if len(x) < 1 << 31 else np.int64)
    out[1:][x[1:] == x[:-1]] = 0
    return np.maximum.accumulate(out, out=out)


def repeated(buf: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each window start: whether the same ``length`` bytes start at another of them.

    Holds about 55 bytes for each byte of ``buf`` at most."""
    n = len(buf)
    full = np.concatenate([buf, np.zeros(length + 8, np.uint8)])
    key = np.ndarray(n + length, ">u8", full, strides=(1,)).astype(np.uint64)
    # a bucket's id is its place in the sorted order, so a refined one finds room for its parts
    order = np.argsort(key)
    key = key[order]
    head = _heads(key)
    del key
    rank = np.empty_like(head)
    rank[order] = head
    del order, head
    depth = 8
    while depth < length:
        step = min(depth, length - depth)
        live = np.flatnonzero((np.bincount(rank) > 1)[rank])  # buckets of one suffix are done
        if not len(live):
            break
        pair = rank[live].astype(np.int64)
        pair *= len(rank) + 1
        inside = np.searchsorted(live, len(rank) - step)  # the others have nothing that far on
        pair[:inside] += rank[live[:inside] + step]
        pair[:inside] += 1
        order = np.argsort(pair)
        live, pair = live[order], pair[order]
        del order
        head = _heads(pair)
        del pair
        old = rank[live]
        head -= _heads(old)
        old += head
        rank[live] = old
        depth += step
    own = rank[starts]
    return np.bincount(own, minlength=1)[own] > 1


def _few(batches, rows: int = 512):
    """The same rows a few at a time, so that a batch is never held whole as Python objects."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def _ranges(ok: np.ndarray, run: np.ndarray, pos: np.ndarray):
    """(run, first, number) of neighbouring windows marked in one run."""
    i = np.flatnonzero(ok)
    if not len(i):
        return i, i, i
    new = np.flatnonzero(np.r_[True, (np.diff(i) != 1) | (run[i][1:] != run[i][:-1])])
    return run[i[new]], pos[i[new]], np.diff(np.r_[new, len(i)])


def repeated_spans(docs: DataFrame, length: int, hot: int | None = None, bucket_bytes: int = 2 << 20) -> DataFrame:
    """(d, t, s, n): windows s .. s + n - 1 of a document whose bytes occur elsewhere too.

    ``hot``: different runs of one q-gram beyond which they are split by window hash; by default
    those that would fill two buckets of ``bucket_bytes`` alone."""
    hot = 2 * bucket_bytes // length if hot is None else hot
    r = runs(docs, length)
    twice = r.groupBy("h").count().where("count > 1").select("h")
    some = stored(r.join(twice, "h", "left_semi"), "suffix-runs")
    by_run = stored(some.groupBy("h", "c").agg(F.count("*").alias("copies"), F.min(F.struct("d", "t", "s", "m")).alias("rep")), "suffix-kinds")
    sure = some.join(by_run.where("copies > 1").select("h", "c"), ["h", "c"], "left_semi").select("d", "t", "s", F.col("m").cast("long").alias("n"))
    kinds = by_run.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    open_ = stored(by_run.join(kinds, "h").select("h", "copies", "kinds", "rep.*"), "suffix-open")
    buckets = max(1, -(-open_.count() * (2 * length) // bucket_bytes))
    wanted = (open_.groupBy("d", "t").agg(F.collect_list(F.struct(
        F.pmod("h", F.lit(buckets)).cast("int").alias("g"), "s", "m", (F.col("copies") == 1).alias("one"),
        (F.col("kinds") > hot).alias("hot"))).alias("runs")))
    texts = docs.join(wanted.withColumnsRenamed({"d": "d2", "t": "t2"}),
                      docs["d"].eqNullSafe(F.col("d2")) & (docs["t"] == F.col("t2"))).select("d", "t", "b", "runs")

    def cut(batches):
        for b in _few(batches):
            rows = []
            for d, t, x, rs in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                rows += [(d, t, k["s"], k["g"], k["one"], k["hot"], x[k["s"] : k["s"] + k["m"] + length - 1]) for k in rs]
            for k in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(v, y) for v, y in zip(zip(*rows[k : k + 20_000], strict=True), (
                    pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()), strict=True)],
                    names=["d", "t", "s", "g", "one", "hot", "x"])

    pieces = stored(texts.mapInArrow(cut, "d long, t long, s long, g int, one boolean, hot boolean, x binary"), "suffix-bytes")

    def refine(t: pa.Table) -> pa.Table:
        xs = t.column("x").to_pylist()
        lens = np.array([len(x) for x in xs], np.int64)
        first = np.cumsum(lens) - lens
        n = lens - length + 1
        run = np.repeat(np.arange(len(xs)), n)
        pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ok = repeated(np.frombuffer(b"".join(xs), np.uint8), first[run] + pos, length)
        ok &= t.column("one").to_numpy(zero_copy_only=False).astype(bool)[run]
        i, a, k = _ranges(ok, run, pos)
        return pa.table({"d": t.column("d").take(pa.array(i)).combine_chunks(), "t": t.column("t").take(pa.array(i)).combine_chunks(),
                         "s": pa.array(t.column("s").to_numpy()[i] + a), "n": pa.array(k.astype(np.int64))})

    found = pieces.where("not hot").select("d", "t", "s", "g", "one", "x").groupBy("g").applyInArrow(refine, "d long, t long, s long, n long")

    def windows(batches):
        for b in batches:
            for d, t, s, x in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                hs = [xxhash.xxh3_128_digest(x[i : i + length]) for i in range(len(x) - length + 1)]
                k = len(hs)
                yield pa.record_batch([pa.array([d] * k, pa.int64()), pa.array([t] * k, pa.int64()),
                                       pa.array(np.arange(s, s + k)), pa.array(hs, pa.binary())], names=["d", "t", "s", "w"])

    each = pieces.where("hot").select("d", "t", "s", "x").mapInArrow(windows, "d long, t long, s long, w binary")
    again = each.groupBy("w").count().where("count > 1").select("w")
    split = each.join(again, "w", "left_semi").select("d", "t", "s", F.lit(1).cast("long").alias("n"))
    return sure.unionByName(found).unionByName(split)


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 200) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): kept holds the bytes that stay."""
    own = docs.select(F.col(doc_id).alias("d"), F.xxhash64(F.col(text)).alias("t"),
                      F.coalesce(F.col(text), F.lit("")).cast("binary").alias("b"))
    spans = (repeated_spans(own, length).groupBy("d", "t").agg(F.collect_list(F.struct("s", "n")).alias("spans"))
             .withColumnsRenamed({"d": "d2", "t": "t2"}))
    j = own.join(spans, own["d"].eqNullSafe(F.col("d2")) & (own["t"] == F.col("t2")), "left").select("d", "b", "spans")

    def take(batches):
        for b in _few(batches):
            out = []
            for d, x, sp in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                edge = np.zeros(len(x) + 1, np.int64)
                for p in sp or ():
                    edge[p["s"]] += 1
                    edge[p["s"] + p["n"] + length - 1] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
                n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((d, len(x), len(x) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], y) for k, y in enumerate(kinds)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return j.mapInArrow(take, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")

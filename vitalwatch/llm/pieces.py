"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The model file gives pieces, scores (taken as log scores) and kinds. Blanks
become the marker, one marker is put in front, and the text is cut before each
marker that follows another character: no piece crosses such a cut (checked),
so the best path of a text is that of its words, which are solved together in
numpy, each distinct word of a batch once. Of equal paths the one whose last
piece starts first wins. A character without a piece becomes its UTF-8 bytes.

Null and empty texts have no pieces; very long words only cost more rounds.
"""

from __future__ import annotations

import re
import struct
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import kept
from .tokens import Places, Pool

MARK, NORMAL, BYTE, USER = "▁", 1, 6, 4
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes):
    """(number, value) of the fields of a protocol buffer message; texts, numbers and floats as they lie."""
    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value, shift, i, more = value | (data[i] & 127) << shift, shift + 7, i + 1, data[i] & 128
            if not more:
                return value, i

    i = 0
    while i < len(data):
        tag, i = number(i)
        if tag & 7 == 0:
            value, i = number(i)
        else:
            n, i = (8, i) if tag & 7 == 1 else (4, i) if tag & 7 == 5 else number(i)
            value, i = data[i : i + n], i + n
        yield tag >> 3, value


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id, from the model file: field 1 of the file, its fields 1, 2 and 3."""
    with open(path, "rb") as f:
        data = f.read()
    out = []
    for number, value in _fields(data):
        if number == 1:
            got = {1: b"", 2: bytes(4), 3: NORMAL} | dict(_fields(value))
            out.append((got[1].decode(), struct.unpack("<f", got[2])[0], got[3]))
    return out


class Model:
    """Double-array trie (base, check) over character codes, with piece ids at end states."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.texts = [p for p, _, _ in pieces]
        self.score = np.array([s for _, s, _ in pieces], float)
        self.kind = np.array([k for _, _, k in pieces])
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        top = max((x for _, x, k in pieces if k == NORMAL), default=0.0)
        for i, (p, _, k) in enumerate(pieces):
            if k == USER:
                self.score[i] = len(p.encode()) * top - 0.1
        normal = {p: i for i, (p, _, k) in enumerate(pieces) if k in (NORMAL, USER)}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in normal):
            raise ValueError("a piece crosses a word")
        self.unknown = min(pieces[i][1] for i in normal.values()) - UNKNOWN_PENALTY if normal else -UNKNOWN_PENALTY
        self.unk_id = next((i for i, (_, _, k) in enumerate(pieces) if k == 2), 0)
        chars = sorted({c for p in normal for c in p})
        self.points = np.array([ord(c) for c in chars], np.int64)
        code = {c: i + 1 for i, c in enumerate(chars)}
        tree: list[dict[int, int]] = [{}]
        end = {}
        for p, i in normal.items():
            at = 0
            for c in p:
                nxt = tree[at].get(code[c])
                if nxt is None:
                    nxt = tree[at][code[c]] = len(tree)
                    tree.append({})
                at = nxt
            end[at] = i
        self.depth = max(map(len, normal), default=1)
        size = len(tree) * 2 + 2 * len(chars) + 16
        base, check, leaf, used = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64), bytearray(size)
        used[0], place, free, tail = 1, {0: 0}, 1, 1
        for node, kids in enumerate(tree):
            if not kids:
                continue
            low = min(kids)
            while used[free]:
                free += 1
            # a few tries in the gaps, then behind all others
            b = next((x for x in range(max(1, free - low), max(1, free - low) + 64)
                      if not any(x + c < len(used) and used[x + c] for c in kids)), None)
            b = max(1, tail - low) if b is None else b
            tail = max(tail, b + max(kids) + 1)
            if b + max(kids) >= len(used):
                more = b + max(kids) + len(chars) + 16 - len(used)
                used += bytearray(more)
                base, check, leaf = (np.concatenate([x, np.full(more, f, np.int64)]) for x, f in ((base, 0), (check, -1), (leaf, -1)))
            s = place[node]
            base[s] = b
            for c, kid in kids.items():
                used[b + c], place[kid], check[b + c] = 1, b + c, s
                leaf[b + c] = end.get(kid, -1)
        self.base, self.check, self.leaf = base, check, leaf

    def _codes(self, points: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.points, points)
        at[at == len(self.points)] = 0
        return np.where(self.points[at] == points, at + 1, 0) if len(self.points) else np.zeros(len(points), np.int64)

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids of all non-empty words, number of pieces of each)."""
        lens = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        n, codes = len(points), self._codes(points)
        first = np.repeat(np.cumsum(lens) - lens, lens)
        last = first + np.repeat(lens, lens)  # one past the word
        starts, ends, ids = [], [], []
        at, state = np.arange(n), np.zeros(n, np.int64)
        for d in range(self.depth):
            live = at + d < last[at]
            at, state = at[live], state[live]
            c = codes[at + d]
            to = self.base[state] + c
            ok = (c > 0) & (to < len(self.check))
            ok[ok] &= self.check[to[ok]] == state[ok]
            at, state = at[ok], to[ok]
            hit = self.leaf[state] >= 0
            starts.append(at[hit]), ends.append(at[hit] + d + 1), ids.append(self.leaf[state[hit]])
            if not len(at):
                break
        alone = np.ones(n, bool)
        alone[starts[0]] = False
        lone = np.flatnonzero(alone)
        starts.append(lone), ends.append(lone + 1), ids.append(np.full(len(lone), -1))
        s, e, p = map(np.concatenate, (starts, ends, ids))
        gain = np.where(p >= 0, self.score[p], self.unknown)
        # edges by offset of their end inside the word, then end, then start
        off = e - first[e - 1]
        order = np.lexsort((s, e, off))
        s, e, p, gain, off = s[order], e[order], p[order], gain[order], off[order]
        best, back, piece = np.full(n + 1, -np.inf), np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        # best[i]: best path of the word's characters up to global end i; a word's start counts 0
        cut = np.searchsorted(off, np.arange(1, int(lens.max(initial=0)) + 2))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            es, ss = e[a:b], s[a:b]
            total = np.where(ss == first[ss], 0.0, best[ss]) + gain[a:b]
            head = np.flatnonzero(np.r_[True, es[1:] != es[:-1]])
            top = np.maximum.reduceat(total, head)
            win = np.flatnonzero(total == np.repeat(top, np.diff(np.r_[head, len(es)])))
            keep = win[np.r_[True, es[win][1:] != es[win][:-1]]]
            best[es[keep]], back[es[keep]], piece[es[keep]] = total[keep], ss[keep], p[a:b][keep]
        # all words walk back together, a piece a step
        at, live = np.cumsum(lens), np.arange(len(words))
        begin, steps = at - lens, []
        while len(live):
            i = at[live]
            steps.append((live, piece[i], back[i]))
            at[live] = back[i]
            live = live[back[i] > begin[live]]
        owner, ids, start = (np.concatenate([x[k] for x in reversed(steps)]) for k in range(3))
        order = np.argsort(owner, kind="stable")
        owner, ids, start = owner[order], ids[order], start[order]
        width = np.ones(len(ids), np.int64)
        lost = np.flatnonzero(ids < 0)
        if len(lost):  # characters without a piece
            code = points[start[lost]]
            if self.bytes:
                width[lost] = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
            raw = "".join(map(chr, code.tolist())).encode("utf-8", "surrogatepass")
            spread = np.repeat(ids < 0, width)
            ids, owner = np.repeat(ids, width), np.repeat(owner, width)
            ids[spread] = [self.bytes[x] for x in raw] if self.bytes else self.unk_id
        return ids.astype("<i4"), np.bincount(owner, minlength=len(words))


class Codec:
    """Encodes whole texts; words seen before come from a table, new ones of many texts are solved at once.

    The table is emptied before a call when it holds ``most`` words or ``most_chars`` characters of words, so it is
    bounded in bytes also where texts have no blanks."""

    def __init__(self, model: Model, most: int = 800_000, most_chars: int = 20_000_000):
        self.m, self.most, self.most_chars = model, most, most_chars
        self._empty()

    def _empty(self) -> None:
        self.words, self.pool, self.chars = Places(), Pool("<i4"), 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids of each text."""
        if len(self.words) > self.most or self.chars > self.most_chars:
            self._empty()
        known, counts, places = len(self.pool), np.zeros(len(texts), np.int64), []
        for k, t in enumerate(texts):
            ws = WORD.findall(MARK + t.replace(" ", MARK)) if t else []
            counts[k] = len(ws)
            places.append(np.fromiter(map(self.words.__getitem__, ws), np.int64, len(ws)))
        new = list(islice(self.words, known, None))
        order = sorted(range(len(new)), key=lambda i: len(new[i]))  # words of a length take the same rounds
        solved = Pool("<i4")
        for k in range(0, len(order), 20_000):
            solved.add(*self.m.solve([new[i] for i in order[k : k + 20_000]]))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.pool.add(*solved.take(back))
        ids, lengths = self.pool.take(np.concatenate(places) if places else np.zeros(0, np.int64))
        total, ends = np.concatenate([[0], np.cumsum(lengths)]), np.cumsum(counts)
        self.chars += sum(map(len, new))
        return np.split(ids, total[ends][:-1])

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, texts: list[np.ndarray]) -> list[str]:
        """Runs of byte pieces become UTF-8, markers blanks, and the blank in front goes."""
        data, widths = self._raw.take(np.concatenate(texts) if texts else np.zeros(0, np.int64))
        total, ends = np.concatenate([[0], np.cumsum(widths)]), np.cumsum([len(x) for x in texts])
        data, at, out = data.tobytes(), 0, []
        for e in total[ends].tolist():
            text = data[at:e].decode("utf-8", "replace").replace(MARK, " ")
            out.append(text[1:] if text.startswith(" ") else text)
            at = e
        return out

    @property
    def _raw(self) -> Pool:
        """The bytes of every piece."""
        if not hasattr(self, "_r"):
            of = {i: bytes([b]) for b, i in self.m.bytes.items()}
            raw = [of.get(i, b"" if k == 3 else t.encode()) for i, (t, k) in enumerate(zip(self.m.texts, self.m.kind, strict=True))]
            self._r = Pool("u1")
            self._r.add(np.frombuffer(b"".join(raw), "u1"), np.array([len(x) for x in raw]))
        return self._r


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", doc_id: str = "doc_id",
                     max_model_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, n_pieces, n_bytes, ids, decoded): decoded tells whether decoding gives the text again
    (a marker character in the text reads back as a blank)."""
    model = Model(read_pieces(model_path))
    if sum(x.nbytes for x in (model.base, model.check, model.leaf)) > max_model_bytes:
        raise ValueError("the model is larger than max_model_bytes")
    # its size is that of the vocabulary, checked above; a worker keeps its words from task to task
    key = ("pieces", model_path, len(model.texts), float(model.score.sum()))

    def run(batches):
        codec = kept(key, lambda: Codec(model))
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                texts = [t or "" for t in b.column(1).to_pylist()]
                ids = codec.encode(texts)
                offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                flat = np.concatenate(ids)
                yield pa.record_batch([
                    b.column(0), pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array([int((codec.m.kind[x] == BYTE).sum()) for x in ids], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array([x == t.replace(MARK, " ") for x, t in zip(codec.decode_all(ids), texts, strict=True)]),
                ], names=["doc_id", "n_pieces", "n_bytes", "ids", "decoded"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_pieces long, n_bytes long, ids array<int>, decoded boolean")

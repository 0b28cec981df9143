"""Token ids in a packed binary format, and back.

A shard file holds ``bits`` bits per id, in blocks of ``BLOCK`` ids, then a
table of documents and the offset of each block:

    b"VWTOKS01" | bits u32, block u32, n_ids u64, n_docs u64
    blocks, each padded to a whole byte
    block offsets u64 (one more than blocks) | doc ids i64 | null flags u8 | doc starts u64 (one more)

Documents go to shards in ascending order of id (nulls first; repeated ids by
the hash of the text). A task writes under a name of its own attempt and the
manifest names the file, so what a lost executor leaves behind is never read.
Null and empty texts hold the end id only; a text of any length goes through block by
block; repeated rows and ids are documents like others; an empty table gives no rows;
extra columns are not read. The width comes from the tokenizer's size and the end id,
and an id that does not fit is an error.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import kept, new_path, stored

MAGIC, HEAD, BLOCK = b"VWTOKS01", "<8sIIQQ", 65536
HEAD_SIZE = struct.calcsize(HEAD)
WORD = re.compile(r"[^ \n\t\r]+")
# what Arrow's split takes for white space besides: texts with any of it are cut by WORD
MORE_SPACE = "\x0b\x0c"
# letters and ASCII marks whose runs the tokenizer's pattern always parts; no apostrophe, no "<"
PLAIN = re.compile(r"(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:;=-@\[-`{-~]+)+")
PART = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:;=-@\[-`{-~]+")
MARKS = frozenset(c for c in map(chr, range(128)) if PART.fullmatch(c) and not c.isalpha())
# texts encoded at once: so many, and so many bytes unless one text has more
SOME, SOME_BYTES = 1024, 4 << 20


class Places(dict):
    """Text -> place in the order of first sight; a lookup of a new text gives it one."""

    def __missing__(self, text: str) -> int:
        place = self[text] = len(self)
        return place


def newest(places: Places, n: int) -> list[str]:
    """The last ``n`` texts, in their order."""
    return list(islice(reversed(places), n))[::-1]


class Pool:
    """Id sequences one after another; sequence i is ids[start[i] : start[i + 1]]."""

    def __init__(self, kind: str = "<u4"):
        self.ids, self.start = np.zeros(0, kind), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.start) - 1

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths, dtype=np.int64)])

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the sequences in this order, length of each)."""
        lengths = self.start[places + 1] - self.start[places]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[places] - ends + lengths, lengths)
        return self.ids[at], lengths


class Encoder:
    """Whole texts through the tokenizers library; words and parts seen before come from a table.

    The tokenizer drops white space and never joins over it, so a text's ids are those of
    its words, and those of a plain word are those of its runs of letters and of marks. Texts
    are cut into words by place, new words of many texts are encoded at once, and the ids of
    all are gathered by numpy. Where the tokenizer ends every run by a token of its own kind
    (the end-of-word suffix), new runs go through the library as one long text.

    Each table is emptied at ``most`` entries (bounded memory); parts are fewer and cost more, so they stay when
    the words go. The file is read at first use."""

    def __init__(self, path: str, most: int = 1_000_000):
        self.path, self.most, self.t = path, most, None
        self.words, self.word_ids, self.parts, self.part_ids = Places(), Pool(), Places(), Pool()

    def _make_room(self) -> None:
        if len(self.words) > self.most:
            self.words, self.word_ids = Places(), Pool()
        if len(self.parts) > self.most:
            self.parts, self.part_ids = Places(), Pool()

    def load(self):
        if self.t is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.t = Tokenizer.from_file(self.path)
            suffix = getattr(self.t.model, "end_of_word_suffix", None)
            n = self.t.get_vocab_size()
            self.ends = np.array([(self.t.id_to_token(i) or "").endswith(suffix) for i in range(n)]) if suffix else None
        return self.t

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.load().encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)

    def _library(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, length of each run)."""
        out = []
        t = self.load()
        for k in range(0, len(runs), 4096):
            some = runs[k : k + 4096]
            if self.ends is not None:
                ids = np.array(t.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == len(some) and (not len(ids) or ends[-1] == len(ids)):
                    out.append((ids, np.diff(ends, prepend=0)))
                    continue
            out.append(self._one_by_one(some))
        return np.concatenate([i for i, _ in out] or [np.zeros(0, "<u4")]), np.concatenate([n for _, n in out] or [np.zeros(0, np.int64)])

    def _learn(self) -> None:
        """Ids of the words that have a place but no ids yet."""
        new = newest(self.words, len(self.words) - len(self.word_ids))
        if not new:
            return
        runs, n_runs, odd = [], [], []
        for w in new:
            if w.isascii() and w.isalpha():  # one run
                runs.append(w)
                n_runs.append(1)
            elif w.isascii() and w[-1:] in MARKS and w[:-1].isalpha():
                runs += w[:-1], w[-1]
                n_runs.append(2)
            elif PLAIN.fullmatch(w):
                runs += (ps := PART.findall(w))
                n_runs.append(len(ps))
            else:
                odd.append(w)
                n_runs.append(-1)
        runs = "\n".join(runs).lower().split("\n") if runs else runs
        places = np.fromiter(map(self.parts.__getitem__, runs), np.int64, len(runs))
        lack = newest(self.parts, len(self.parts) - len(self.part_ids))
        if lack:
            self.part_ids.add(*self._library(lack))
        run_ids, run_lengths = self.part_ids.take(places)
        odd_ids, odd_lengths = self._one_by_one(odd) if odd else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        # lengths of the words in order; plain ones are sums over their runs
        n_runs = np.array(n_runs)
        is_odd = n_runs < 0
        lengths = np.zeros(len(new), np.int64)
        ends = np.cumsum(n_runs[~is_odd])
        total = np.concatenate([[0], np.cumsum(run_lengths)])
        lengths[~is_odd] = total[ends] - total[ends - n_runs[~is_odd]]
        lengths[is_odd] = odd_lengths
        owner = np.repeat(is_odd, lengths)
        ids = np.zeros(len(owner), "<u4")
        ids[~owner], ids[owner] = run_ids, odd_ids
        self.word_ids.add(ids, lengths)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); null is an empty text."""
        self._make_room()
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).fill_null("")
        if any(pc.any(pc.match_substring(texts, c)).as_py() for c in MORE_SPACE):
            words = pa.array([WORD.findall(t) for t in texts.to_pylist()], pa.large_list(pa.large_string()))
        else:
            words = pc.ascii_split_whitespace(texts)  # an empty word has no ids
        # a word is looked up once for all texts
        coded = words.flatten().dictionary_encode()
        met = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.words.__getitem__, met), np.int64, len(met))
        self._learn()
        ids, lengths = self.word_ids.take(places[coded.indices.to_numpy()])
        counts = words.value_lengths().to_numpy().astype(np.int64)
        total, ends = np.concatenate([[0], np.cumsum(lengths)]), np.cumsum(counts)
        return ids, total[ends] - total[ends - counts]


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits for each id, highest first."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - bits :]
    return np.packbits(wide.ravel()).tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype("<u4")
    bit = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits :] = bit
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


class ShardWriter:
    def __init__(self, out, bits: int):
        self.out, self.bits, self.held, self.n_held, self.n_ids = out, bits, [], 0, 0
        self.offsets, self.ids, self.nulls, self.starts, self.at = [HEAD_SIZE], [], [], [0], HEAD_SIZE
        out.write(struct.pack(HEAD, MAGIC, bits, BLOCK, 0, 0))

    def _block(self, ids: np.ndarray) -> None:
        packed = pack(ids, self.bits)
        self.out.write(packed)
        self.at += len(packed)
        self.offsets.append(self.at)

    def add(self, doc_ids: list[int | None], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents one after another: ``lengths`` cuts ``ids``."""
        self.starts += (self.n_ids + np.cumsum(lengths)).tolist()
        self.n_ids += len(ids)
        self.ids += [i or 0 for i in doc_ids]
        self.nulls += [i is None for i in doc_ids]
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            line = np.concatenate(self.held)
            whole = len(line) // BLOCK * BLOCK
            for k in range(0, whole, BLOCK):
                self._block(line[k : k + BLOCK])
            self.held, self.n_held = [line[whole:]], len(line) - whole

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        for x, kind in ((self.offsets, "<u8"), (self.ids, "<i8"), (self.nulls, "u1"), (self.starts, "<u8")):
            self.out.write(np.array(x, kind).tobytes())
        self.out.write(struct.pack(HEAD, MAGIC, self.bits, BLOCK, self.n_ids, len(self.ids)))
        self.out.close()


class ShardReader:
    """Random access by id position; reads only the blocks it needs."""

    def __init__(self, file):
        self.f, size = file, file.size()
        self.magic, self.bits, self.block, self.n_ids, self.n_docs = struct.unpack(HEAD, self._at(size - HEAD_SIZE, HEAD_SIZE))
        if self.magic != MAGIC:
            raise ValueError("not a token file")
        n = -(-self.n_ids // self.block) + 1
        tail, k = self._at(size - HEAD_SIZE - 8 * n - 17 * self.n_docs - 8, 8 * n + 17 * self.n_docs + 8), 8 * n
        self.offsets = np.frombuffer(tail[:k], "<u8")
        self.ids = np.frombuffer(tail[k : k + 8 * self.n_docs], "<i8")
        self.nulls = np.frombuffer(tail[k + 8 * self.n_docs : k + 9 * self.n_docs], "u1").astype(bool)
        self.starts = np.frombuffer(tail[k + 9 * self.n_docs :], "<u8")

    def _at(self, at: int, n: int) -> bytes:
        self.f.seek(int(at))
        return self.f.read(int(n))

    def tokens(self, a: int, b: int) -> np.ndarray:
        """Ids at positions [a, b)."""
        if a >= b:
            return np.zeros(0, "<u4")
        first, last = a // self.block, (b - 1) // self.block
        parts = [unpack(self._at(self.offsets[k], self.offsets[k + 1] - self.offsets[k]), self.bits,
                        min(self.block, self.n_ids - k * self.block)) for k in range(first, last + 1)]
        return np.concatenate(parts)[a - first * self.block : b - first * self.block]


def some(texts: pa.Array):
    """(first, number) of runs of up to SOME texts and SOME_BYTES bytes, or of one larger text."""
    ends, k = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64), 0
    while k < len(texts):
        before = int(ends[k - 1]) if k else 0
        n = min(SOME, int(np.searchsorted(ends, before + SOME_BYTES, side="right")) - k)
        yield k, max(1, n)
        k += max(1, n)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, bits: int,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Writes the shards and returns the manifest (shard, file, n_docs, n_ids), one row per file."""
    def run(batches):
        encoder, writer, shard = kept(("tokens", tokenizer), lambda: Encoder(tokenizer)), None, None
        store, root = pafs.FileSystem.from_uri(path)
        for b in batches:
            numbers, texts = b.column(1).to_pylist(), b.column(2)
            if writer is None and len(texts):
                shard = b.column(0)[0].as_py()
                store.create_dir(root, recursive=True)
                name = f"{shard:07d}-{uuid.uuid4().hex}.tok"
                writer = ShardWriter(store.open_output_stream(f"{root}/{name}"), bits)
            for k, n in some(texts):  # a few texts at a time: bounded memory
                ids, lengths = encoder.encode(texts.slice(k, n))
                writer.add(numbers[k : k + n], np.insert(ids, np.cumsum(lengths), end_id), lengths + 1)
        if writer is not None:
            writer.close()
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(writer.ids)], pa.int64()),
                                   pa.array([writer.n_ids], pa.int64())], names=["shard", "file", "n_docs", "n_ids"])

    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = (docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).withColumn("h", F.xxhash64("t"))
             .repartitionByRange(int(parts), "i", "h").sortWithinPartitions("i", "h")
             .select(F.spark_partition_id().alias("shard"), "i", "t"))
    return stored(dealt.mapInArrow(run, "shard int, file string, n_docs long, n_ids long"), "token-manifest")


def read_tokens(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    # one row per file
    placed = manifest.withColumn("base", F.sum("n_ids").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids"))

    def run(batches):
        store, root = pafs.FileSystem.from_uri(path)
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{name}") as f:
                    r = ShardReader(f)
                    crc, n_tokens, k = [], np.diff(r.starts.astype(np.int64)), 0
                    while k < r.n_docs:  # documents in runs of about 16 blocks
                        e = max(k + 1, int(np.searchsorted(r.starts, r.starts[k] + np.uint64(16 * BLOCK))))
                        e = min(e, r.n_docs)
                        ids, a = r.tokens(int(r.starts[k]), int(r.starts[e])), int(r.starts[k])
                        crc += [zlib.crc32(ids[int(r.starts[x]) - a : int(r.starts[x + 1]) - a].tobytes()) for x in range(k, e)]
                        k = e
                    yield pa.record_batch([pa.array(r.ids, mask=r.nulls), pa.array(r.starts[:-1].astype(np.int64) + base),
                                           pa.array(n_tokens), pa.array(crc, pa.int64())],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # a task per file: a count given outright is not coalesced, however few bytes the manifest has
    return (placed.select("file", "base", "shard").repartitionByRange(max(1, manifest.count()), "shard")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def width(tokenizer: str, end_id: int) -> int:
    """Bits for every id of the tokenizer and the end id."""
    return max(1, max(Encoder(tokenizer).load().get_vocab_size() - 1, end_id).bit_length())


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    path = new_path(docs.sparkSession, "tokens")
    path = path if "://" in path or not path.startswith("file:") else "file://" + path[5:]
    path = path if ":" in path else "file://" + path
    manifest = write_tokens(docs, path, tokenizer, end_id, width(tokenizer, end_id))
    return read_tokens(manifest, path)

"""The operators against brute force on small rows: nulls, empty texts, repeats, ties, empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("vitalwatch.llm")
from vitalwatch.llm import lines, mixing, pieces, quality, simhash, suffixes, tokens, topk, urls  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, sources=("a",)):
    rows = [(i, t, "en", sources[i % len(sources)], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "cat", "sea", "Über", "a", "runs", "é"]) + rng.choice(["", ",", "."]) for _ in range(n))


def brute_repeats(ws):
    grams = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)]
    seen = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)})


def test_quality_measures(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a a a a a", "x\ny\nx\n\nx", "# $ a|b", *[prose(rng, n) for n in (3, 60, 200)]]
    got = {r["doc_id"]: r for r in quality.quality_rules(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
        assert got[i]["q_n_words"] == len(ws) and got[i]["q_word_chars"] == sum(map(len, ws))
        assert got[i]["q_n_repeat_words"] == brute_repeats(ws)
        full = [x for x in (t or "").split("\n") if x.strip()]
        assert got[i]["q_n_dup_lines"] == len(full) - len(set(full))
        assert got[i]["q_kept"] <= (not got[i]["q_base_failed"])
    assert quality.quality_rules(docs(spark, [])).count() == 0


def test_quality_weighs_repeated_lines_by_words(spark):
    words = " ".join(f"the w{chr(97 + i // 26)}{chr(97 + i % 26)}x" for i in range(60))
    own = [" ".join(words.split()[i : i + 40]) for i in (0, 40, 80)]
    # one short line four times in a text of seven lines; a long line four times
    texts = ["\n".join([*own, *["Les pages"] * 4]), "\n".join([*own, *[" ".join(own[0].split()[:20])] * 4])]
    got = {r["doc_id"]: r for r in quality.quality_rules(docs(spark, texts)).collect()}
    assert (got[0]["q_n_dup_lines"], got[0]["q_n_dup_words"], got[0]["q_kept"]) == (3, 6, True)
    assert (got[1]["q_n_dup_lines"], got[1]["q_n_dup_words"], got[1]["q_kept"]) == (3, 60, False)
    clash = docs(spark, texts).withColumn("q_kept", F.lit("mine")).withColumn("row", F.lit(7)).withColumn("kept", F.lit(8))
    assert quality.kept_documents(clash).select("doc_id", "q_kept", "row", "kept").collect() == [(0, "mine", 7, 8)]
    assert [r["_q_kept"] for r in quality.quality_rules(clash).orderBy("doc_id").collect()] == [True, False]


def test_suffix_dedup(spark):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    part = text(400)
    texts = [None, "", "short", "z" * 700, text(500), text(100) + part, part[:230] + text(90), "q" + part[150:] + text(3), part, part]
    got = {r["doc_id"]: r for r in suffixes.suffix_dedup(docs(spark, texts)).collect()}
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    for d, b in enumerate(raw):
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert (got[d]["n_bytes"], got[d]["n_removed"]) == (len(b), sum(gone))
        assert got[d]["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_suffix_hot_split(spark):
    rng = random.Random(3)
    common = "".join(rng.choice("abcd") for _ in range(260))
    texts = [prose(rng, 40) + common + prose(rng, 40) for _ in range(12)]
    own = docs(spark, texts).select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("b"))
    cover = lambda hot: {(r.d, p) for r in suffixes.repeated_spans(own, 200, hot=hot).collect() for p in range(r.s, r.s + r.n)}
    assert cover(2) == cover(2000) != set()


def test_packing_round_trip():
    rng = np.random.default_rng(4)
    for bits in (1, 5, 16, 17, 32):
        ids = rng.integers(0, 2**bits, 1001).astype("<u4")
        assert (tokens.unpack(tokens.pack(ids, bits), bits, len(ids)) == ids).all()


def test_token_files(spark):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    t, at = Tokenizer.from_file(path), 0
    texts = ["It's <|endoftext|> A-b!? naïve", None, "", "x  y\n\tz", "Ünï" * 50, "don't!’s …!", "x  y\n\tz"]
    got = {r["doc_id"]: r for r in tokens.token_round_trip(docs(spark, texts), path).collect()}
    for i, x in enumerate(texts):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        assert (got[i]["start"], got[i]["n_tokens"]) == (at, len(ids))
        assert got[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_token_files_at_the_edges(spark, monkeypatch):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    long = " ".join(f"w{i % 977}" for i in range(90_000))  # ids beyond two blocks
    rows = [(None, "null id"), (None, long), (3, "same id"), (3, "same id"), (3, "other text"), (4, None), (5, "")]
    d = spark.createDataFrame([(i, x, 1, "y") for i, x in rows], "doc_id long, text string, shard int, h string")
    got = tokens.token_round_trip(d, path).collect()
    want = Counter()
    for i, x in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == [None, None, 3, 3, 3, 4, 5]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(by_start, by_start[1:], strict=False))
    assert tokens.token_round_trip(d.limit(0), path).count() == 0
    assert tokens.width(path, 2) == 16 and tokens.width(path, 70_000) == 17


def test_random_access_and_width(tmp_path):
    import pyarrow as pa

    ids = np.random.default_rng(5).integers(0, 70_000, 200_000).astype("<u4")
    lengths = np.array([1, 0, 150_000, 49_999])
    w = tokens.ShardWriter(pa.OSFile(str(tmp_path / "x.tok"), "wb"), 17)
    w.add([1, None], ids[:1], lengths[:2])
    w.add([2, 3], ids[1:], lengths[2:])
    w.close()
    with pa.OSFile(str(tmp_path / "x.tok")) as f:
        r = tokens.ShardReader(f)
        assert r.ids.tolist() == [1, 0, 2, 3] and r.nulls.tolist() == [False, True, False, False]
        for a, b in ((0, 0), (0, 1), (65_535, 65_537), (1, 200_000), (199_999, 200_000)):
            assert (r.tokens(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        tokens.pack(np.array([70_000], "<u4"), 16)


def test_encoder_equals_the_library_on_odd_texts():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    rng = random.Random(12)
    signs = "abÀé'!<|>/w &#1½٣漢\u0301\u200d\xa0\x0b\x1c\x85\t\n  ΣςİA_~`{}@[]^"
    texts = ["", " ", "</w> a</w>b <w", "<|endoftext|>x", "İ ß ǅ", *["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]]
    e = tokens.Encoder(path, most=500)  # the tables are emptied on the way
    want = [x.ids for x in e.load().encode_batch(texts, add_special_tokens=False)]
    got = []
    for k in range(0, len(texts), 100):
        ids, lengths = e.encode(texts[k : k + 100])
        got += [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]
    assert got == want


def test_apportion_and_mix(spark):
    votes, most = np.array([53.0, 24, 23]), np.array([99, 99, 99])
    quotients = sorted(((v / (2 * k + 1), -i) for i, v in enumerate(votes) for k in range(99)), reverse=True)[:11]
    assert mixing.apportion(votes, 11, most).tolist() == [sum(-i == j for _, i in quotients) for j in range(3)]
    rng = random.Random(5)
    d = docs(spark, [None, "", *[prose(rng, rng.randint(1, 400)) for _ in range(150)]], ("a", "b", None))
    rows = mixing.mix(d).collect()
    assert sorted(rows) == sorted(mixing.mix(d).collect())
    taken, goal = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    assert all(abs(taken[s] - g) <= 32 for s, g in goal.items())
    words = Counter()
    for r in mixing.mixed_documents(d).collect():
        words[r["source"]] += len(r["text"].split())
    assert +words == +taken


def test_simhash(spark):
    rng = random.Random(6)
    base = prose(rng, 300)
    texts = [None, "", "one", "One", base, base + " x", *[prose(rng, 50) for _ in range(60)]]
    got = {r["doc_id"]: r for r in simhash.simhash_classes(docs(spark, texts)).collect()}
    fp = {d: r["fp"] & (2**64 - 1) for d, r in got.items()}
    root = {d: d for d in fp}
    for _ in fp:
        for a in fp:
            for b in fp:
                if (fp[a] ^ fp[b]).bit_count() <= 2:
                    root[a] = min(root[a], root[b])
    assert {d: r["component_id"] for d, r in got.items()} == root


def test_trie_walk_equals_all_pairs():
    rng = np.random.default_rng(7)
    some = rng.integers(0, 2**64, 300, np.uint64, endpoint=False)
    some = np.unique(np.r_[some, some[:80] ^ np.uint64(5), some[:40] ^ np.uint64(1 << 63), some[:20] ^ np.uint64(7)])
    want = {(i, j) for i in range(len(some)) for j in range(i + 1, len(some)) if (int(some[i]) ^ int(some[j])).bit_count() <= 2}
    assert {(x, y) for i, j in simhash.walk(some, None, 2) for x, y in zip(i.tolist(), j.tolist(), strict=True)} == want


def brute_top(rows, k=10):
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    cut = lambda x: max(-(2**63), min(2**63 - 1, x))
    want = Counter()
    for n, (q, v) in enumerate(whole):
        if q is not None and q % 100 == 0:
            best = sorted((-cut(sum(x * y for x, y in zip(v, w, strict=False))), i is None, i or 0) for m, (i, w) in enumerate(whole) if m != n)[:k]
            want.update((q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(best))
    return want


def found_top(spark, rows, **how):
    v = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, row int, block int")
    return Counter(tuple(r) for r in topk.top_k(v, F.col("id") % 100 == 0, **how).collect())


def test_top_k(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(40)] + [(900, None), (901, [1.0, float("nan")]), (902, [None, 1.0]), (903, [])]
    rows += [(100, rows[7][1]), (100, rows[100][1]), (5, rows[3][1]), (None, rows[0][1]), (None, [2.0] * 6)]
    assert found_top(spark, rows, block=32, max_edges=3) == found_top(spark, rows) == brute_top(rows)


def test_top_k_at_the_edges(spark):
    assert found_top(spark, []) == Counter()
    # of a repeated id every row is a candidate
    few = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [3.0, 0.0]), (2, [2.0, 0.0])]
    assert found_top(spark, few) == brute_top(few) and found_top(spark, few)[0, 1, 1, 3 * 2**20] == 1
    assert found_top(spark, [(0, [1.0])]) == Counter()
    wide = [(0, [1e15, 1.0]), (1, [1e15, 2.0]), (2, [-1e15, 0.0]), (3, [5.0, 5.0])]
    assert found_top(spark, wide) == brute_top(wide)


def test_line_dedup(spark):
    texts = [f"own {i} words here\n common line of all \n Les. \n\nAnd ornd.\n{'few' if i < 9 else i}" for i in range(12)]
    texts += [None, "", "w" * 200_000, "Les.", "Les."]
    d = docs(spark, texts, tuple(f"s{i}" for i in range(12)))
    for n_hot in (3, 2000):  # few and all lines hot
        got = {r["doc_id"]: r for r in lines.line_dedup(d, n_hot=n_hot).collect()}
        assert got[3]["text"] == "own 3 words here\n\nfew" and got[3]["_n_removed"] == 3
        assert got[12]["text"] is None and got[13]["text"] == "" and got[14]["text"] == "w" * 200_000
        assert got[15]["text"] == got[16]["text"] == ""


def test_line_dedup_at_the_edges(spark):
    # a line on exactly ten sites goes, on nine stays; null sites do not count; columns of any name
    rows = [(1, "ten\nnine" if i < 9 else "ten", f"s{i}" if i < 10 else None, i, i, i, i, i) for i in range(12)] + [(None, "ten", "s0", 0, 0, 0, 0, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, t int, h int, row int, bad int, _n_lines int")
    got = lines.line_dedup(d).collect()
    assert Counter(r["text"] for r in got) == {"nine": 9, "": 4}
    assert sorted((r["t"], r["_n_lines"], r["row"]) for r in got) == sorted((r[3], r[7], r[5]) for r in rows)
    assert sum(r["__n_removed"] for r in got) == 13
    assert lines.line_dedup(d.limit(0)).count() == 0
    # sketch far from the bound and exact counts near it agree with a plain count
    rng = random.Random(13)
    pairs = [(f"line {k}", f"s{rng.randrange(1 + k)}") for k in range(30) for _ in range(60)]
    told = lines.boilerplate(spark.createDataFrame(pairs, "h string, site string"), 10).collect()
    sites = {}
    for h, site in pairs:
        sites.setdefault(h, set()).add(site)
    assert {r["h"]: r["bad"] for r in told} == {h: len(x) >= 10 for h, x in sites.items()}


def test_pieces_best_path():
    m = pieces.Model([("<unk>", 0.0, 2), *[(f"<0x{i:02X}>", 0.0, 6) for i in range(256)],
                      ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("ab", -3.0, 1), ("▁a", -2.2, 1), ("ba", -4.0, 1), ("▁ab", -4.1, 1)])
    score = {m.texts[i]: m.score[i] for i in range(257, len(m.texts))}

    def brute(w):
        best = {0: (0.0, ())}
        for e in range(1, len(w) + 1):
            options = [(best[s][0] + score.get(w[s:e], m.unknown if e == s + 1 else -1e18), -s, best[s][1] + (w[s:e],)) for s in range(e)]
            top = max(options, key=lambda o: (o[0], o[1]))
            best[e] = top[0], top[2]
        return best[len(w)]

    c = pieces.Codec(m)
    for t in ("abab ba", "  a", "bbaabab", "aéb", "a漢 b"):
        ids = c.encode([t])[0]
        words = pieces.WORD.findall("▁" + t.replace(" ", "▁"))
        total = sum(brute(w)[0] for w in words)
        n_unknown = sum(ch not in "ab▁" for w in words for ch in w)
        normal = sum(m.score[i] for i in ids if m.kind[i] == 1)
        assert abs(normal + n_unknown * m.unknown - total) < 1e-9
        assert c.decode(ids) == t


def unigram_file(path, change, target):
    """The public model file with its type set to Unigram and its scores changed."""
    import struct

    def number(v):
        out = b""
        while v > 127:
            out, v = out + bytes([v & 127 | 128]), v >> 7
        return out + bytes([v])

    def field(n, kind, value):
        return number(n << 3 | kind) + (value if kind == 5 else number(value) if kind == 0 else number(len(value)) + value)

    out = b""
    with open(path, "rb") as f:
        data = f.read()
    for n, value in pieces._fields(data):
        if n == 1:
            got = {2: bytes(4), 3: pieces.NORMAL} | dict(pieces._fields(value))
            score, kind = change(got[1].decode(), struct.unpack("<f", got[2])[0], got[3])
            value = field(1, 2, got[1]) + field(2, 5, struct.pack("<f", score)) + field(3, 0, kind)
        elif n == 2:
            value = b"".join(field(k, 0, 1 if k == 3 else v) if isinstance(v, int) else field(k, 5 if len(v) == 4 and k in (10, 11, 15, 36) else 2, v)
                             for k, v in pieces._fields(value) if isinstance(v, int) or k in (1, 2))
        out += field(n, 2, value)
    with open(target, "wb") as f:
        f.write(out)
    return str(target)


def test_pieces_equal_the_library(tmp_path):
    """With the file's score of -1e9 for the marker the library's fast search leaves the best path (its n-best search
    does not); with that score at an ordinary size both agree on every line."""
    public = pytest.importorskip("public_tokenizers")
    from sentencepiece import SentencePieceProcessor

    path = unigram_file(public.path("piece_bpe_32k.model"), lambda p, s, k: (max(s, -40000.0), 4 if p == "▁water" else k), tmp_path / "u.model")
    library, codec = SentencePieceProcessor(model_file=path), pieces.Codec(pieces.Model(pieces.read_pieces(path)), most=300)
    rng = random.Random(14)
    signs = "abcdé the ▁ 漢字🙂\u0301,.!1234\u00a0"
    texts = ["", "the water there", "waters ▁water", "x" * 3000, *["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(600)],
             *[prose(rng, 30) for _ in range(200)]]
    texts = [" ".join(t.replace("\u00a0", " ").split()) for t in texts]  # the file's own normaliser keeps blanks as they are
    assert pieces.Model(pieces.read_pieces(path)).kind.tolist().count(pieces.USER) == 1
    plain = [t for t in texts if "water" not in t]
    for k in range(0, len(plain), 50):
        for t, ids in zip(plain[k : k + 50], codec.encode(plain[k : k + 50]), strict=True):
            assert ids.tolist() == library.encode(t), t
    assert [codec.m.texts[i] for i in codec.encode(["the water"])[0]][-1] == "▁water"


def test_pieces_stage_at_the_edges(spark):
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    rows = [(1, None, 5), (2, "", 5), (3, "a b", 5), (3, "a b", 5), (None, "ß" * 5000, 5), (4, "no" * 100_000, 5)]
    got = pieces.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, ids int"), path).collect()
    assert [(r["doc_id"], r["n_pieces"] == 0, r["decoded"]) for r in got] == [(i, not t, True) for i, t, _ in rows]
    assert got[2]["ids"] == got[3]["ids"]
    assert pieces.encode_documents(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0


def test_url_intervals(spark):
    e = spark.createDataFrame([("l", "b.c", 10, True), ("l", "b.c", 40, False), ("m", "a.b.c/x", 70, True)],
                              "list string, key string, day long, blocks boolean")
    c = spark.createDataFrame([(1, "http://a.b.c/x/1", 9), (2, "http://a.b.c/x/1", 10), (3, "http://A.b.c:80/y", 39),
                               (4, "http://a.b.c/", 40), (5, "https://u@a.b.c/x?q", 80), (6, None, 5), (7, "nonsense", 20)],
                              "id long, url string, day long")
    got = {r["id"]: (r["kept"], r["lists"]) for r in urls.url_filter(c, e).collect()}
    assert got == {1: (True, ""), 2: (False, "l"), 3: (False, "l"), 4: (True, ""), 5: (False, "m"), 6: (True, ""), 7: (True, "")}


def test_url_path_prefixes_and_open_entries(spark):
    entries = [("a", "a.com/x/y", 0, True), ("p", "c.com/p", 0, True), ("o", "o.net", 100, True), ("d", "d.org", 5, True), ("d", "d.org", 5, False),
               ("q", "q.org", 9, False)]
    e = spark.createDataFrame(entries, "list string, key string, day long, blocks boolean")
    long = "http://www.c.com/p/" + "z/" * 40_000
    asked = [("http://a.com/x/y/z", 3, "a"), ("http://a.com/x", 3, ""), ("http://a.com/x/yy", 3, ""), ("http://a.com//x//y", 3, "a"), ("http://w.a.com/x/y?k", 3, "a"),
             (long, 3, "p"), ("http://x.c.com/p", 3, "p"), ("http://c.com/q", 3, ""), ("http://xc.com/p", 3, ""), ("http://o.net", 99, ""),
             ("http://o.net", 4000, "o"), ("http://o.net", None, ""), ("http://d.org", 5, "d"), ("http://d.org", 5, "d"), ("http://q.org", 20, ""),
             ("", 5, ""), (None, None, "")]
    c = spark.createDataFrame([(i, u, d, "x") for i, (u, d, _) in enumerate(asked)], "id long, url string, day long, month string")
    for n_hot in (2, 2000):
        got = urls.url_filter(c, e, n_hot=n_hot).collect()
        assert {r["id"]: r["lists"] for r in got} == {i: x for i, (_, _, x) in enumerate(asked)} and len(got) == len(asked)
        assert all(r["kept"] == (r["lists"] == "") for r in got)
    assert all(r["kept"] for r in urls.url_filter(c, e.limit(0)).collect())
    assert urls.url_filter(c.limit(0), e).count() == 0


def test_mixed_documents_keep_columns_of_any_name(spark):
    d = spark.createDataFrame([(i, "a b c d " * 40, "en", "s", 320, i, f"r{i}", i) for i in range(6)], DOCS + ", _t int, row string, _spans int")
    got = mixing.mixed_documents(d).collect()
    assert got and all(r["_t"] == r["doc_id"] == r["_spans"] and r["row"] == f"r{r['doc_id']}" for r in got)
    assert mixing.mixed_documents(d.limit(0)).count() == 0

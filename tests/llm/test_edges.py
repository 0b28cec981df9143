"""Odd tables: empty ones, null and repeated ids, repeated rows, very long texts, columns of the operators' own names."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

pytest.importorskip("vitalwatch.llm")
from vitalwatch.llm import licenses, mixing, simhash, suffixes  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, fp long, s int, key int, size int, b binary"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 1, 2, 3, 4, 5, b"6") for i, t, s in rows], DOCS)


def test_suffix_dedup(spark):
    rng = random.Random(21)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    part, long = text(260), text(700_000)  # beyond a piece
    rows = [(1, long + part, "a"), (2, long[300_000:300_900] + text(50), "a"), (None, part + text(20), "a"), (None, text(300), "a"),
            (5, text(250), "a"), (5, text(100) + part, "a"), (6, None, "a"), (7, "", "a"), (8, "x" * 199, "a"), (9, "y" * 200, "a"), (9, "y" * 200, "a")]
    raw = [(t or "").encode() for _, t, _ in rows]
    seen = Counter(hash(b[i:i + 200]) for b in raw for i in range(len(b) - 199))
    want = Counter()
    for (d, _, _), b in zip(rows, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[hash(b[i:i + 200])] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        want[d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    got = suffixes.suffix_dedup(docs(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    assert suffixes.suffix_dedup(docs(spark, [])).count() == 0


def test_mixing(spark):
    text = lambda n: " ".join(f"w{i}" for i in range(n))
    rows = [(1, text(50), "a"), (1, text(50), "a"), (1, text(70), "b"), (None, text(30), None), (None, text(30), None), (2, None, "c"), (3, "", "c"),
            (4, text(20_000), "b")]
    for how in ({}, {"n_shards": 1, "most_shard_words": 1000, "shard_words": 500}):
        got = mixing.mix(docs(spark, rows), **how).collect()
        assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, len((t or "").split()), s) for i, t, s in rows)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
        per, goal = Counter(), {}
        for r in got:
            per[r["source"]] += r["taken"]
            goal[r["source"]] = r["target"]
        assert all(abs(per[s] - g) <= 16 for s, g in goal.items())
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs(spark, rows), **how).collect()))
    assert mixing.mix(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs(spark, rows), max_groups=2)


def test_simhash(spark):
    rng = random.Random(22)
    text = lambda: " ".join("".join(rng.choice("abcdeio") for _ in range(5)) for _ in range(60))
    a, b = text(), text()
    rows = [(3, a, "s"), (3, a, "s"), (3, b, "s"), (None, a, "s"), (None, text(), "s"), (9, b, "s"), (1, None, "s"), (2, "", "s"), (4, a + " " + "z" * 400_000, "s")]
    got = simhash.simhash_classes(docs(spark, rows)).collect()
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    fp = lambda t: simhash.fingerprint(None if t is None else t.lower().encode())
    assert len(got) == len(rows) and by[3, fp(a)] == 3 and by[3, fp(b)] == 3 and by[9, fp(b)] == 3 and by[None, fp(a)] == 3
    assert by[1, 0] == by[2, 0] == 1
    assert [r["component_id"] for r in got if r["doc_id"] is None and r["fp"] != fp(a)] == [None]
    assert simhash.simhash_classes(docs(spark, [])).count() == 0
    assert simhash.one_of_each(docs(spark, [])).count() == 0


def test_heavy_trie_nodes_are_split(spark):
    # fingerprints that share their first bits: the node is cut deeper
    rng = random.Random(23)
    some = sorted({(7 << 58) | rng.getrandbits(20) for _ in range(400)})
    fps = spark.createDataFrame([(x,) for x in some], "fp long")
    found = {frozenset((r["a"], r["b"])) for r in simhash.links(fps, 2, 8, 50).select("a", "b").collect()}
    root = {x: x for x in some}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in found:
        x, y = e
        assert (x ^ y).bit_count() <= 2
        root[max(top(x), top(y))] = min(top(x), top(y))
    for x in some:
        for y in some:
            if (x ^ y).bit_count() <= 2:
                assert top(x) == top(y)


def test_license_scan(spark):
    mit = "Permission is hereby granted under the MIT License."
    notice = next(iter(licenses.TEMPLATES.values()))
    name = next(iter(licenses.TEMPLATES))
    files = [("r/a", notice, False), ("r/a", notice, False), ("r/a", "code", False), (None, notice, False), ("r/b", None, False), ("r/c", "", False),
             ("r/d", "x " * 200_000 + "\n" + notice, False), ("s/LICENSE", None, True), ("", mit, None)]
    got = licenses.license_scan(spark.createDataFrame([(*f, 1, "x") for f in files], "path string, text string, is_file boolean, score int, license string")).collect()
    rows = Counter((r["path"], r["license"], r["origin"]) for r in got)
    assert len(got) == len(files)
    assert rows["r/a", name, "header"] == 3 and rows["r/d", name, "header"] == 1
    assert rows[None, None, "none"] == 1 and rows["r/b", None, "none"] == rows["r/c", None, "none"] == 1

"""The filter audit against a plain walk of every document through every order."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

pytest.importorskip("vitalwatch.llm")
from vitalwatch.llm import audit  # noqa: E402

DOCS = "doc_id long, text string, lang string, fails int, first string, id long"
LABELS = "doc_id long, quality int, toxic int"


def failing(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    return ({"A"} if len(ws) < 100 else set()) | ({"B"} if 100 * len(set(ws)) < 80 * len(ws) else set()) | (
        {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()) | ({"D"} if re.search(r"[#$%&*|]", t) else set())


def brute(rows, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    docs = []
    for d, t, lang in rows:
        copy = d is not None and any(o is not None and o < d and (u or "") == (t or "") for o, u, _ in rows)
        docs.append((lang or "", failing(t) | ({"E"} if copy else set()), d in good, d in toxic))
    out, sums = {}, Counter()
    for part in {p for p, *_ in docs}:
        own = [x for x in docs if x[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, kept = [x for x in left if f in x[1]], [x for x in left if f not in x[1]]
                redundant = sum(f in x[1] for x in own) - len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), redundant, sum(x[1] == {f} for x in own),
                                                  sum(x[2] for x in gone), sum(x[3] for x in gone)]
                sums[part, f] += len(gone)
                left = kept
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    # columns of the operator's own names ride along
    d = spark.createDataFrame([(*r, 9, "x", 1) for r in rows], DOCS)
    got = audit.filter_audit(d, spark.createDataFrame(labels, LABELS)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                         r["toxic_lost"], r["shapley"]) for r in got}
    assert len(found) == len(got)
    return found


def test_every_order_and_step(spark):
    rng = random.Random(11)

    def text():
        n = rng.choice([3, 60, 99, 100, 101, 150])
        ws = [rng.choice(["a", "B", "Ünï", "x#y"]) if rng.random() < rng.choice([0.1, 0.5]) else f"w{rng.randrange(10**6)}" for _ in range(n)]
        return rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t", "  "]).join(ws) + rng.choice(["", "\r\n"])

    texts = [None, "", " \n\t", "A", "long " * 60_000, *[text() for _ in range(40)]]
    rows = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    rows += [(100 + i, rng.choice(texts), rng.choice(["en", "de"])) for i in range(40)]
    rows += [(None, texts[6], "en"), (None, texts[6], "en"), (7, texts[7], "en"), (7, texts[7], "en"), (7, texts[8], "de"), (-5, texts[9], "de")]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 140, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (8, None, None)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_no_documents_and_no_labels(spark):
    assert audited(spark, [], []) == {}
    rows = [(1, "x", None), (2, "x", None)]
    assert audited(spark, rows, []) == brute(rows, [])


def test_path_counts():
    ways, left = audit.path_counts(5)
    assert all(ways[s] == factorial(s.bit_count()) and left[s] == factorial(5 - s.bit_count()) for s in range(32))
    assert len(audit.edges(5)) == 80 and sum(w for s, f, w in audit.edges(5) if f == 2) == 120


def test_other_filters(spark):
    d = spark.createDataFrame([(i, "x", "en") for i in range(3)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], LABELS)
    got = audit.filter_audit(d, labels, filters={"P": F.col("doc_id") > 1}, copy="Q", tallies={"good": F.col("quality") == 1}).collect()
    assert sorted((r["filter_order"], r["step"], r["removed"], r["shapley"]) for r in got) == [
        ("PQ", 1, 1, 1), ("PQ", 2, 1, 3), ("QP", 1, 2, 3), ("QP", 2, 0, 1)]
    with pytest.raises(ValueError):
        audit.filter_audit(d, labels, filters={c: F.lit(True) for c in "ABCDEFG"}, copy="H")

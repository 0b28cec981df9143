"""Filter interaction audit: what every filter removes in every order of the filters.

A document's failing filters are a set. Documents are counted by (part, failing set),
at most 2^n rows a part, and everything else is read from these counts over the lattice
of filter subsets: an edge S -> S + f removes the documents that fail f and nothing in S.
Forward path counts (orders that reach S) times backward path counts (orders that
leave S + f) weight an edge for the Shapley sum; the steps of one order are the edges
of its path.

Nulls: a filter whose condition is null is passed, a null part is the empty string, a
null document id is no copy of anything and has no label. Empty texts are texts: all
empty and null texts are copies of each other. Very long texts are read whole and meet
by a 256-bit hash. Ties and repeated rows: every row counts; rows of one id and one text
are no copies of each other, since neither id is smaller. An id with several label rows
has a label value if one of them has it. An empty table gives no rows. Extra columns
are not read, so clashing names cannot meet.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import stored

SPACE = r"[\x20\x09-\x0D]+"
MOST_FILTERS = 7


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """(ways, left): orders of the filters of S that reach S, and orders of the others that leave it, for every subset S."""
    full = 1 << n
    ways, left = [1] + [0] * (full - 1), [0] * (full - 1) + [1]
    for s in range(1, full):
        ways[s] = sum(ways[s ^ (1 << f)] for f in range(n) if s >> f & 1)
    for s in range(full - 2, -1, -1):
        left[s] = sum(left[s | (1 << f)] for f in range(n) if not s >> f & 1)
    return ways, left


def edges(n: int) -> list[tuple[int, int, int]]:
    """(before, filter, weight): n 2^(n-1) edges, weighted by the orders that run through them."""
    ways, left = path_counts(n)
    return [(s, f, ways[s] * left[s | (1 << f)]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def _steps(spark: SparkSession, letters: list[str]) -> DataFrame:
    """(filter_order, step, before, filter): the edge of every step of every order."""
    rows = []
    for order in permutations(range(len(letters))):
        name, before = "".join(letters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            rows.append((name, step, before, f))
            before |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, before int, filter int")


def text_filters(text: Column, words: int = 100, distinct: int = 80, capitals: int = 10, signs: str = "[#$%&*|]") -> dict[str, Column]:
    """Failure conditions of a text: few words, few distinct words, many capitals, any of the signs."""
    t = F.coalesce(text, F.lit(""))
    # no branch and no higher-order function over the split, so that it is evaluated once;
    # blanks at an end leave an empty string there
    ws = F.split(t, SPACE)
    left, right = F.get(ws, F.lit(0)) == "", (F.element_at(ws, -1) == "") & (F.size(ws) > 1)
    n = F.size(ws) - left.cast("int") - right.cast("int")
    once = F.size(F.array_distinct(ws)) - (left | right).cast("int")
    upper = F.octet_length(t) - F.octet_length(F.regexp_replace(t, "[A-Z]+", ""))
    return {"A": n < words, "B": F.lit(100) * once < F.lit(distinct) * n,
            "C": F.lit(100) * upper > F.lit(capitals) * F.length(t), "D": t.rlike(signs)}


def failing_sets(docs: DataFrame, filters: dict[str, Column], doc_id: str, text: str, part: str,
                 labels: DataFrame, tallies: dict[str, Column]) -> DataFrame:
    """(part, fails, n, tallies...): rows counted by part and failing set.

    The last filter, after those of ``filters``, is the exact copy: a text that a
    smaller id has too. The table is narrowed and counted before every shuffle: by
    (id, text hash, part, failing set), so copies of a row travel as one. The first id
    of a text is found by a partial minimum, and a row passes where (text, id) is
    that first one: the join is by both, so no group of copies meets in one task.
    Rows without an id skip both joins.
    """
    bits = F.lit(0)
    for k, fails in enumerate(filters.values()):
        bits = bits + F.when(fails, F.lit(1 << k)).otherwise(F.lit(0))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("h"), bits.alias("bits"))
    # written once: two branches read it
    rows = stored(rows.groupBy("id", "h", "part", "bits").agg(F.count("*").alias("n")), "audit-rows")
    named, nameless = rows.where("id is not null"), rows.where("id is null")
    first = (named.groupBy("h").agg(F.min("id").alias("id")).withColumn("first", F.lit(True)))
    told = (labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("id"))
            .agg(*[F.max(F.when(c, 1).otherwise(0)).alias(name) for name, c in tallies.items()]))
    copy = F.lit(1 << len(filters))
    seen = (named.join(first, ["h", "id"], "left").join(told, "id", "left")
            .select("part", F.when(F.col("first"), F.col("bits")).otherwise(F.col("bits") + copy).alias("fails"), "n",
                    *[F.coalesce(name, F.lit(0)).alias(name) for name in tallies]))
    rest = nameless.select("part", F.col("bits").alias("fails"), "n", *[F.lit(0).alias(name) for name in tallies])
    return (seen.unionByName(rest).groupBy("part", "fails")
            .agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(name)).alias(name) for name in tallies]))


def lattice(counts: DataFrame, letters: list[str], tallies: list[str]) -> DataFrame:
    """One row per part, order and step from (part, fails, n, tallies...).

    (part, filter_order, step, kept, removed, redundant, unique_fails, lost tallies..., shapley).
    The lattice and the orders are bounded by the number of filters (7: 35,280 steps), so
    both may be broadcast; counts meet each edge as a range of at most 2^n rows a part.
    """
    n = len(letters)
    if n > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters: every order is listed")
    steps = _steps(counts.sparkSession, letters)
    bit = F.expr("shiftleft(1, filter)")
    # every edge that a failing set has to do with: a literal array, so an expansion and no join
    listed = F.array(*[F.struct(F.lit(s).alias("before"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("weight"))
                       for s, f, w in edges(n)])
    x = counts.select("*", F.inline(listed))
    own, before = F.col("fails").bitwiseAND(bit) != 0, F.col("fails").bitwiseAND(F.col("before")) != 0
    total = lambda c, on: F.sum(F.when(on, F.col(c)).otherwise(F.lit(0))).cast("long")
    edge = x.groupBy("part", "before", "filter", "weight").agg(
        total("n", ~before & ~own).alias("kept"), total("n", ~before & own).alias("removed"),
        total("n", before & own).alias("redundant"), total("n", F.col("fails") == bit).alias("unique_fails"),
        *[total(name, ~before & own).alias(f"{name}_lost") for name in tallies])
    shapley = edge.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("weight")).cast("long").alias("shapley"))
    return (edge.join(F.broadcast(steps), ["before", "filter"]).join(shapley, ["part", "filter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                    *[f"{name}_lost" for name in tallies], "shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang",
                 filters: dict[str, Column] | None = None, copy: str = "E", tallies: dict[str, Column] | None = None) -> DataFrame:
    """The audit of ``filters`` (name of one letter to failure condition) and, last, of exact copies."""
    filters = text_filters(F.col(text)) if filters is None else filters
    tallies = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1} if tallies is None else tallies
    counts = failing_sets(docs, filters, doc_id, text, part, labels, tallies)
    return lattice(counts, [*filters, copy], list(tallies))

"""Line dedup: boilerplate lines that spread over many sites go.

A HyperLogLog sketch of sites per line hash merges by aggregation. Lines whose
estimate is clearly past ``min_sites`` are boilerplate; lines near it get an
exact distinct count, and a line on exactly ``min_sites`` sites goes. Every line that is
not blank is judged, however short or long. Lines are compared without white space at
their ends. Null texts stay null, empty ones empty, null sites count as no site, repeated
rows are treated alike, an empty table gives an empty one, and columns of ``docs`` may have
any name.

A line that holds more than 1 / ``n_hot`` of all line rows is hot; there are fewer than
``n_hot`` of them, so their verdicts are broadcast, and only the rows of other lines are
dealt out by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(_bare(line)).alias("a"), F.hash(_bare(line)).alias("b"))


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = 12, band: float = 0.2) -> DataFrame:
    """(h, n_rows, bad) of every line hash, from rows (h, site): bad means on at least ``min_sites`` sites."""
    est = stored(lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("n"), F.count("*").alias("n_rows")),
                 "line-sites")
    # the standard error is 1.04 / sqrt(2^lg_k), 1.6 % at 12: the band is over 12 of them
    unsure = F.col("n").between(min_sites * (1 - band), min_sites * (1 + band))
    # a pair of line and site once for each map task before anything is dealt out by line
    exact = (lines.distinct().join(est.where(unsure).select("h"), "h", "left_semi").groupBy("h").count()
             .where(F.col("count") >= min_sites).select("h", F.lit(True).alias("exact")))
    return (est.join(exact, "h", "left")
            .select("h", "n_rows", F.when(unsure, F.coalesce("exact", F.lit(False))).otherwise(F.col("n") > min_sites).alias("bad")))


def line_dedup(docs: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id",
               min_sites: int = 10, n_hot: int = 2000) -> DataFrame:
    """All columns of ``docs`` with boilerplate lines taken out of ``text``, and n_lines, n_removed
    (as ``_n_lines``, ``_n_removed``, with more underscores where ``docs`` has such columns)."""
    # the row travels as one value, so no column of it can meet a name used here
    t = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("t"), F.col(doc_id).alias("d"), F.xxhash64(text).alias("u"),
                    F.col(site).alias("site"))
    judged = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = t.select("d", "u", "site", F.explode(F.array_distinct(F.transform(judged, _hash))).alias("h"))
    told = stored(boilerplate(rows.where("site is not null").select("h", "site"), min_sites), "lines-judged")
    total = told.agg(F.sum("n_rows")).first()[0] or 0
    # fewer than n_hot lines hold more than 1 / n_hot of the rows each
    hot = F.broadcast(told.where(F.col("n_rows") > max(1, total // n_hot)).select("h", F.col("bad").alias("hot_bad")))
    split_off = rows.select("d", "u", "h").join(hot, "h", "left")
    hits = (split_off.where("hot_bad").select("d", "u", "h")
            .unionByName(split_off.where("hot_bad is null").select("d", "u", "h").join(told.where("bad").select("h"), "h", "left_semi")))
    per = hits.groupBy("d", "u").agg(F.collect_set("h").alias("bad")).select(F.col("d").alias("pd"), F.col("u").alias("pu"), "bad")
    j = t.join(per, F.col("d").eqNullSafe(F.col("pd")) & (F.col("u") == F.col("pu")), "left")
    split = F.split(F.col("t"), "\n")
    # array_contains over at most the document's own lines, all of them judged
    left = F.when(F.col("bad").isNull(), split).otherwise(
        F.filter(split, lambda x: ~F.array_contains("bad", _hash(x))))
    out = j.select("row", split.alias("split"), left.alias("left"))
    n = lambda c: F.greatest(F.size(c), F.lit(0)).cast("long")
    free = "_"
    while {f"{free}n_lines", f"{free}n_removed"} & set(docs.columns):
        free += "_"
    return out.select(*[F.array_join("left", "\n").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns],
                      n(F.col("split")).alias(f"{free}n_lines"), (n(F.col("split")) - n(F.col("left"))).alias(f"{free}n_removed"))

"""URL filters: a temporal join of captures with dated list entries.

An entry (list, key, day, blocks) holds from its day until the next entry of
the same list and key; entries become validity intervals, open ones without an end, cut
at month bounds. An entry's key is a host (it covers the hosts below it) or a host
with a path (it covers the paths that begin with its segments), so a capture's keys are
its host and the host's parents, each alone and with every prefix of the path. Only
keys as deep as the deepest entry are made, so a very long url has few. Captures join on
(key, month) and keep what is active on their day.

A key and month with more than 1 / ``n_hot`` of all rows is hot; there are fewer than
``n_hot`` of them, and their rows meet broadcast entries, the others are dealt out by key.

Null urls match nothing and are kept; an unknown day matches nothing; repeated
entries of a day count as blocking if one of them blocks; repeated captures are
judged one by one; empty lists block nothing; empty captures give no rows; extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

MONTH = 31
MOST_HOT_SPANS = 1_000_000


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def segments(url: Column) -> Column:
    """The path's segments that are not empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")


def keys(url: Column, labels: int, depth: int) -> Column:
    """Parents of the host with 2 to ``labels`` labels, and the host itself if it has so few, each alone and
    with the first 1 to ``depth`` segments of the path."""
    h = host(url)
    parts, path = F.split(h, r"\."), F.slice(segments(url), 1, max(depth, 1))
    n = F.size(parts)
    from_, to = F.greatest(F.lit(1), n - labels + 1), F.greatest(n - 1, F.lit(1))
    up = F.when(from_ > to, F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(from_, F.greatest(from_, to)), lambda i: F.array_join(F.slice(parts, i, F.greatest(n, F.lit(1))), ".")))
    down = F.lit("") if not depth else F.array_join(path, "/")
    tails = F.array(F.lit("")) if not depth else F.concat(F.array(F.lit("")), F.when(down == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(path), F.lit(1))), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(path, 1, i), "/")))))
    every = F.flatten(F.transform(up, lambda x: F.transform(tails, lambda y: F.concat(x, y))))
    return F.when(F.coalesce(h, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, blocks, since, until): until is exclusive, null while open."""
    daily = entries.groupBy("list", "key", "day").agg(F.max("blocks").alias("blocks"))
    w = Window.partitionBy("list", "key").orderBy("day")
    return daily.select("list", "key", "blocks", F.col("day").alias("since"), F.lead("day").over(w).alias("until"))


def url_filter(captures: DataFrame, entries: DataFrame, n_hot: int = 2000) -> DataFrame:
    """captures (id, url, day) with n_hits, lists (sorted) and kept; days are whole numbers."""
    no = F.lit(None).cast("long")
    listed = stored(intervals(entries).where("blocks"), "url-intervals")
    site, path = F.split(F.col("key"), "/", 2)[0], F.regexp_extract("key", "/(.*)", 1)
    labels, depth = listed.agg(F.max(F.size(F.split(site, r"\."))), F.max(F.size(F.filter(F.split(path, "/"), lambda x: x != "")))).first()
    asked = captures.select("url", "day").where("url is not null and day is not null").distinct()
    # distinct (url, day) first: repeated captures cost one row
    rows = asked.select("url", "day", F.floor(F.col("day") / MONTH).alias("month"), F.explode(keys(F.col("url"), labels or 1, depth or 0)).alias("key"))
    per = stored(rows.groupBy("key", "month").agg(F.count("*").alias("n")), "url-keys")
    total, newest = per.agg(F.sum("n"), F.max("month")).first()
    # an open interval reaches to the newest capture
    end = F.coalesce(F.floor((F.col("until") - 1) / MONTH), F.lit(newest if newest is not None else 0).cast("long"))
    spans = (listed.where(F.col("until").isNull() | (F.col("until") > F.col("since")))
             .withColumn("first", F.floor(F.col("since") / MONTH)).withColumn("last", end).where("first <= last")
             .withColumn("month", F.explode(F.sequence("first", "last"))).drop("first", "last"))
    hot = F.broadcast(per.where(F.col("n") > max(1, (total or 0) // n_hot)).select("key", "month"))
    hot_spans = stored(spans.join(hot, ["key", "month"]), "url-hot-spans")
    few = hot_spans.count() <= MOST_HOT_SPANS
    active = "since <= day and (until is null or day < until)"
    matched = (rows.join(hot, ["key", "month"], "left_semi").join(F.broadcast(hot_spans) if few else hot_spans, ["key", "month"])
               .unionByName(rows.join(hot, ["key", "month"], "left_anti").join(spans, ["key", "month"]))).where(active)
    hits = matched.groupBy("url", "day").agg(F.count("*").alias("n_hits"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    known = captures.where("url is not null and day is not null").join(hits, ["url", "day"], "left")
    rest = captures.where("url is null or day is null").withColumn("n_hits", no).withColumn("lists", F.lit(None).cast("string"))
    both = known.select("id", "url", "day", "n_hits", "lists").unionByName(rest.select("id", "url", "day", "n_hits", "lists"))
    return both.select("id", "url", "day", F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
                       F.coalesce("lists", F.lit("")).alias("lists"), F.col("n_hits").isNull().alias("kept"))

"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from . import audit, clusters, licenses, lines, mixing, neighbours, pieces, quality, simhash, suffixes, tokens, topk, urls


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op2_quality_rules(spark, sf_dir):
    q = quality.quality_rules(_docs(spark, sf_dir).select("doc_id", "text"))
    return q.select("doc_id", *[F.col(f"q_{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_dup_words", "n_stop_words")])


def op6_mixing(spark, sf_dir):
    return mixing.mix(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_line_dedup(spark, sf_dir):
    d = lines.line_dedup(_docs(spark, sf_dir).select("doc_id", "source", "text"))
    return d.select("doc_id", "text", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"))


def op4_token_output(spark, sf_dir):
    import public_tokenizers

    return tokens.token_round_trip(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_simhash(spark, sf_dir):
    c = simhash.simhash_classes(_docs(spark, sf_dir))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_pieces(spark, sf_dir):
    import public_tokenizers

    return pieces.encode_documents(_docs(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_top_k(spark, sf_dir):
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0)


def op3_suffix_dedup(spark, sf_dir):
    return suffixes.suffix_dedup(_docs(spark, sf_dir)).drop("kept")


def op5_url_filters(spark, sf_dir):
    """Captures are the pages, fetched on a day made from the id; the lists are made from the pages' urls: hosts,
    the hosts' parents, first path segments and, where there are two, both. Some entries never end."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.select(F.col("page_id").alias("id"), "url", ((F.col("page_id") * 7919) % 365).alias("day"))
    h, path = urls.host(F.col("url")), urls.segments(F.col("url"))
    parent = F.regexp_extract(h, r"^[^.]+\.(.+\..+)$", 1)
    some = pages.select("page_id", F.explode(F.array(
        F.struct(F.lit("host").alias("kind"), h.alias("key")), F.struct(F.lit("parent").alias("kind"), parent.alias("key")),
        F.struct(F.lit("first").alias("kind"), F.when(F.size(path) > 0, F.concat(h, F.lit("/"), F.get(path, F.lit(0)))).alias("key")),
        F.struct(F.lit("second").alias("kind"), F.when((parent != "") & (F.size(path) > 1), F.concat(
            parent, F.lit("/"), F.get(path, F.lit(0)), F.lit("/"), F.get(path, F.lit(1)))).alias("key")))).alias("x")).select("page_id", "x.*")
    found = some.where("key <> '' and key not like '/%'").groupBy("kind", "key").agg(F.min("page_id").alias("p"), F.count("*").alias("n"))
    since = (F.col("p") * 31) % 300
    entry = lambda kind, name, day, blocks: found.where(F.col("kind") == kind).select(
        F.lit(name).alias("list"), "key", day.alias("day"), F.lit(blocks).alias("blocks"))
    entries = (entry("host", "spam", since, True).unionByName(entry("host", "spam", since + 20 + F.col("n") % 40, False))
               .unionByName(entry("host", "phishing", (since + 150) % 300, True))
               .unionByName(entry("host", "phishing", (since + 150) % 300 + 10, False))
               .unionByName(entry("parent", "parked", (since + 70) % 300, True)).unionByName(entry("parent", "parked", (since + 70) % 300 + 5, False))
               .unionByName(entry("first", "section", since, True)).unionByName(entry("first", "section", since + 30, False))
               .unionByName(entry("second", "open", (since + 60) % 350, True)))
    return urls.url_filter(captures, entries).withColumnRenamed("id", "page_id")


def op8_license_scan(spark, sf_dir):
    """Files are the documents, at source/thousand/hundred/id; those of ids ending in 0 are licence files,
    and of them those of ids ending in 00 lie a directory higher."""
    docs = _docs(spark, sf_dir)
    hundred = F.when(F.col("doc_id") % 100 != 0, F.floor(F.col("doc_id") / 100).cast("string"))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"),
                       hundred, F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("no-id-"), F.md5(F.coalesce("text", F.lit(""))))))
    return licenses.license_scan(docs.select(path.alias("path"), "text", F.coalesce(F.col("doc_id") % 10 == 0, F.lit(False)).alias("is_file")))


def op11_centroid_clustering(spark, sf_dir):
    return clusters.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0)


def op13_filter_audit(spark, sf_dir):
    a = audit.filter_audit(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return a.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


QUERIES = {f.__name__: f for f in (op1_pieces, op2_quality_rules, op3_suffix_dedup, op4_token_output, op5_url_filters, op6_mixing,
                                   op7_simhash, op8_license_scan,
                                   op9_top_k, op10_line_dedup, op11_centroid_clustering,
                                   op12_nearest_neighbours, op13_filter_audit)}

_ROWS, _IDF, _OTHER = licenses.weights()
_KNOWN = ", ".join(f"('{n}', '{t}', {w!r}::DOUBLE)" for n, t, w in _ROWS)
_SCALE = ", ".join(f"('{t}', {w!r}::DOUBLE)" for t, w in sorted(_IDF.items()))
_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
ORACLE = {
    "op2_quality_rules": f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w WHERE len(ws) >= 3),
g2 AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS x FROM g),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM g2) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             (len(ws) - len(regexp_extract_all(array_to_string(list_distinct(ls), chr(10)), '[^\\x20\\x09-\\x0D]+')))::BIGINT AS n_dup_words,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words
      FROM w LEFT JOIN r ON w.doc_id = r.doc_id)
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND word_chars BETWEEN 2 * n_words AND 15 * n_words
  AND n_symbols <= 0.1::DOUBLE * n_words AND n_dup_words <= 0.3::DOUBLE * greatest(n_words, 1)
  AND n_stop_words >= 0.02::DOUBLE * n_words AS kept FROM m""",
    "op5_url_filters": r"""
WITH p AS (SELECT page_id, url, (page_id * 7919) % 365 AS day,
       lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)) AS host,
       list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS path FROM pages),
r AS (SELECT *, regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) AS parent FROM p),
k AS (SELECT 'host' AS kind, page_id, host AS key FROM r UNION ALL SELECT 'parent', page_id, parent FROM r
      UNION ALL SELECT 'first', page_id, host || '/' || path[1] FROM r WHERE len(path) > 0
      UNION ALL SELECT 'second', page_id, parent || '/' || path[1] || '/' || path[2] FROM r WHERE parent <> '' AND len(path) > 1),
h AS (SELECT kind, key, (min(page_id) * 31) % 300 AS d, count(*) AS n FROM k WHERE key <> '' AND key NOT LIKE '/%' GROUP BY kind, key),
e AS (SELECT key, 'spam' AS l, d AS a, d + 20 + n % 40 AS b FROM h WHERE kind = 'host'
      UNION ALL SELECT key, 'phishing', (d + 150) % 300, (d + 150) % 300 + 10 FROM h WHERE kind = 'host'
      UNION ALL SELECT key, 'parked', (d + 70) % 300, (d + 70) % 300 + 5 FROM h WHERE kind = 'parent'
      UNION ALL SELECT key, 'section', d, d + 30 FROM h WHERE kind = 'first'
      UNION ALL SELECT key, 'open', (d + 60) % 350, NULL FROM h WHERE kind = 'second'),
c AS (SELECT DISTINCT page_id, day, host AS whole, concat_ws('/', '', array_to_string(path[1:j], '/')) AS tail, list_slice(labels, i, len(labels)) AS ls
      FROM (SELECT *, string_split(host, '.') AS labels FROM r WHERE host <> ''), range(0, 3) t(j), range(1, 20) u(i)
      WHERE j <= len(path) AND i <= greatest(len(labels) - 1, 1)),
m AS (SELECT DISTINCT page_id, day, array_to_string(ls, '.') || CASE WHEN tail = '/' THEN '' ELSE tail END AS key FROM c),
hit AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT l, ',' ORDER BY l) AS ls FROM m JOIN e USING (key)
        WHERE a <= day AND (b IS NULL OR day < b) GROUP BY page_id)
SELECT p.page_id, url, day, coalesce(n, 0)::BIGINT AS n_hits, coalesce(ls, '') AS lists, n IS NULL AS kept
FROM p LEFT JOIN hit USING (page_id)""",
    "op8_license_scan": f"""
WITH f AS (SELECT concat_ws('/', coalesce(source, 'none'), floor(doc_id / 1000)::BIGINT,
                  CASE WHEN doc_id % 100 <> 0 THEN floor(doc_id / 100)::BIGINT END,
                  coalesce(doc_id::VARCHAR, 'no-id-' || md5(coalesce(text, '')))) AS path,
                  text, coalesce(doc_id % 10 = 0, false) AS is_file FROM documents),
known(license, token, w) AS (VALUES {_KNOWN}),
scale(token, idf) AS (VALUES {_SCALE}),
l AS (SELECT DISTINCT path, x FROM (SELECT path, unnest(string_split(text, chr(10))) AS x FROM f)
      WHERE regexp_matches(x, '{licenses.MARKS}')),
t AS (SELECT path, x, unnest(regexp_extract_all(lower(x), '{licenses.TOKEN}')) AS token FROM l),
b AS (SELECT path, x, token, count(*) * coalesce(any_value(idf), {_OTHER!r}::DOUBLE) AS v
      FROM t LEFT JOIN scale USING (token) GROUP BY path, x, token),
n AS (SELECT path, x, sqrt(sum(v * v)) AS norm FROM b GROUP BY path, x),
s AS (SELECT path, license, round(sum(v * w) / any_value(norm), 6) AS score
      FROM b JOIN known USING (token) JOIN n USING (path, x) GROUP BY path, x, license),
own AS (SELECT * FROM s WHERE score >= 0.75
        QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, license) = 1),
m AS (SELECT f.path, is_file, license, score, regexp_replace(f.path, '/[^/]*$', '') AS leaf FROM f LEFT JOIN own USING (path)),
named AS (SELECT leaf AS dir, min(license) AS dl FROM m WHERE is_file AND license IS NOT NULL GROUP BY leaf),
near AS (SELECT leaf, arg_max(dl, length(dir)) AS dl FROM (SELECT DISTINCT leaf FROM m) JOIN named
         ON leaf = dir OR starts_with(leaf, dir || '/') GROUP BY leaf)
SELECT path, coalesce(license, dl) AS license, score, CASE WHEN license IS NOT NULL THEN 'header'
       WHEN dl IS NOT NULL THEN 'directory' ELSE 'none' END AS origin FROM m LEFT JOIN near USING (leaf)""",
    "op9_top_k": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT r AS own, vec_id AS query_id, v AS w FROM v WHERE vec_id % 100 = 0),
s AS (SELECT own, query_id, vec_id, list_sum(list_transform(range(1, len(v) + 1), lambda i: v[i] * w[i]))::BIGINT AS score
      FROM q JOIN v ON r <> own)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST) AS n FROM s) WHERE n <= 10""",
    "op10_line_dedup": r"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS x FROM documents),
b AS (SELECT doc_id, source, regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k FROM l),
bad AS (SELECT list(k) AS ks FROM (SELECT k FROM b WHERE k <> ''
        GROUP BY k HAVING count(DISTINCT source) >= 10)),
d AS (SELECT doc_id, text, s, unnest(s) AS x, generate_subscripts(s, 1) AS i
      FROM (SELECT doc_id, text, string_split(text, chr(10)) AS s FROM documents)),
k AS (SELECT doc_id, x, i, s, coalesce(list_contains(ks, regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')), false) AS gone
      FROM d, bad)
SELECT doc_id, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
       count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed FROM k GROUP BY doc_id
""",
}


def _rounds(rounds: int = 10, k: int = 8) -> str:
    """The plain loop: every vector against every centroid, round by round."""
    whole = "list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)"
    parts = [f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {whole} AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM v WHERE vec_id IS NOT NULL
  QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT r, c, list_sum(list_transform(range(1, 65), lambda j: (v.v[j] - k.v[j]) * (v.v[j] - k.v[j])))::BIGINT AS d
  FROM v, c{i} k) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT k.c, coalesce(m, k.v) AS v FROM c{i} k LEFT JOIN (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS m FROM (
    SELECT c, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
      SELECT a{i}.c, unnest(range(1, 65)) AS j, unnest(v.v) AS x FROM a{i} JOIN v USING (r)) GROUP BY c, j) GROUP BY c) USING (c))""")
    last = f"a{rounds}"
    return ",\n".join(parts) + f"""
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM {last} a JOIN v USING (r) JOIN c{rounds} k ON k.c = a.c"""


def _every_order() -> str:
    """Every document of every order, step by step, from the failing sets as counted rows."""
    rows = ", ".join(f"('{''.join(o)}')" for o in permutations("ABCDE"))
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM t LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
s AS (SELECT o, i, o[i] AS x, left(o, i - 1) AS before FROM (VALUES {rows}) v(o), range(1, 6) r(i)),
m AS (SELECT part, o, i, x, n, good, toxic, contains(fails, x) AS own, fails = x AS alone,
             translate(fails, before, '') <> fails AS gone FROM g, s),
c AS (SELECT part, o, i, x, sum(n) FILTER (NOT gone AND NOT own) AS kept, sum(n) FILTER (NOT gone AND own) AS removed,
             sum(n) FILTER (gone AND own) AS redundant, sum(n) FILTER (alone) AS unique_fails,
             sum(good) FILTER (NOT gone AND own) AS good_lost, sum(toxic) FILTER (NOT gone AND own) AS toxic_lost FROM m GROUP BY ALL)
SELECT part, o AS filter_order, i::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, x), 0)::BIGINT AS shapley FROM c"""


ORACLE["op11_centroid_clustering"] = _rounds()
ORACLE["op13_filter_audit"] = _every_order()

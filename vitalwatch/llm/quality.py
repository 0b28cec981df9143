"""Quality rules: a threshold table compiled into one projection of built-in functions.

Nulls and empty texts have no words and fail; a value on a bound is kept (but under 50 words
fails); repeated rows are judged one by one; very long texts are measured whole; an empty
table gives an empty result; extra columns pass through ``quality_rules`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
# Common function words of English, French, German, Spanish.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "was", "for", "on", "with",
              "le", "la", "les", "des", "de", "un", "et", "du", "est", "que",
              "der", "die", "und", "das", "von", "mit", "den", "ist", "ein",
              "el", "los", "las", "del", "se", "por", "con", "una", "en")
# (rule, numerator, denominator or None, least, most): a text is kept if every ratio is in bounds
RULES = (
    ("length", "n_words", None, 50.0, None),
    ("mean_word", "word_chars", "n_words", 2.0, 15.0),
    ("symbols", "n_symbols", "n_words", None, 0.1),
    # repeated lines by their share of the words: a short boilerplate line that repeats in a text of few lines stays
    ("dup_lines", "n_dup_words", "n_words", None, 0.3),
    ("repeats", "n_repeat_words", "n_words", None, 0.5),
    ("stop_words", "n_stop_words", "n_words", 0.02, None),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_dup_words", "n_stop_words", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more."""
    def covered(starts: Column) -> Column:
        # sorted starts: each covers three words or up to the next start
        return F.when(F.size(starts) == 0, F.lit(0)).otherwise(
            F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at")),
                        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["at"])).alias("n"),
                                              p.alias("at")))["n"])

    def repeated(ws: Column) -> Column:
        n = F.size(ws)
        first = F.lit(0)
        pairs = F.sort_array(F.transform(
            F.sequence(first, n - 3),
            lambda i: F.struct(F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("w"),
                               i.alias("i"))))
        return _let(pairs, lambda s: covered(F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"])),
            lambda x: x["i"]))))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(words, repeated))


def measures(text: Column) -> dict[str, Column]:
    """Column of each measure of the table, all counts as long."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    once = F.filter(F.split(F.array_join(F.array_distinct(lines), "\n"), SPACE), lambda w: w != "")
    bare = F.regexp_replace(t, r"[#*$%&|<>]+", "")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.octet_length(t) - F.octet_length(bare),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_dup_words": F.size(words) - F.size(once),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_repeat_words": _repeat_words(words),
    }
    return {k: v.cast("long") for k, v in counts.items()}


def verdict(measure, rules=RULES) -> Column:
    """True where no rule is broken; ``measure`` maps a measure's name to its column."""
    kept = F.lit(True)
    for _, num, den, least, most in rules:
        value = measure(num).cast("double")
        bound = F.lit(1.0) if den is None else F.greatest(measure(den).cast("double"), F.lit(1.0))
        if least is not None:
            kept = kept & (value >= F.lit(least) * bound)
        if most is not None:
            kept = kept & (value <= F.lit(most) * bound)
    return kept


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """(row, measures): the row travels as one value, and one projection shares the split among all measures."""
    return docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(k) for k, c in measures(F.col(text)).items()])


def _base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def quality_rules(docs: DataFrame, text: str = "text", rules=RULES, prefix: str = "q_") -> DataFrame:
    """All columns of ``docs``, the measures and ``base_failed``, ``kept`` under ``prefix`` (which takes more
    underscores in front until no column of ``docs`` begins with it)."""
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return _measured(docs, text).select(
        "row.*", *[F.col(k).alias(prefix + k) for k in MEASURES], _base_failed().alias(prefix + "base_failed"),
        (~_base_failed() & verdict(F.col, rules)).alias(prefix + "kept"))


def kept_documents(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects; columns may have any name.

    The verdict leaves through a generator: a filter on it is not pushed below the projection, where the text
    would be measured anew for each rule.
    """
    told = F.struct((~_base_failed() & verdict(F.col, rules)).alias("kept"))
    return _measured(docs, text).select("row", F.inline(F.array(told))).where("kept").select("row.*")

"""JSON message to reading, in one pass of built-in expressions.

The text is parsed once into a VARIANT (``try_parse_json``); each field is
then read with ``try_variant_get``, which also takes numbers written as text
("72.5") and ``true`` (1.0) as the deployed parser does. Missing fields give
NULL. Bad messages are not dropped and never fail a task: they get a reason
and go to the quarantine output.

Modes for a metric that is present but not a number (JSON ``null``, other
text, array, object): ``strict`` (default) gives NULL; ``lenient`` gives 0.0
like the deployed parser (which then trips the low range rules).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import METRICS

# ISO-8601 local time with 'T' or a space, optional fraction, no zone.
TS_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?$"

BAD_JSON = "bad_json"
MISSING_KEY = "missing_key"
BAD_TIMESTAMP = "bad_timestamp"


def _field(path: str, typ: str) -> Column:
    return F.expr(f"try_variant_get(_v, '$.{path}', '{typ}')")


def _record(extra: dict[str, str]) -> Column:
    """All fields in one pass over the object: a bad field is NULL on its own."""
    fields = ["device_id string", "timestamp string"] + [f"{m} double" for m in METRICS] + [
        f"{n} {t}" for n, t in extra.items()]
    return F.expr(f"try_variant_get(_v, '$', 'struct<{', '.join(fields)}>')")


def _present() -> Column:
    """Per metric: the key exists (JSON null included); SQL NULL when missing."""
    fields = ", ".join(f"{m} variant" for m in METRICS)
    return F.expr(f"try_variant_get(_v, '$', 'struct<{fields}>')")


def _metric(name: str, mode: str) -> Column:
    got = F.col("_rec")[name]
    if mode == "lenient":
        got = F.when(F.col("_has")[name].isNotNull(), F.coalesce(got, F.lit(0.0)))
    if name == "steps_count":
        return got.try_cast("int")  # truncates like Jackson's asInt(); no overflow error
    return got


def parse_messages(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = (),
                   mode: str = "strict", source_zone: str | None = None,
                   extra_fields: dict[str, str] | None = None, time_text: str | None = None) -> DataFrame:
    """``keep`` columns, ``raw``, device_id, reading_ts, the metrics and ``reason``.

    ``reason`` is NULL for a good reading, else ``bad_json``, ``missing_key``
    or ``bad_timestamp``. ``reading_ts`` is TIMESTAMP_NTZ (the producer writes
    naive local time); with ``source_zone`` it is converted to a UTC TIMESTAMP.
    ``extra_fields`` (name -> SQL type) reads more fields, e.g. an event id.
    ``time_text`` names a column for the time as it was received.
    """
    extra, told = dict(extra_fields or {}), [time_text] if time_text else []
    if mode not in ("strict", "lenient"):
        raise ValueError("mode is 'strict' or 'lenient'")
    text = F.col(value).cast("string")
    v = raw.select(*keep, text.alias("raw"), F.expr(f"try_parse_json(cast(`{value}` AS string))")
                   .alias("_v"))
    v = v.select("*", _record(extra).alias("_rec"),
                 *([_present().alias("_has")] if mode == "lenient" else []))
    # The fields leave through a generator: a later filter on them (say
    # ``reason IS NULL``) cannot be pushed below a Generate, so the text is
    # parsed once per message instead of once per field the filter touches.
    rec = F.struct(F.col("_v").isNull().alias("_bad"),
                   F.col("_rec")["device_id"].alias("device_id"),
                   F.col("_rec")["timestamp"].alias("_ts"),
                   *[_metric(m, mode).alias(m) for m in METRICS],
                   *[F.col("_rec")[n].alias(n) for n in extra])
    out = v.select(*keep, "raw", F.inline(F.array(rec)))
    # try_cast alone would take "2024" as a timestamp: check the shape first
    ts = F.when(F.col("_ts").rlike(TS_SHAPE), F.expr("try_cast(_ts AS timestamp_ntz)"))
    out = out.select(*keep, "raw", "_bad", "device_id", "_ts", ts.alias("reading_ts"), *METRICS,
                     *extra, *[F.col("_ts").alias(c) for c in told])
    if source_zone:
        out = out.withColumn("reading_ts", F.to_utc_timestamp(F.col("reading_ts").cast("timestamp"),
                                                              source_zone))
    reason = (F.when(F.col("_bad"), F.lit(BAD_JSON))
              .when(F.col("device_id").isNull() | F.col("_ts").isNull(), F.lit(MISSING_KEY))
              .when(F.col("reading_ts").isNull(), F.lit(BAD_TIMESTAMP)))
    return out.select(*keep, "raw", "device_id", "reading_ts", *METRICS, *extra, *told,
                      reason.alias("reason"))


def split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good readings without ``raw``/``reason``, quarantine rows)."""
    good = parsed.where(F.col("reason").isNull()).drop("raw", "reason")
    bad = parsed.where(F.col("reason").isNotNull()).select(
        *[c for c in parsed.columns if c not in ("device_id", "reading_ts", *METRICS)])
    return good, bad


def forward(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The ingest bridge: valid JSON re-serialised, keyed by device; bad JSON tagged.

    Columns: ``keep``, ``key`` (device id text or NULL), ``value`` (JSON text
    or NULL), ``reason`` (NULL or ``bad_json``). Valid rows go on to the
    topic, the rest to quarantine; nothing is dropped.
    """
    v = raw.select(*keep, F.col(value).cast("string").alias("_raw"),
                   F.expr(f"try_parse_json(cast(`{value}` AS string))").alias("_v"))
    return v.select(*keep,
                    _field("device_id", "string").alias("key"),
                    F.when(F.col("_v").isNotNull(), F.to_json("_v")).alias("value"),
                    F.when(F.col("_v").isNull(), F.lit(BAD_JSON)).alias("reason"),
                    F.when(F.col("_v").isNull(), F.col("_raw")).alias("raw"))


def to_message(df: DataFrame, ts_text: Column) -> Column:
    """A reading as the producer's JSON text (NULL metrics are left out)."""
    return F.to_json(F.struct(F.col("device_id"), ts_text.alias("timestamp"),
                              *[F.col(m) for m in METRICS if m in df.columns]))

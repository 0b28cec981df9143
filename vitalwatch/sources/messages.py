"""Raw JSON messages derived from ``events``, as the producer would send them.

Every event becomes one message. A deterministic share is damaged, chosen by
the event's own type and its ``props.k`` value, so that every quarantine
reason and every coercion case occurs in the data:

* ``error`` with k < 10: text cut short (bad JSON)
* ``signup`` with k < 10: no ``device_id`` (missing key)
* ``purchase`` with k < 10: timestamp ``"2024"`` (bad timestamp)
* ``click`` with k < 10: heart rate written as text ("72.0")
* ``view`` with k < 10: NULL fields written as JSON ``null``, heart rate null
* ``view`` with 10 <= k < 20: time with a space instead of ``T``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.messages import iso_text
from ..schema import METRICS
from .tables import readings


def _damage(kind: str) -> F.Column:
    k = F.col("_k")
    return (F.col("event_type") == F.lit(kind)) & (k < 10)


def raw_messages(spark: SparkSession, sf_dir: str, damaged: bool = True,
                 with_time: bool = False) -> DataFrame:
    """``event_id, value`` (JSON text), one per event of the whole table.

    ``with_time`` also returns ``reading_ts`` (to cut the messages into files
    by time without a join).
    """
    extra = ["reading_ts"] if with_time else []
    r = readings(spark, sf_dir, extra="event_type, props").withColumn(
        "_k", F.get_json_object("props", "$.k").cast("int"))
    iso = iso_text(F.col("reading_ts"))
    spaced = (F.col("event_type") == "view") & (F.col("_k") >= 10) & (F.col("_k") < 20)
    ts_text = F.when(F.lit(damaged) & spaced, F.regexp_replace(iso, "T", " ")).otherwise(iso)
    # the event id rides along as an extra field (ignored unless asked for)
    metrics = [F.col(m) for m in METRICS] + [F.col("event_id")]
    plain = F.to_json(F.struct(F.col("device_id"), ts_text.alias("timestamp"), *metrics))
    if not damaged:
        return r.select("event_id", plain.alias("value"), *extra)
    no_dev = F.to_json(F.struct(ts_text.alias("timestamp"), *metrics))
    bad_ts = F.to_json(F.struct(F.col("device_id"), F.lit("2024").alias("timestamp"), *metrics))
    as_text = F.to_json(F.struct(F.col("device_id"), ts_text.alias("timestamp"),
                                 *[F.col(m).cast("string").alias(m) if m == "heart_rate"
                                   else F.col(m) for m in METRICS], F.col("event_id")))
    nulls = F.to_json(F.struct(F.col("device_id"), ts_text.alias("timestamp"),
                               *[F.lit(None).cast("double").alias(m) if m == "heart_rate"
                                 else F.col(m) for m in METRICS], F.col("event_id")),
                      {"ignoreNullFields": "false"})
    value = (F.when(_damage("error"), F.expr("substring(_plain, 1, length(_plain) - 1)"))
             .when(_damage("signup"), no_dev)
             .when(_damage("purchase"), bad_ts)
             .when(_damage("click"), as_text)
             .when(_damage("view"), nulls)
             .otherwise(F.col("_plain")))
    return r.withColumn("_plain", plain).select("event_id", value.alias("value"), *extra)


# Arrival of the out-of-order fixture: every reading is under way for up to two hours, one in 97 for eight.
ARRIVAL_SECONDS = "(event_id * 7919) % 7200 + CASE WHEN event_id % 97 = 0 THEN 28800 ELSE 0 END"


def disordered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value, arrival`` of every event: undamaged messages with their arrival as field ``seq`` (microseconds)."""
    r = readings(spark, sf_dir)
    arrival = F.expr(f"timestampadd(SECOND, {ARRIVAL_SECONDS}, reading_ts)")
    seq = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', arrival)")
    text = F.to_json(F.struct("device_id", iso_text(F.col("reading_ts")).alias("timestamp"), *METRICS, "event_id", "seq"))
    return r.withColumn("arrival", arrival).withColumn("seq", seq).select(text.alias("value"), "arrival")

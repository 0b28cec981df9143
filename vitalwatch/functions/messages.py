"""Alert texts as column expressions (built-ins only, no UDF).

``format_string`` is Java's formatter, so ``%.1f`` rounds half up exactly as
the deployed job does (37.25 gives 37.3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..thresholds import (ALERT_BODY_HEAD, ALERT_BODY_TAIL, ALERT_BULLET, ALERT_SUBJECT, DEFAULT,
                          Thresholds)


def rule_message(th: Thresholds = DEFAULT) -> list[Column]:
    out = []
    for r in th.rules:
        args = [F.col(r.metric)] + [F.lit(b) for b in (r.lo, r.hi) if b is not None]
        out.append(F.when(F.col(f"rule_{r.metric}"), F.format_string(r.message, *args)))
    return out


def trend_message(th: Thresholds = DEFAULT) -> list[Column]:
    return [F.when(F.col(f"trend_{t.metric}"),
                   F.format_string(t.message, F.col(t.metric), F.col(f"avg_{t.metric}")))
            for t in th.trends]


def message_list(th: Thresholds = DEFAULT) -> Column:
    """Messages in fixed order: range rules by metric, then trends by metric."""
    arr = F.array(*rule_message(th), *trend_message(th))
    return F.filter(arr, lambda x: x.isNotNull())


def message_codes(th: Thresholds = DEFAULT) -> Column:
    """Comma-joined ids of the rules that fired, same order as :func:`message_list`."""
    parts = ([F.when(F.col(f"rule_{r.metric}"), F.lit(f"rule_{r.metric}")) for r in th.rules]
             + [F.when(F.col(f"trend_{t.metric}"), F.lit(f"trend_{t.metric}")) for t in th.trends])
    return F.concat_ws(",", *parts)


def iso_text(ts: Column, dtype: T.DataType | None = None) -> Column:
    """ISO-8601 with ``T``, fraction only when non-zero (as the producer writes it)."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(frac == F.lit("000000"), whole).otherwise(F.concat(whole, F.lit("."), frac))


def alert_subject(device: Column) -> Column:
    return F.concat(F.lit(ALERT_SUBJECT), device)


def alert_body(ts_text: Column, messages: Column) -> Column:
    head_a, head_b = ALERT_BODY_HEAD.split("{ts}")
    pre, post = ALERT_BULLET.split("{msg}")
    bullets = F.array_join(F.transform(messages, lambda m: F.concat(F.lit(pre), m, F.lit(post))), "")
    return F.concat(F.lit(head_a), ts_text, F.lit(head_b), bullets, F.lit(ALERT_BODY_TAIL))


def alert_rows(detected: DataFrame, th: Thresholds = DEFAULT, ts: str = "reading_ts",
               ts_text: str | None = None, filter_anomalies: bool = True) -> DataFrame:
    """``device_id, reading_ts, subject, body, messages`` for every anomalous reading.

    ``ts_text`` names a column with the reading's original time text, when the
    input still has it; otherwise the time is printed in ISO form. Pass
    ``filter_anomalies=False`` when every input row is an alert already (after
    the cooldown): a filter over the sixteen message expressions makes
    Catalyst's constraint inference very slow.
    """
    text = iso_text(F.col(ts))
    if ts_text and ts_text in detected.columns:
        text = F.coalesce(F.col(ts_text), text)
    msgs = message_list(th)
    src = detected.where(F.col("is_anomaly")) if filter_anomalies else detected
    out = src.select("*", msgs.alias("messages"), text.alias("_ts_text"))
    keep = [c for c in ("event_id",) if c in detected.columns]
    return out.select(*keep, "device_id", F.col(ts).alias("reading_ts"),
                      alert_subject(F.col("device_id")).alias("subject"),
                      alert_body(F.col("_ts_text"), F.col("messages")).alias("body"),
                      "messages")

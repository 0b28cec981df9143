"""Devices' pasts across checkpoints: from a stored table into a new stream, and out of a stopped one.

* :func:`device_past` reads what a stream would know of every device from the stored
  tables (last values of each metric, last alert, newest time); passed to ``flag_stream``
  as ``initial`` it lets a new checkpoint go on where a batch job or another run ended.
* :func:`drain` finishes a stopped stream that processes in event order: the rows that
  still wait in its state come out with their flags, as if a later reading had come.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parse import parse_messages
from ..operators.sizing import micros
from ..thresholds import DEFAULT, Thresholds
from .job import TIME_TEXT, from_step, to_step
from .processor import BUCKET, PACKED, DetectProcessor, Pasts, told

TIES = ("partition", "offset", "event_id")


def device_past(readings: DataFrame, alerts: DataFrame | None = None, th: Thresholds = DEFAULT,
                order: tuple[str, ...] | None = None) -> DataFrame:
    """(device_id, h_<metric>..., last_alert_us, clock_us), one row per device.

    ``order`` is the order in which the rows were processed (default: event time, then the position). Per
    device and metric the last values are taken by a limited rank, whose partial limit goes before the
    shuffle: a map task sends at most ``history`` values of a device and metric, however hot the device.
    """
    order = order or ("reading_ts", *(c for c in TIES if c in readings.columns))
    metrics = [t.metric for t in th.trends]
    long = readings.select("device_id", F.struct(*order).alias("at"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("metric"), F.col(m).cast("double").alias("value")) for i, m in enumerate(metrics)])))
    newest = Window.partitionBy("device_id", "metric").orderBy(F.desc("at"))
    last = (long.where("value is not null").withColumn("n", F.row_number().over(newest))
            .where(F.col("n") <= th.history))
    # at most history values of each metric in a group
    values = lambda i: F.transform(F.sort_array(F.collect_list(
        F.when(F.col("metric") == i, F.struct((-F.col("n")).alias("n"), "value")))), lambda x: x["value"])
    past = last.groupBy("device_id").agg(*[values(i).alias(f"h_{m}") for i, m in enumerate(metrics)])
    clock = readings.groupBy("device_id").agg(F.max(micros(readings, "reading_ts")).alias("clock_us"))
    out = clock.join(past, "device_id", "left")
    if alerts is None:
        out = out.withColumn("last_alert_us", F.lit(None).cast("long"))
    else:
        told = alerts.groupBy("device_id").agg(F.max(micros(alerts, "reading_ts")).alias("last_alert_us"))
        out = out.join(told, "device_id", "left")
    return out.select("device_id", *[F.coalesce(f"h_{m}", F.array().cast("array<double>")).alias(f"h_{m}") for m in metrics],
                      "last_alert_us", "clock_us")


def drain(spark: SparkSession, checkpoint: str, raw: DataFrame, th: Thresholds = DEFAULT, gap_seconds: float | None = None,
          keep: tuple[str, ...] = (), extra_fields: dict[str, str] | None = None, order: tuple[str, ...] = ("reading_ts",),
          mode: str = "strict") -> DataFrame:
    """Flagged rows that wait in the state of the stopped query at ``checkpoint``; the same arguments as its ``flag_stream``.

    ``raw`` gives the columns of the source only. A bucket's waiting rows are bounded by the wait time of its devices.
    """
    parsed = parse_messages(raw, keep=keep, mode=mode, extra_fields=extra_fields, time_text=TIME_TEXT)
    good = parsed.drop("raw", "reason")
    _, arrival, payload = to_step(good, order, th)
    state = lambda name, column: (spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
                                  .select(F.col(f"key.{BUCKET}").alias(BUCKET), column))
    pasts = state("devices", F.col("value.pasts").alias("pasts")).withColumn("rows", F.lit(None).cast("binary"))
    rows = state("waiting", F.col("list_element.rows").alias("rows")).withColumn("pasts", F.lit(None).cast("binary"))
    step = DetectProcessor(arrival, th, gap_seconds)

    def finish(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held = step.waiting_rows([bytes(r) for r in pdf["rows"] if r is not None])
        known = [Pasts.load(bytes(p)) for p in pdf["pasts"] if p is not None]
        pasts = known[0] if known else Pasts(0)
        return told([(device, step.flagged(cols, pasts.get(device, th))) for device, cols in held.items()])

    out = pasts.unionByName(rows).groupBy(BUCKET).applyInPandas(finish, PACKED)
    return from_step(out, payload, good.schema["reading_ts"].dataType, th)

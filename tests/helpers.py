from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from vitalwatch.schema import METRICS

T0 = dt.datetime(2024, 1, 1)

READING_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("device_id", T.StringType()),
     T.StructField("reading_ts", T.TimestampNTZType())]
    + [T.StructField(m, T.IntegerType() if m == "steps_count" else T.DoubleType())
       for m in METRICS])


def make_readings(spark, rows: list[dict]):
    """Rows as dicts with any subset of metrics; event ids and times default to order."""
    data = []
    for i, r in enumerate(rows):
        data.append(tuple(
            [r.get("event_id", i), r.get("device_id", "d1"),
             r.get("reading_ts", T0 + dt.timedelta(seconds=i))]
            + [r.get(m) for m in METRICS]))
    return spark.createDataFrame(data, READING_SCHEMA)


def series(metric: str, values, device="d1", start=0):
    return [{"event_id": start + i, "device_id": device, metric: v,
             "reading_ts": T0 + dt.timedelta(seconds=start + i)} for i, v in enumerate(values)]

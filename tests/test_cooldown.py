from __future__ import annotations

import datetime as dt

from conftest import SF0001
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalwatch.operators.cooldown import cooldown

T0 = dt.datetime(2024, 1, 1)
SCHEMA = T.StructType([T.StructField("device_id", T.StringType()),
                       T.StructField("reading_ts", T.TimestampNTZType()),
                       T.StructField("event_id", T.LongType())])


def _frame(spark, events):
    return spark.createDataFrame(
        [(d, T0 + dt.timedelta(microseconds=us), i) for i, (d, us) in enumerate(events)], SCHEMA)


def _kept(df, **kw):
    return sorted(r["event_id"] for r in cooldown(df, 60, **kw).select("event_id").collect())


def test_hand_made_cooldown_both_paths(spark):
    # anomalies at 0, 60.0, 60.000001, 61, 120.000001, 120.000002 s: kept 0, 60.000001, 120.000002
    us = [0, 60_000_000, 60_000_001, 61_000_000, 120_000_001, 120_000_002]
    df = _frame(spark, [("d", u) for u in us])
    assert _kept(df) == [0, 2, 5]
    assert _kept(df, chunk_rows=1) == [0, 2, 5]  # pointer-doubling path


def test_equal_times_first_tie_alerts(spark):
    df = _frame(spark, [("d", 0), ("d", 0), ("d", 61_000_000)])
    assert _kept(df) == [0, 2]
    assert _kept(df, chunk_rows=1) == [0, 2]


def test_fixture_count(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    a = ev.where("value > 40").select(
        F.concat(F.lit("device_"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("ts").alias("reading_ts"), "event_id")
    assert a.count() == 459
    assert cooldown(a, 7200).count() == 421
    assert cooldown(a, 7200, chunk_rows=3).count() == 421


def _model(events, gap_us):
    last, keep = {}, []
    order = sorted(range(len(events)), key=lambda i: (events[i][0], events[i][1], i))
    for i in order:
        d, u = events[i]
        if d not in last or u - last[d] > gap_us:
            last[d] = u
            keep.append(i)
    return sorted(keep)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.integers(min_value=0, max_value=400_000_000)), min_size=1, max_size=60))
def test_property_both_paths_equal_model(spark, events):
    df = _frame(spark, events)
    want = _model(events, 60_000_000)
    assert _kept(df) == want
    assert _kept(df, chunk_rows=2) == want


def test_without_tie_column(spark):
    us = [0, 60_000_000, 60_000_001, 61_000_000, 120_000_001, 120_000_002]
    df = _frame(spark, [("d", u) for u in us]).drop("event_id")
    for kw in ({}, {"chunk_rows": 1}):
        kept = sorted(r["reading_ts"] for r in cooldown(df, 60, tie="event_id", **kw).collect())
        assert kept == [T0 + dt.timedelta(microseconds=u) for u in (0, 60_000_001, 120_000_002)]

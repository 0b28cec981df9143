from __future__ import annotations

import datetime as dt
import math

import __spark_entry__ as E
from pyspark.sql import functions as F


from vitalwatch.functions.cleaning import clamp_column, hour_band, round_half_even, truncate
from vitalwatch.plans import catalog


def test_clamp_keeps_null_and_bounds(spark):
    df = spark.createDataFrame([(40.0,), (70.0,), (200.0,), (None,), (math.nan,)], "v double")
    got = [r[0] for r in df.select(clamp_column(F.col("v"), 55.0, 105.0)).collect()]
    assert got == [55.0, 70.0, 105.0, None, 105.0]  # NaN ends at the top, as Python's min/max


def test_hour_band_edges(spark):
    hours = [0, 5, 6, 7, 8, 17, 18, 21, 22, 23]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 30),) for h in hours], "t timestamp_ntz")
    got = [r[0] for r in df.select(hour_band(F.col("t"))).collect()]
    assert got == ["sleep", "sleep", "wake", "wake", "active", "active", "evening", "evening",
                   "late", "late"]


def test_half_even_and_truncate(spark):
    df = spark.createDataFrame([(36.25, 7.9), (36.75, -7.9), (0.5, 1e12)], "a double, b double")
    got = df.select(round_half_even(F.col("a"), 1), round_half_even(F.col("a"), 0),
                    truncate(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(36.2, 36.0, 7), (36.8, 37.0, -7), (0.5, 0.0, None)]


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() == 1000
    assert "is_anomaly" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    # every query outside the optional subpackage has an oracle
    own = catalog.spark_queries()
    assert set(own) == set(catalog.oracle_sql())
    assert set(own) <= set(qs)
    assert set(sql) <= set(qs)

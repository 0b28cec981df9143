from __future__ import annotations

import datetime as dt

from conftest import SF0001
from helpers import T0, make_readings, series
from pyspark.sql import functions as F

from vitalwatch.functions.messages import alert_rows, message_list
from vitalwatch.operators.detect import detect
from vitalwatch.plans import dashboard as D
from vitalwatch.sources.tables import readings


def test_rule_and_trend_texts_in_fixed_order(spark):
    rows = series("heart_rate", [70.0] * 9 + [130.0])
    rows[-1]["temperature"] = 37.25
    rows[-1]["stress_level"] = 7.0
    det = detect(make_readings(spark, rows))
    msgs = det.orderBy("event_id").select(message_list().alias("m")).collect()[-1]["m"]
    assert msgs == [
        "Heart rate of 130.0 bpm is outside normal range (50.0-120.0).",
        "Stress level of 7.0 is unusually high (>6.0).",
        "Gradual heart rate increase detected! Current: 130.0 bpm, Average: 76.0 bpm.",
    ]


def test_half_up_formatting(spark):
    # %.1f rounds half up as Java does: 37.25 -> 37.3, 0.05 -> 0.1
    df = spark.createDataFrame([(37.25, 0.05)], "a double, b double")
    got = df.select(F.format_string("%.1f", "a"), F.format_string("%.1f", "b")).first()
    assert tuple(got) == ("37.3", "0.1")


def test_alert_subject_and_body(spark):
    rows = [{"device_id": "device_9", "heart_rate": 130.0,
             "reading_ts": dt.datetime(2024, 1, 2, 3, 4, 5, 600000)}]
    a = alert_rows(detect(make_readings(spark, rows))).first()
    assert a["subject"] == "Urgent Health Alert for device_9"
    assert a["body"] == (
        "Dear User,\n\nWe've detected unusual activity from your health sensors at "
        "2024-01-02T03:04:05.600000.\n\nPlease review the following:\n\n"
        "- Heart rate of 130.0 bpm is outside normal range (50.0-120.0).\n"
        "\nIt's important to pay attention to these changes and consider taking action.\n\n"
        "Your well-being is our priority. This is an automated alert and not medical advice. "
        "Always consult a qualified healthcare professional for any health concerns.")


def test_dashboard_empty_range_shows_na(spark):
    det = detect(readings(spark, SF0001))
    out = D.no_value(det, "2030-01-01 00:00:00", "2030-01-02 00:00:00").collect()
    assert [r["display"] for r in out] == ["N/A"]
    assert D.last_not_null(det, "2030-01-01 00:00:00", "2030-01-02 00:00:00").first()[0] is None


def test_time_filter_is_inclusive_and_pushed(spark):
    r = readings(spark, SF0001)
    first = r.agg(F.min("reading_ts")).first()[0]
    s = D.series(r, "heart_rate", first, first)
    assert s.count() == 1
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_top_recent_limit_order(spark):
    det = detect(readings(spark, SF0001))
    top = D.top_recent(det, "2024-01-01 00:00:00", "2024-02-01 00:00:00").collect()
    assert len(top) == 100
    times = [r["time"] for r in top]
    assert times == sorted(times, reverse=True) and all(r["is_anomaly"] for r in top)
    assert "TakeOrderedAndProject" in D.top_recent(det, "2024-01-01 00:00:00", "2024-02-01 00:00:00")._jdf.queryExecution().executedPlan().toString()


def test_presets_and_bands(spark):
    anchor = dt.datetime(2024, 1, 10, 12, 0)
    assert D.preset_range("5m", anchor) == (anchor - dt.timedelta(minutes=5), anchor)
    assert D.preset_range("2d", anchor) == (anchor - dt.timedelta(days=2), anchor)
    df = spark.createDataFrame([(0,), (1,), (None,)], "v int")
    got = [r[0] for r in df.select(D.band(F.col("v"), 1.0)).collect()]
    assert got == ["green", "red", None]


def test_overlay_is_one_scan(spark):
    r = readings(spark, SF0001)
    o = D.series_overlay(r, "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert o.count() == 8 * r.count()
    assert o._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1

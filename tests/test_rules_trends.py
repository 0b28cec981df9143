from __future__ import annotations

import math

import pytest
from helpers import make_readings, series

from vitalwatch.operators.detect import detect
from vitalwatch.operators.rules import add_rule_flags
from vitalwatch.thresholds import RANGE_RULES


def _flags(df, col):
    return [r[col] for r in df.orderBy("event_id").select(col).collect()]


@pytest.mark.parametrize("rule", RANGE_RULES, ids=lambda r: r.metric)
def test_range_rule_bounds(spark, rule):
    # strict bounds: on the bound is normal; NULL and NaN are never flagged
    cases = []
    if rule.lo is not None:
        cases += [(rule.lo - 0.5, True), (rule.lo, False)]
    cases += [(rule.hi, False), (rule.hi + 0.5, True), (None, False), (math.nan, False)]
    rows = [{rule.metric: v} for v, _ in cases]
    out = add_rule_flags(make_readings(spark, rows))
    assert _flags(out, f"rule_{rule.metric}") == [want for _, want in cases]
    assert _flags(out, "rule_any") == [want for _, want in cases]


def _trend(spark, metric, values):
    return _flags(detect(make_readings(spark, series(metric, values))), f"trend_{metric}")


def test_trend_fires_on_tenth_value(spark):
    # 9 x 70 then 100: the history holds 10 values (mean 73), 100 > 73 * 1.15
    assert _trend(spark, "heart_rate", [70.0] * 9 + [100.0])[-1] is True


def test_trend_silent_with_nine_values(spark):
    assert _trend(spark, "heart_rate", [70.0] * 8 + [100.0])[-1] is False


def test_trend_skips_nulls(spark):
    vals = [70.0, None, 70.0, 70.0, None, 70.0, 70.0, 70.0, None, 70.0, 70.0, 70.0, None, 100.0]
    out = _trend(spark, "heart_rate", vals)
    assert out[-1] is True and not any(out[:-1])


def test_trend_flat_is_silent(spark):
    assert not any(_trend(spark, "heart_rate", [70.0] * 10))


def test_trend_equal_threshold_is_silent_and_step_up_fires(spark):
    # temperature 8 x 39, 38, 40: mean 39.0 and 40 is not > 39 + 1
    assert _trend(spark, "temperature", [39.0] * 8 + [38.0, 40.0])[-1] is False
    assert _trend(spark, "temperature", [39.0] * 8 + [38.0, 40.25])[-1] is True
    # glucose 6 x 67, 3 x 66, 100: mean 70 and 100 is not > 70 + 30
    assert _trend(spark, "blood_glucose", [67.0] * 6 + [66.0] * 3 + [100.0])[-1] is False
    assert _trend(spark, "blood_glucose", [67.0] * 6 + [66.0] * 3 + [101.0])[-1] is True


def test_spo2_trend_is_a_drop(spark):
    assert _trend(spark, "oxygen_saturation", [98.0] * 9 + [90.0])[-1] is True
    assert _trend(spark, "oxygen_saturation", [98.0] * 9 + [100.0])[-1] is False


def test_moving_average_includes_current_value(spark):
    df = detect(make_readings(spark, series("stress_level", [1.0] * 9 + [11.0])))
    last = df.orderBy("event_id").collect()[-1]
    assert last["cnt_stress_level"] == 10 and last["avg_stress_level"] == pytest.approx(2.0)
    assert last["trend_stress_level"] is True  # 11 > 2 + 3


def test_devices_do_not_share_history(spark):
    rows = series("heart_rate", [70.0] * 9, device="a") + series("heart_rate", [100.0], device="b",
                                                                  start=100)
    out = detect(make_readings(spark, rows))
    assert out.where("trend_heart_rate").count() == 0

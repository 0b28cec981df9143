
from __future__ import annotations

import datetime as dt

import pytest

from vitalwatch.functions.parse import forward, parse_messages, split


def _parse(spark, texts, mode="strict"):
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, value string")
    return {r["id"]: r for r in parse_messages(raw, keep=("id",), mode=mode).collect()}


BASE = '"device_id": "d1", "timestamp": "2024-01-01T00:00:00"'


@pytest.mark.parametrize("field,strict,lenient", [
    ('', None, None),                          # missing: NULL in both modes
    ('"heart_rate": null', None, 0.0),         # JSON null: NULL, or 0.0 like the deployed parser
    ('"heart_rate": "72.5"', 72.5, 72.5),      # number as text
    ('"heart_rate": "abc"', None, 0.0),        # other text
    ('"heart_rate": [1, 2]', None, 0.0),       # array
    ('"heart_rate": {"a": 1}', None, 0.0),     # object
    ('"heart_rate": true', 1.0, 1.0),          # boolean
    ('"heart_rate": 72', 72.0, 72.0),
])
def test_metric_coercion(spark, field, strict, lenient):
    text = "{" + BASE + (", " + field if field else "") + "}"
    assert _parse(spark, [text])[0]["heart_rate"] == strict
    assert _parse(spark, [text], "lenient")[0]["heart_rate"] == lenient


def test_steps_truncate_and_ids(spark):
    out = _parse(spark, ['{"device_id": 7, "timestamp": "2024-01-01T00:00:00", "steps_count": 7.9}'])
    assert out[0]["steps_count"] == 7
    assert out[0]["device_id"] == "7"
    assert out[0]["reason"] is None


@pytest.mark.parametrize("text,reason", [
    ('not json', "bad_json"),
    ('{"device_id": "d1", "timestamp": "2024-01-01T00:00:00"', "bad_json"),
    ('{"timestamp": "2024-01-01T00:00:00"}', "missing_key"),
    ('{"device_id": "d1"}', "missing_key"),
    ('{"device_id": null, "timestamp": "2024-01-01T00:00:00"}', "missing_key"),
    ('[1, 2]', "missing_key"),
    ('{"device_id": "d1", "timestamp": "2024"}', "bad_timestamp"),
    ('{"device_id": "d1", "timestamp": "yesterday"}', "bad_timestamp"),
    ('{"device_id": "d1", "timestamp": "2024-13-01T00:00:00"}', "bad_timestamp"),
])
def test_quarantine_reasons(spark, text, reason):
    assert _parse(spark, [text])[0]["reason"] == reason


@pytest.mark.parametrize("ts,want", [
    ("2024-01-02T03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05.123", dt.datetime(2024, 1, 2, 3, 4, 5, 123000)),
    ("2024-01-02 03:04:05.123456", dt.datetime(2024, 1, 2, 3, 4, 5, 123456)),
])
def test_timestamp_shapes(spark, ts, want):
    out = _parse(spark, ['{"device_id": "d", "timestamp": "%s"}' % ts])[0]
    assert out["reason"] is None and out["reading_ts"] == want


def test_split_and_forward_keep_everything(spark):
    texts = ['{' + BASE + ', "heart_rate": 80}', 'oops', '{"timestamp": "2024-01-01T00:00:00"}']
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, value string")
    good, bad = split(parse_messages(raw, keep=("id",)))
    assert [r["id"] for r in good.collect()] == [0]
    assert sorted((r["id"], r["reason"]) for r in bad.collect()) == [(1, "bad_json"),
                                                                     (2, "missing_key")]
    fw = {r["id"]: r for r in forward(raw, keep=("id",)).collect()}
    assert fw[0]["key"] == "d1" and fw[0]["reason"] is None and '"heart_rate":80' in fw[0]["value"]
    assert fw[1]["reason"] == "bad_json" and fw[1]["raw"] == "oops" and fw[1]["value"] is None
    assert fw[2]["key"] is None and fw[2]["reason"] is None  # valid JSON is forwarded as is


def test_parse_runs_once_per_message(spark):
    # the filter on reason must not re-parse the text per referenced field
    raw = spark.createDataFrame([(0, '{' + BASE + '}')], "id long, value string")
    good, _ = split(parse_messages(raw, keep=("id",)))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1

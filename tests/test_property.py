"""Random readings with random gaps: plain windows = chunked windows = model."""

from __future__ import annotations

import datetime as dt

from helpers import T0, make_readings
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from vitalwatch.operators.detect import check_hot, detect

METRICS = ("heart_rate", "temperature", "oxygen_saturation", "stress_level")
value = st.one_of(st.none(), st.sampled_from([0.0, 3.0, 7.0, 36.0, 38.0, 39.5, 40.0, 70.0, 88.0,
                                              95.0, 100.0, 130.0]))
reading = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 3_000), *[value] * len(METRICS))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, min_size=1, max_size=70))
def test_detect_equals_model(spark, rows):
    recs = []
    for i, (dev, sec, *vals) in enumerate(rows):
        r = {"event_id": i, "device_id": dev, "reading_ts": T0 + dt.timedelta(seconds=sec)}
        r.update(dict(zip(METRICS, vals)))
        recs.append(r)
    df = make_readings(spark, recs)
    full = [dict({m: None for m in model.DEFAULT.rule_metrics}, **r) for r in recs]
    want = model.run(sorted(full, key=lambda r: (r["reading_ts"], r["event_id"])))
    for out in (detect(df), detect(df, chunk_rows=4, hot=check_hot(df, 4))):
        got = {r["event_id"]: r for r in out.collect()}
        for eid, w in want.items():
            assert got[eid]["is_anomaly"] == w["is_anomaly"], eid
            for m in METRICS:
                assert got[eid][f"trend_{m}"] == w["trends"][m], (eid, m)

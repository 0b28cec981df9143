"""Spark against the sequential model over every reading of sf0.01."""

from __future__ import annotations

from conftest import SF001
from pyspark.sql import functions as F

import model
from vitalwatch.operators.cooldown import cooldown
from vitalwatch.operators.detect import check_hot, detect
from vitalwatch.sources.tables import readings

GOLDEN = {  # FIXTURES.md section 3: rule / trend counts at sf0.01
    "heart_rate": (429, 1570), "temperature": (22, 516), "systolic_pressure": (226, 1107),
    "diastolic_pressure": (237, 1372), "oxygen_saturation": (241, 996),
    "respiration_rate": (333, 820), "blood_glucose": (855, 1307), "stress_level": (280, 607),
}


def test_detect_matches_model_and_golden_counts(spark):
    r = readings(spark, SF001)
    rows = [x.asDict() for x in r.orderBy("reading_ts", "event_id").collect()]
    want = model.run(rows)
    det = detect(r)
    cols = ["event_id", "is_anomaly"] + [f"rule_{m}" for m in GOLDEN] + [f"trend_{m}" for m in GOLDEN]
    got = {x["event_id"]: x for x in det.select(*cols).collect()}
    assert len(got) == len(want) == 10_000
    for eid, w in want.items():
        g = got[eid]
        assert g["is_anomaly"] == w["is_anomaly"], eid
        for m in GOLDEN:
            assert g[f"rule_{m}"] == w["rules"][m], (eid, m)
            assert g[f"trend_{m}"] == w["trends"][m], (eid, m)
    for m, (nr, nt) in GOLDEN.items():
        assert sum(w["rules"][m] for w in want.values()) == nr
        assert sum(w["trends"][m] for w in want.values()) == nt
    assert sum(w["is_anomaly"] for w in want.values()) == 2290

    # alerts: 60 s cooldown in event time
    anomalies = det.where("is_anomaly").select("device_id", "reading_ts", "event_id")
    alerts = {x["event_id"] for x in cooldown(anomalies, 60).select("event_id").collect()}
    assert alerts == {e for e, w in want.items() if w["alert"]}


def test_chunked_hot_devices_equal_plain(spark):
    # every device over 7 rows is "hot": windows run per time chunk + repair
    r = readings(spark, SF001)
    cols = ["event_id"] + [f"{p}_{m}" for m in GOLDEN for p in ("cnt", "avg", "trend")]
    plain = detect(r).select(*cols)
    hot = check_hot(r, chunk_rows=7)
    assert hot.n_keys == 150
    chunked = detect(r, chunk_rows=7, hot=hot).select(*cols)
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0


def test_sparse_metric_lead_in_spans_several_chunks(spark):
    # a metric present in few rows: its 9-value lead-in reaches back over many chunks
    r = readings(spark, SF001).withColumn(
        "stress_level", F.when(F.col("event_id") % 7 == 0, F.col("stress_level")))
    cols = ["event_id", "cnt_stress_level", "avg_stress_level", "trend_stress_level"]
    plain = detect(r).select(*cols)
    chunked = detect(r, chunk_rows=5).select(*cols)
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0

"""Devices that share a bucket of the stream's state."""

from __future__ import annotations

import json
import os

import pytest
from helpers import T0
from pyspark.sql import functions as F
from test_runs_and_order import at, put, run

import model
from vitalwatch.operators.detect import detect
from vitalwatch.schema import METRICS
from vitalwatch.sinks.parquet import read_table
from vitalwatch.streaming import refresh
from vitalwatch.streaming.handover import device_past, drain
from vitalwatch.streaming.processor import Pasts

NAMES = [f"d{i}" for i in range(20)]


def sent(a, b):
    """Twenty devices, a reading each every 10 s, with jumps and high values in places."""
    return [(100 * s + i, d, 10 * s + i % 3, 70 + 40 * (s % 11 == 10) + 60 * ((s + i) % 9 == 8)) for s in range(a, b) for i, d in enumerate(NAMES)]


def expected(rows):
    import datetime as dt

    got = model.run([{"event_id": i, "device_id": d, "reading_ts": T0 + dt.timedelta(seconds=s), **{m: None for m in METRICS}, "heart_rate": float(b)}
                     for i, d, s, b in sorted(rows, key=lambda r: (r[2], r[0]))])
    return {k: (v["is_anomaly"], v["alert"]) for k, v in got.items()}


def stored(spark, base):
    alerts = {r["event_id"] for r in read_table(spark, f"{base}/alerts").collect()}
    return {r["event_id"]: (r["is_anomaly"], r["event_id"] in alerts) for r in read_table(spark, f"{base}/readings").collect()}


def test_devices_of_a_bucket_share_its_state(spark, scratch):
    rows = sent(0, 30)
    put(f"{scratch}/in", "a.txt", rows[:200])
    put(f"{scratch}/in", "b.txt", [r for r in rows[200:400] if r[1] < "d5"])  # some devices are silent for a batch
    put(f"{scratch}/in", "c.txt", [r for r in rows[200:400] if r[1] >= "d5"] + rows[400:])
    run(spark, f"{scratch}/in", scratch, order=("reading_ts", "event_id"), buckets=3)
    assert stored(spark, scratch) == expected(rows)
    state = spark.read.format("statestore").option("stateVarName", "devices").load(f"{scratch}/ck")
    assert 1 <= state.count() <= 3  # not one for each device
    assert sorted(d for r in state.select("value.pasts").collect() for d in Pasts.load(bytes(r[0]), 3).past) == sorted(NAMES)
    put(f"{scratch}/in", "d.txt", sent(30, 31))
    with pytest.raises(Exception, match="fixed for the life of a checkpoint"):
        run(spark, f"{scratch}/in", scratch, order=("reading_ts", "event_id"), buckets=1)


def test_waiting_rows_and_pasts_of_a_bucket_stay_apart(spark, scratch):
    first, rows = sent(0, 12), sent(12, 30)
    base = detect(spark.createDataFrame([(i, d, at(s), float(b)) for i, d, s, b in first], "event_id long, device_id string, t string, heart_rate double")
                  .select("event_id", "device_id", F.col("t").cast("timestamp_ntz").alias("reading_ts"), "heart_rate",
                          *[F.lit(None).cast("double").alias(m) for m in METRICS if m != "heart_rate"]))
    want = expected(first + rows)
    told = base.where(F.col("event_id").isin([k for k, (_, alert) in want.items() if alert]))
    device_past(base, told).write.parquet(f"{scratch}/past")
    os.makedirs(f"{scratch}/in")
    late = rows[::3] + [r for i, r in enumerate(rows) if i % 3]  # every third reading comes first
    for k, part in enumerate((late[:len(late) // 2], late[len(late) // 2:])):
        with open(f"{scratch}/in/{k}.txt", "w") as f:
            f.writelines(json.dumps({"event_id": i, "device_id": d, "timestamp": at(s), "heart_rate": b, "seq": k}) + "\n" for i, d, s, b in part)
        os.utime(f"{scratch}/in/{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
    how = {"extra_fields": {"event_id": "bigint", "seq": "bigint"}, "order": ("seq", "event_id")}
    src = run(spark, f"{scratch}/in", scratch, wait_seconds=300, buckets=2, initial=spark.read.parquet(f"{scratch}/past"), **how)
    held = drain(spark, f"{scratch}/ck", src, **how)
    got = {r["event_id"]: (r["is_anomaly"], r["alert"]) for r in held.collect()}
    assert len(got) == len(rows) and got == {k: want[k] for k in got}


def test_an_answer_is_merged_in_partitions(spark, scratch, monkeypatch):
    seen = []
    commit = refresh.commits.commit
    monkeypatch.setattr(refresh.commits, "commit", lambda df, *a, **k: seen.append(df) or commit(df, *a, **k))
    rows = spark.createDataFrame([(i, "d", at(i), True) for i in range(5)], "event_id long, device_id string, t string, is_anomaly boolean").select(
        "event_id", "device_id", F.col("t").cast("timestamp_ntz").alias("reading_ts"), *[F.lit(1.0).alias(m) for m in METRICS], "is_anomaly")
    refresh.Refresher(f"{scratch}/answers")(rows, "a", 0)
    assert len(seen) == 3 and all("Coalesce" not in df._jdf.queryExecution().executedPlan().toString() for df in seen)
    days = refresh.answer(spark, f"{scratch}/answers", refresh.DAYS).collect()
    assert [(r["n_readings"], r["n_anomalies"]) for r in days] == [(5, 5)]

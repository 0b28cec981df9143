from __future__ import annotations

import os
import shutil

from conftest import SF0001
from pyspark.sql import functions as F

from vitalwatch.operators.cooldown import cooldown
from vitalwatch.operators.detect import detect
from vitalwatch.sinks import commits
from vitalwatch.sinks.parquet import append_new, compact, overwrite_days, read_table
from vitalwatch.sources.messages import raw_messages
from vitalwatch.sources.tables import readings
from vitalwatch.streaming.job import batch_writer, flag_stream

CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def _write_parts(spark, folder):
    raw = raw_messages(spark, SF0001, damaged=False, with_time=True)
    ts = F.col("reading_ts")
    c = [F.expr(f"TIMESTAMP_NTZ'{x}'") for x in CUTS]
    parts = []
    for i, cond in enumerate([ts < c[0], (ts >= c[0]) & (ts < c[1]), ts >= c[1]]):
        p = os.path.join(folder, f"part{i}")
        raw.where(cond).select("value").coalesce(1).write.text(p)
        parts.append(p)
    return parts


def _run(spark, src_dir, out, dedupe=None):
    src = (spark.readStream.format("text").option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").load(src_dir))
    fl = flag_stream(src, extra_fields={"event_id": "bigint"}, order=("reading_ts", "event_id"),
                     dedupe_delay=dedupe)
    q = (fl.writeStream.foreachBatch(batch_writer(f"{out}/readings", f"{out}/alerts"))
         .option("checkpointLocation", f"{out}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _batch(spark):
    det = detect(readings(spark, SF0001))
    flags = det.select("event_id", "is_anomaly", "trend_any", "rule_any")
    alerts = cooldown(det.where("is_anomaly").select("device_id", "reading_ts", "event_id"), 60)
    return flags, alerts.select("event_id")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch_and_restarts(spark, scratch):
    staged = os.path.join(scratch, "staged")
    parts = _write_parts(spark, staged)
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    shutil.copytree(parts[0], os.path.join(src, "part0"))
    q = _run(spark, src, scratch)  # first run sees one file, then stops
    assert sum(p["numInputRows"] for p in q.recentProgress) > 0
    for i in (1, 2):  # more files arrive; restart from the checkpoint
        shutil.copytree(parts[i], os.path.join(src, f"part{i}"))
    _run(spark, src, scratch)
    got = read_table(spark, f"{scratch}/readings")
    flags, alerts = _batch(spark)
    assert got.count() == 1000 and got.select("event_id").distinct().count() == 1000
    assert _same(got.select(*flags.columns), flags)  # history carried over the restart
    assert _same(read_table(spark, f"{scratch}/alerts").select("event_id"), alerts)


def test_replayed_file_adds_no_rows(spark, scratch):
    staged = os.path.join(scratch, "staged")
    parts = _write_parts(spark, staged)
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for i, p in enumerate(parts):
        shutil.copytree(p, os.path.join(src, f"part{i}"))
    _run(spark, src, scratch, dedupe="30 days")
    shutil.copytree(parts[2], os.path.join(src, "part2-again"))  # the same file, read twice
    _run(spark, src, scratch, dedupe="30 days")
    got = read_table(spark, f"{scratch}/readings")
    assert got.count() == 1000
    flags, _ = _batch(spark)
    assert _same(got.select(*flags.columns), flags)


def test_sink_append_is_idempotent_and_overwrite_replaces_days(spark, scratch):
    det = detect(readings(spark, SF0001)).select("event_id", "device_id", "reading_ts",
                                                 "heart_rate", "is_anomaly")
    path = os.path.join(scratch, "t")
    append_new(det, path)
    append_new(det, path)
    t = spark.read.parquet(path)
    assert t.count() == 1000
    assert "reading_date" in t.columns
    plan = t.where("reading_date = DATE'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_date" in plan
    path2 = os.path.join(scratch, "t2")
    overwrite_days(det, path2)
    overwrite_days(det.where("reading_ts < TIMESTAMP_NTZ'2024-01-03 00:00:00'"), path2)
    assert spark.read.parquet(path2).count() == 1000


def test_forward_bridge_splits_valid_and_bad(spark, scratch):
    from vitalwatch.streaming.job import forward_writer

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "m.txt"), "w") as f:
        f.write('{"device_id": "d1", "timestamp": "2024-01-01T00:00:00", "heart_rate": 80}\n')
        f.write('not json\n')
        f.write('{"device_id": "d2", "timestamp": "2024-01-01T00:00:01"}\n')
    valid_path = os.path.join(scratch, "topic")

    def to_parquet(rows):  # stands in for the Kafka topic
        rows.select("key", "value").write.mode("append").parquet(valid_path)

    stream = spark.readStream.format("text").load(src)
    q = (stream.writeStream.foreachBatch(forward_writer(to_parquet, os.path.join(scratch, "bad")))
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True)
         .start())
    q.awaitTermination()
    topic = sorted((r["key"], r["value"]) for r in spark.read.parquet(valid_path).collect())
    assert [k for k, _ in topic] == ["d1", "d2"] and '"heart_rate":80' in topic[0][1]
    bad = commits.read_table(spark, os.path.join(scratch, "bad")).collect()
    assert [(r["raw"], r["reason"]) for r in bad] == [("not json", "bad_json")]


def test_start_runs_detection_and_quarantine(spark, scratch):
    from vitalwatch.streaming.job import file_source, start

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "m.txt"), "w") as f:
        f.write('{"device_id": "d1", "timestamp": "2024-01-01T00:00:00", "heart_rate": 130}\n')
        f.write('{"device_id": "d1", "timestamp": "2024-01-01T00:00:05", "heart_rate": 70}\n')
        f.write('{"timestamp": "2024-01-01T00:00:06"}\n')
        f.write('garbage\n')
    q1, q2 = start(file_source(spark, src), f"{scratch}/readings", f"{scratch}/alerts",
                   f"{scratch}/quarantine", f"{scratch}/ck", trigger={"availableNow": True})
    q1.awaitTermination()
    q2.awaitTermination()
    got = read_table(spark, f"{scratch}/readings")
    assert sorted(r["is_anomaly"] for r in got.collect()) == [False, True]
    alerts = read_table(spark, f"{scratch}/alerts").collect()
    assert [a["subject"] for a in alerts] == ["Urgent Health Alert for d1"]
    bad = sorted(r["reason"] for r in spark.read.parquet(f"{scratch}/quarantine").collect())
    assert bad == ["bad_json", "missing_key"]


def test_same_time_readings_are_all_stored(spark, scratch):
    det = (detect(readings(spark, SF0001)).select("event_id", "device_id", "reading_ts", "heart_rate", "is_anomaly")
           .withColumn("reading_ts", F.expr("TIMESTAMP_NTZ'2024-01-05 00:00:00'")))
    path = os.path.join(scratch, "same")
    append_new(det, path)
    append_new(det, path)
    assert spark.read.parquet(path).count() == 1000


def test_stream_survives_a_calm_first_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    line = '{"event_id": %d, "device_id": "d", "timestamp": "2024-01-01T00:0%d:00", "heart_rate": %d}\n'
    for i, bpm in enumerate((70, 140)):
        with open(os.path.join(src, f"f{i}.txt"), "w") as f:
            f.write(line % (i, i, bpm))
        _run(spark, src, scratch)
    assert read_table(spark, f"{scratch}/readings").count() == 2
    assert [r["event_id"] for r in read_table(spark, f"{scratch}/alerts").collect()] == [1]

"""Several runs into one table, event order, hand-over, answers, constraints, layout, error counts."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import numpy as np
import pytest
from conftest import SF0001
from helpers import T0, make_readings, series
from pyspark.sql import functions as F

import model
from vitalwatch.operators.detect import detect
from vitalwatch.plans import catalog, dashboard
from vitalwatch.schema import METRICS
from vitalwatch.sinks import commits, constraints, jdbc, layout
from vitalwatch.sinks.parquet import KEY, OWN_COLUMNS, compact, overwrite_days, read_table, write_batch
from vitalwatch.sources.tables import readings
from vitalwatch.streaming import refresh
from vitalwatch.streaming.accounting import ErrorAccounting
from vitalwatch.streaming.handover import device_past, drain
from vitalwatch.streaming.job import batch_writer, flag_stream, quarantine_stream
from vitalwatch.streaming.kernel import Past, flag_rows
from vitalwatch.thresholds import DEFAULT

LINE = '{"event_id": %d, "device_id": "%s", "timestamp": "%s", "heart_rate": %s}\n'
FIELDS = {"extra_fields": {"event_id": "bigint"}}


def at(seconds):
    return (T0 + dt.timedelta(seconds=seconds)).isoformat()


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.writelines(LINE % (i, d, at(s), bpm) for i, d, s, bpm in rows)
    n = len(os.listdir(folder))
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def run(spark, folder, base, per_batch=1, writer=None, checkpoint="ck", **how):
    src = spark.readStream.format("text").option("maxFilesPerTrigger", per_batch).load(folder)
    flagged = flag_stream(src, **(FIELDS | how))
    q = (flagged.writeStream.foreachBatch(writer or batch_writer(f"{base}/readings", f"{base}/alerts"))
         .option("checkpointLocation", f"{base}/{checkpoint}").trigger(availableNow=True).start())
    q.awaitTermination()
    return src


def test_commits_of_two_runs_replays_and_compaction(spark, scratch):
    det = detect(readings(spark, SF0001)).select("event_id", *KEY, "heart_rate", "is_anomaly")
    early, late = (det.where(F.col("event_id") % 3 != r) for r in (0, 1))
    path = f"{scratch}/t"
    assert write_batch(early, path, 0, "a") and not write_batch(late, path, 0, "a")  # a replay writes nothing
    assert commits.read_table(spark, path).count() == early.count()
    assert write_batch(late.withColumn("is_anomaly", F.lit(None).cast("boolean")), path, 0, "b")  # another run, the same batch number
    raw = commits.read_table(spark, path, "reading_date")
    assert raw.count() == early.count() + late.count()
    once = read_table(spark, path).drop(*OWN_COLUMNS)
    assert once.count() == det.count()
    # the earliest commit's row stays; a missing flag was stored as false
    want = early.unionByName(late.where("event_id % 3 = 0").withColumn("is_anomaly", F.lit(False)))
    assert once.exceptAll(want.select(once.columns)).isEmpty()
    assert compact(spark, path) > 0 and compact(spark, path) == 0
    stored = commits.read_table(spark, path, "reading_date").drop(*OWN_COLUMNS)
    assert stored.count() == det.count() and stored.exceptAll(once.select(stored.columns)).isEmpty()
    assert commits.vacuum(spark, path, 3600) == 0 and commits.vacuum(spark, path, -1) == 2  # both runs' folders are replaced
    assert commits.read_table(spark, path).count() == det.count()


def test_what_no_entry_names_is_not_read(spark, scratch):
    path = f"{scratch}/t"
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    commits.commit(rows, path, "a", 0, key=("k",))
    rows.write.parquet(f"{path}/data/commit=a-1-lost")  # a commit that never got its entry
    assert commits.read_table(spark, path).collect() == rows.collect()
    more = spark.createDataFrame([(2, "b", 1.5)], "k int, v string, w double")
    commits.commit(more, path, "a", 1, key=("k",))
    assert sorted(map(tuple, commits.read_table(spark, path, key=("k",)).collect())) == [(1, "a", None), (2, "b", 1.5)]
    with pytest.raises(FileNotFoundError):
        commits.read_table(spark, f"{scratch}/none")
    assert commits.read_table(spark, f"{scratch}/none", empty=rows.schema).count() == 0


def test_a_long_manifest_is_folded(spark, scratch, monkeypatch):
    monkeypatch.setattr(commits, "FOLD_EVERY", 3)
    path, opened = f"{scratch}/t", []
    for b in range(8):
        commits.commit(spark.createDataFrame([(b,)], "k int").coalesce(1), path, "a", b, key=("k",))
    read = commits.Folder.read
    monkeypatch.setattr(commits.Folder, "read", lambda self, sub: opened.append(sub) or read(self, sub))
    found = commits.entries(spark, path)
    assert [e.batch for e in found] == list(range(8)) and [e.seq for e in found] == list(range(1, 9))
    assert len(opened) == 3 and opened[0].endswith("folded-000000001.json")  # the folding after six, and two since
    assert sorted(r["k"] for r in commits.read_table(spark, path).collect()) == list(range(8))
    assert not commits.commit(spark.createDataFrame([(0,)], "k int"), path, "a", 0)


def test_flags_do_not_depend_on_batch_bounds(spark, scratch):
    # nine at 70, then 100 at :30 before 300 at :20 arrives: in arrival order both are flagged, however cut
    rows = [(i, "d", i, 70) for i in range(9)] + [(9, "d", 30, 100), (10, "d", 20, 300)]
    got = {}
    for name, per_batch in (("one", 1), ("all", 20)):
        for r in rows:
            put(f"{scratch}/{name}/in", f"{r[0]:03d}.txt", [r])
        run(spark, f"{scratch}/{name}/in", f"{scratch}/{name}", per_batch, order=("event_id",))
        t = read_table(spark, f"{scratch}/{name}/readings")
        got[name] = sorted((r["event_id"], r["is_anomaly"], r["trend_heart_rate"]) for r in t.collect())
    assert got["one"] == got["all"] and got["one"][9][2] and got["one"][10][1]


def test_event_order_with_late_rows_and_drain(spark, scratch):
    sent = [(i, "d", 10 * i, 70) for i in range(12)]
    sent[5], sent[8] = (5, "d", 50, 160), (8, "d", 80, 100)
    order = [0, 2, 1, 3, 6, 4, 5, 9, 7, 8, 11, 10]  # within 30 s of event time
    rows = [sent[i] for i in order] + [(20, "d", 60, 200), (21, "e", 0, 130)]  # 20 comes 50 s behind the clock
    seq = [json.dumps({"event_id": i, "device_id": d, "timestamp": at(s), "heart_rate": b, "seq": n}) + "\n" for n, (i, d, s, b) in enumerate(rows)]
    how = {"extra_fields": {"event_id": "bigint", "seq": "bigint"}, "order": ("seq",)}
    want = model.run([{"event_id": i, "device_id": d, "reading_ts": T0 + dt.timedelta(seconds=s), **{m: None for m in METRICS}, "heart_rate": float(b)}
                      for i, d, s, b in sorted(r for r in rows if r[0] != 20) ])
    for name, per_file in (("small", 2), ("large", 50)):
        os.makedirs(f"{scratch}/{name}/in")
        for k in range(0, len(seq), per_file):
            with open(f"{scratch}/{name}/in/{k:03d}.txt", "w") as f:
                f.writelines(seq[k:k + per_file])
            os.utime(f"{scratch}/{name}/in/{k:03d}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
        base = f"{scratch}/{name}"
        src = run(spark, f"{base}/in", base, wait_seconds=30, **how)
        held = drain(spark, f"{base}/ck", src, **how)
        done = read_table(spark, f"{base}/readings")
        assert 0 < held.count() < len(rows)
        flags = {r["event_id"]: r["is_anomaly"] for r in done.select("event_id", "is_anomaly").unionByName(held.select("event_id", "is_anomaly")).collect()}
        assert flags == {k: v["is_anomaly"] for k, v in want.items()}
        late = commits.read_table(spark, f"{base}/readings_late").collect()
        assert [(r["event_id"], r["reason"]) for r in late] == [(20, "late")] and '"heart_rate":200.0' in late[0]["raw"]


def test_stored_past_goes_on_in_a_new_stream(spark, scratch):
    first = make_readings(spark, series("heart_rate", [70.0, None, *[70.0] * 8, 130.0]))
    det = detect(first)
    past = device_past(det, det.where("is_anomaly")).collect()[0]
    assert past["h_heart_rate"] == [70.0] * 9 + [130.0] and past["h_temperature"] == []
    assert past["last_alert_us"] == past["clock_us"]
    device_past(det, det.where("is_anomaly")).write.parquet(f"{scratch}/past")
    put(f"{scratch}/in", "a.txt", [(100, "d1", 40, 95), (101, "d1", 80, 140), (102, "new", 41, 140)])
    run(spark, f"{scratch}/in", scratch, order=("reading_ts",), initial=spark.read.parquet(f"{scratch}/past"))
    got = {r["event_id"]: (r["trend_heart_rate"], r["is_anomaly"]) for r in read_table(spark, f"{scratch}/readings").collect()}
    assert got == {100: (True, True), 101: (True, True), 102: (False, True)}
    # 100 lies within the cooldown of the stored alert at :10
    assert sorted(r["event_id"] for r in read_table(spark, f"{scratch}/alerts").collect()) == [101, 102]


def test_state_ttl_and_idle_release(spark, scratch):
    put(f"{scratch}/in", "a.txt", [(1, "d", 0, 130), (2, "d", 5, 70)])
    src = spark.readStream.format("text").load(f"{scratch}/in")
    flagged = flag_stream(src, state_ttl_ms=3_600_000, idle_ms=1000, wait_seconds=60, **FIELDS)
    q = (flagged.writeStream.foreachBatch(batch_writer(f"{scratch}/readings", f"{scratch}/alerts"))
         .option("checkpointLocation", f"{scratch}/ck").trigger(processingTime="1 second").start())
    try:
        until = time.time() + 120
        while time.time() < until and (not commits.entries(spark, f"{scratch}/readings") or read_table(spark, f"{scratch}/readings").count() < 2):
            assert q.exception() is None
            time.sleep(1)
    finally:
        q.stop()
    got = {r["event_id"]: r["is_anomaly"] for r in read_table(spark, f"{scratch}/readings").collect()}
    assert got == {1: True, 2: False}  # nothing later came: released by the timer


def test_alert_tells_the_time_as_received(spark, scratch):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.txt", "w") as f:
        f.write('{"event_id": 1, "device_id": "d", "timestamp": "2024-01-01 00:00:00.500", "heart_rate": 130}\n')
    run(spark, f"{scratch}/in", scratch)
    assert "at 2024-01-01 00:00:00.500." in read_table(spark, f"{scratch}/alerts").collect()[0]["body"]


def test_answers_follow_the_batches(spark, scratch):
    det = detect(readings(spark, SF0001)).cache()
    keep = refresh.Refresher(f"{scratch}/answers", limit=7)
    for b in range(3):
        keep(det.where(F.col("event_id") % 3 == b), "a", b)
    keep(det, "a", 2)  # a replayed batch changes nothing
    got = refresh.top_recent(spark, f"{scratch}/answers", limit=7).collect()
    want = dashboard.top_recent(det, "2024-01-01", "2024-02-01", 7).collect()
    assert sorted(got) == sorted(want)
    last = refresh.answer(spark, f"{scratch}/answers", refresh.LAST).first()["is_anomaly"]
    assert int(last) == dashboard.last_not_null(det, "2024-01-01", "2024-02-01").first()[0]
    days = refresh.answer(spark, f"{scratch}/answers", refresh.DAYS)
    assert days.agg(F.sum("n_readings"), F.sum("n_anomalies")).first()[:] == (1000, det.where("is_anomaly").count())
    keep(det, "b", 0)  # a second run of the same readings
    assert sorted(refresh.top_recent(spark, f"{scratch}/answers", limit=7).collect()) == sorted(want)
    with pytest.raises(ValueError):
        refresh.answer(spark, f"{scratch}/answers", refresh.DAYS)
    assert refresh.answer(spark, f"{scratch}/answers", refresh.DAYS, "b").count() == days.count()


def test_constraints_are_counted_in_the_writing_pass(spark, scratch):
    rows = catalog.faulty_rows(spark, SF0001)
    want = {k: v for k, v in constraints.with_broken(rows).groupBy("broken").count().collect()}
    got = constraints.write_checked(rows, f"{scratch}/t", f"{scratch}/bad", "a", 0)
    assert got == {"stored": want.pop(None), **want} and set(want) == set(constraints.constraints())
    assert rows.where("is_anomaly is null").count() > 0
    assert read_table(spark, f"{scratch}/t").where("is_anomaly is null").count() == 0
    assert constraints.write_checked(rows, f"{scratch}/t", f"{scratch}/bad", "a", 0) is None
    assert commits.read_table(spark, f"{scratch}/bad").count() == sum(want.values())
    clean = make_readings(spark, series("heart_rate", [70.0] * 3)).withColumn("is_anomaly", F.lit(False))
    assert constraints.write_checked(clean, f"{scratch}/t2", f"{scratch}/bad2", "a", 0)["stored"] == 3
    assert commits.entries(spark, f"{scratch}/bad2") == []


def test_z_order_lets_lookups_skip_row_groups(spark, scratch):
    import pyarrow.parquet as pq

    det = detect(readings(spark, "/root/testdata/sf0.01")).select("event_id", *KEY, "heart_rate", "is_anomaly")
    path = f"{scratch}/z"
    layout.write_clustered(det, path, 32, options={"parquet.enable.dictionary#device_id": "false"})
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    device, day = "device_42", (np.datetime64("2024-01-10"), np.datetime64("2024-01-11"))
    groups, by_device, by_time, by_both = 0, 0, 0, 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            d, t = (meta.row_group(g).column(names.index(c)).statistics for c in KEY)
            in_d = d.min <= device <= d.max
            in_t = np.datetime64(t.min) <= day[1] and np.datetime64(t.max) >= day[0]
            groups, by_device, by_time, by_both = groups + 1, by_device + in_d, by_time + in_t, by_both + (in_d and in_t)
    assert groups >= 30 and by_device < 0.4 * groups and by_time < 0.4 * groups and by_both < 0.15 * groups
    got = layout.device_history(spark, path, device)
    assert got.count() == det.where(F.col("device_id") == device).count() > 0
    ranged = layout.device_history(spark, path, device, "2024-01-10", "2024-01-11")
    assert "PushedFilters: [IsNotNull(device_id), IsNotNull(reading_ts), EqualTo(device_id,device_42)" in \
        ranged._jdf.queryExecution().executedPlan().toString()
    # a bloom filter on the device only
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(files[0]), spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        blooms = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
    finally:
        reader.close()
    assert blooms["device_id"] > 0 and blooms["reading_ts"] < 0


def test_anchor_comes_from_the_footers(spark, scratch):
    det = detect(readings(spark, SF0001)).select("event_id", *KEY, "is_anomaly")
    overwrite_days(det, f"{scratch}/t")
    newest = dashboard.newest_from_footers(spark, f"{scratch}/t")
    assert newest.first()[0] == det.agg(F.max("reading_ts")).first()[0]
    assert "PushedAggregation: [MAX(reading_us)]" in newest._jdf.queryExecution().executedPlan().toString()
    empty = det.where("event_id < 0")
    assert dashboard.range_preset(empty, "7d").count() == 0


def test_last_flag_reads_one_day(spark, scratch):
    det = detect(readings(spark, SF0001)).select("event_id", *KEY, "is_anomaly")
    overwrite_days(det, f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    for end in ("2024-01-31", "2024-01-20 07:00:00"):
        last = dashboard.newest_flag(t, "2024-01-01", end)
        assert last.first()[0] == dashboard.last_not_null(det, "2024-01-01", end).first()[0]
        assert "(reading_date#" in (plan := last._jdf.queryExecution().executedPlan().toString()) and " = 2024-01-" in plan
    assert dashboard.newest_flag(t, "2030-01-01", "2030-01-02").first()[0] is None
    assert dashboard.no_value(t, "2030-01-01", "2030-01-02").first()[0] == "N/A"
    bare = t.withColumn("is_anomaly", F.when(F.col("reading_date") < F.lit("2024-01-10").cast("date"), F.col("is_anomaly")))
    assert dashboard.newest_flag(bare, "2024-01-01", "2024-01-31").first()[0] == dashboard.last_not_null(bare, "2024-01-01", "2024-01-31").first()[0]


def test_errors_are_counted_per_batch(spark, scratch):
    listener = ErrorAccounting()
    spark.streams.addListener(listener)
    try:
        os.makedirs(f"{scratch}/in")
        for n, lines in enumerate((["x", "y", '{"device_id": "d", "timestamp": "2024-01-01T00:00:00"}'],
                                   ['{"timestamp": "2024-01-01T00:00:00"}', '{"device_id": "d", "timestamp": "2024"}'])):
            with open(f"{scratch}/in/{n}.txt", "w") as f:
                f.write("\n".join(lines) + "\n")
            os.utime(f"{scratch}/in/{n}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
        src = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{scratch}/in")
        q = (quarantine_stream(src).writeStream.format("parquet").option("path", f"{scratch}/bad")
             .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        until = time.time() + 30
        while len(listener.batches) < 2 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    per = [c for _, c in sorted(listener.batches.items())]
    assert per == [{"received": 3, "good": 1, "bad_json": 2, "missing_key": 0, "bad_timestamp": 0},
                   {"received": 2, "good": 0, "bad_json": 0, "missing_key": 1, "bad_timestamp": 1}]
    assert listener.totals()["received"] == 5 and spark.read.parquet(f"{scratch}/bad").count() == 4


def test_step_equals_the_sequential_model_in_any_cut():
    rng = np.random.default_rng(9)
    names, n = [t.metric for t in DEFAULT.trends], 120
    values = {m: np.where(rng.random(n) < 0.3, np.nan, rng.integers(50, 140, n) * 1.0) for m in names}
    ts = np.cumsum(rng.integers(0, 40, n)) * 1_000_000
    rows = [{"event_id": i, "device_id": "d", "reading_ts": T0 + dt.timedelta(microseconds=int(ts[i])),
             **{m: None for m in METRICS}, **{m: None if np.isnan(values[m][i]) else values[m][i] for m in names}} for i in range(n)]
    want = model.run(rows)
    rule = np.array([any(want[i]["rules"].values()) for i in range(n)])
    has = sum((~np.isnan(values[m])).astype(int) << i for i, m in enumerate(names))
    for cuts in ([n], [1] * n, [7, 50, 63]):
        past, at_row = Past.new(DEFAULT), 0
        for size in cuts:
            s = slice(at_row, at_row + size)
            past = Past.load(past.dump(), DEFAULT)
            out = flag_rows({"vw_us": ts[s], "vw_has": has[s], "rule_any": rule[s], **{m: values[m][s] for m in names}}, past, DEFAULT, 60_000_000)
            for k in range(size):
                w = want[at_row + k]
                assert [bool(out["vw_trends"][k] >> i & 1) for i in range(8)] == [w["trends"][m] for m in names]
                assert bool(out["alert"][k]) == w["alert"]
            at_row += size


def test_jdbc_rows_predicates_and_retries(spark):
    df = make_readings(spark, series("heart_rate", [70.0, 130.0])).withColumn("is_anomaly", F.lit(None).cast("boolean"))
    rows = jdbc.to_table_rows(df)
    assert rows.columns == [*jdbc.COLUMNS, "created_at"] and rows.where("is_anomaly").count() == 0
    parts = jdbc.time_predicates(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 6), 3)
    assert parts == ["timestamp >= '2024-01-01 00:00:00.000000' AND timestamp < '2024-01-01 02:00:00.000000'",
                     "timestamp >= '2024-01-01 02:00:00.000000' AND timestamp < '2024-01-01 04:00:00.000000'",
                     "timestamp >= '2024-01-01 04:00:00.000000' AND timestamp <= '2024-01-01 06:00:00.000000'"]
    assert jdbc.time_predicates(T0, T0, 4) == [f"timestamp >= '{T0}.000000' AND timestamp <= '{T0}.000000'"]
    tried = []

    def twice():
        tried.append(1)
        if len(tried) < 3:
            raise OSError("gone")
        return "done"

    assert jdbc.with_retries(twice, 3, wait_seconds=0) == "done" and len(tried) == 3
    with pytest.raises(OSError):
        jdbc.with_retries(lambda: (_ for _ in ()).throw(OSError("gone")), 2, wait_seconds=0)

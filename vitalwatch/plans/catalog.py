"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the whole ``events`` table through the ``readings`` view;
none is restricted to a subset of ids or rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import clamp, hour_band, round_half_even, truncate
from ..functions.messages import alert_rows, message_codes
from ..functions.parse import forward, parse_messages, split
from ..operators.cooldown import cooldown
from ..operators.detect import check_hot, detect
from ..operators.rules import add_rule_flags
from ..session import scratch_dir
from ..sinks import commits, constraints, layout
from ..sinks.parquet import OWN_COLUMNS, append_new, compact, overwrite_days, read_table
from ..sources.messages import disordered_messages, raw_messages
from ..sources.tables import readings, skewed_readings
from ..streaming import refresh
from ..streaming.handover import device_past, drain
from ..streaming.job import batch_writer, flag_stream
from ..thresholds import DEFAULT
from . import dashboard as D
from .oracle import ALL_METRICS, SERIES, oracle_queries

# Dashboard range used by the registered queries: the whole fixture month
# (both ends inclusive, as the dashboard's time filter).
RANGE = ("2024-01-01 00:00:00", "2024-01-31 23:59:59.999999")
PRESET = "7d"

RULE_IDS = {"rule_heart_rate": "heart_rate", "rule_temperature": "temperature",
            "rule_systolic": "systolic_pressure", "rule_diastolic": "diastolic_pressure",
            "rule_spo2": "oxygen_saturation", "rule_respiration": "respiration_rate",
            "rule_glucose": "blood_glucose", "rule_stress": "stress_level"}
TREND_IDS = {k.replace("rule_", "trend_"): v for k, v in RULE_IDS.items()}

Query = Callable[[SparkSession, str], DataFrame]


def _detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(readings(spark, sf_dir))


_tables: dict = {}


def _source(spark: SparkSession, sf_dir: str) -> tuple:
    """The session and the state of the events' files: a result is kept for as long as these are the same."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    return (spark.sparkContext.applicationId, sf_dir, files)


def flagged_path(spark: SparkSession, sf_dir: str) -> str:
    flagged_table(spark, sf_dir)
    return _tables[_source(spark, sf_dir)]


def flagged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table the dashboard reads (the job's sink): built once per session.

    Detection runs once over the whole ``events`` table and is written as
    date-partitioned Parquet; the dashboard queries then read it with
    partition and row-group pruning instead of re-running the windows.
    """
    key = _source(spark, sf_dir)
    if key not in _tables:
        path = scratch_dir(spark, f"flagged-{uuid.uuid4().hex}")
        overwrite_days(_detected(spark, sf_dir).select(
            "event_id", "device_id", "reading_ts", *ALL_METRICS, "is_anomaly"), path)
        _tables[key] = path
    return spark.read.parquet(_tables[key])


def _rule(metric: str) -> Query:
    def q(spark, sf_dir):
        # a rule looks at one row: scan and project, no shuffle
        return add_rule_flags(readings(spark, sf_dir)).select(
            "event_id", "device_id", "reading_ts", metric, f"rule_{metric}")
    return q


def _trend(metric: str) -> Query:
    def q(spark, sf_dir):
        return _detected(spark, sf_dir).select("event_id", "device_id", "reading_ts", metric,
                                               f"cnt_{metric}", f"trend_{metric}")
    return q


def _series(metric: str) -> Query:
    return lambda spark, sf_dir: D.series(flagged_table(spark, sf_dir), metric, *RANGE)


def _cooldown(gap: float) -> Query:
    def q(spark, sf_dir):
        r = readings(spark, sf_dir)
        hot = check_hot(r)  # one check serves both steps
        anomalies = detect(r, hot=hot).where(F.col("is_anomaly")).select(
            "device_id", "reading_ts", "event_id")
        return cooldown(anomalies, gap, hot=hot)
    return q


def alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject, body and messages for every alert that passes the 60 s cooldown.

    The anomalies are stored once; the cooldown walks their device, time and id only, and texts are
    made of the rows that it keeps.
    """
    r = readings(spark, sf_dir)
    hot = check_hot(r)
    path = scratch_dir(spark, f"anomalies-{uuid.uuid4().hex}")
    detect(r, hot=hot).where(F.col("is_anomaly")).write.parquet(path)
    anomalies = spark.read.parquet(path)
    keys = ["device_id", "reading_ts", "event_id"]
    kept = cooldown(anomalies.select(*keys), DEFAULT.cooldown_seconds, hot=hot)
    alerts = anomalies.join(kept, keys, "left_semi")
    return alert_rows(alerts, filter_anomalies=False).withColumn("messages", F.array_join("messages", "\n"))


def range_preset(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = flagged_table(spark, sf_dir)
    anchor = D.newest_from_footers(spark, flagged_path(spark, sf_dir)).first()[0]  # the bounds become pushed literals
    return D.range_preset(t, PRESET, anchor)


def device_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings of the first device (by name), from a copy of the table along a Z curve of device and time."""
    path = scratch_dir(spark, f"clustered-{uuid.uuid4().hex}")
    flagged = flagged_table(spark, sf_dir).drop(*OWN_COLUMNS)
    layout.write_clustered(flagged, path, CLUSTER_FILES)
    first = spark.read.parquet(path).agg(F.min("device_id")).first()[0]
    rows = layout.device_history(spark, path, first) if first is not None else spark.read.parquet(path)
    return rows.select("event_id", "device_id", "reading_ts", *ALL_METRICS, "is_anomaly")


CLUSTER_FILES = 16


def spark_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for qid, m in RULE_IDS.items():
        q[qid] = _rule(m)
    q["rule_any"] = lambda s, d: add_rule_flags(readings(s, d)).select("event_id", "rule_any")
    for qid, m in TREND_IDS.items():
        q[qid] = _trend(m)
    q["trend_any"] = lambda s, d: _detected(s, d).select("event_id", "trend_any")
    q["is_anomaly"] = lambda s, d: _detected(s, d).select(
        "event_id", "device_id", "reading_ts", *ALL_METRICS, "is_anomaly")
    q["win_moving_avg"] = lambda s, d: _detected(s, d).select(
        "event_id", *[f"avg_{t.metric}" for t in DEFAULT.trends])
    q["message_list"] = lambda s, d: _detected(s, d).where(F.col("is_anomaly")).select(
        "event_id", message_codes().alias("codes"))
    q["alert_cooldown"] = _cooldown(DEFAULT.cooldown_seconds)
    q["alert_cooldown_2h"] = _cooldown(7200)
    q["alert_text"] = alert_text
    for m in SERIES:
        q[f"series_{m}"] = _series(m)
    # the dashboard reads the stored flagged table, as the deployed one reads its SQL table
    q["series_overlay"] = lambda s, d: D.series_overlay(flagged_table(s, d), *RANGE)
    q["top_recent"] = lambda s, d: D.top_recent(flagged_table(s, d), *RANGE)
    q["flag_series"] = lambda s, d: D.flag_series(flagged_table(s, d), *RANGE)
    q["last_not_null"] = lambda s, d: D.newest_flag(flagged_table(s, d), *RANGE)
    q["no_value"] = lambda s, d: D.no_value(flagged_table(s, d), *RANGE)
    q["band"] = lambda s, d: D.bands(flagged_table(s, d), *RANGE)
    q["range_preset"] = range_preset
    q["device_history"] = device_history
    q.update(parse_queries())
    q.update(stream_queries())
    q.update(cleaning_queries())
    return q


def cleaning_queries() -> dict[str, Query]:
    from ..sources.tables import table
    q: dict[str, Query] = {}
    q["clamp"] = lambda s, d: clamp(readings(s, d)).select("event_id", *SERIES)
    q["hour_band"] = lambda s, d: readings(s, d).select(
        "event_id", F.hour("reading_ts").alias("hour"), hour_band(F.col("reading_ts")).alias("band"))
    q["round_half_even"] = lambda s, d: readings(s, d).select(
        "event_id", round_half_even(F.col("temperature"), 1).alias("temperature_1"),
        round_half_even(F.col("calories_burned"), 1).alias("calories_1"))
    # the stress level before flooring, truncated as the producer's int() does
    q["truncate"] = lambda s, d: table(s, d, "events").select(
        "event_id", truncate(F.col("value") / F.lit(25.0)).alias("stress_int"))
    return q


def _parsed(spark, sf_dir, mode="strict"):
    return parse_messages(raw_messages(spark, sf_dir), keep=("event_id",), mode=mode)


def parse_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["parse_roundtrip"] = lambda s, d: split(_parsed(s, d))[0]
    q["parse_lenient"] = lambda s, d: split(_parsed(s, d, "lenient"))[0]
    q["quarantine_split"] = lambda s, d: _parsed(s, d).select(
        "event_id", "reason", F.when(F.col("reason").isNotNull(), F.col("raw")).alias("raw"))
    q["prj_timestamp"] = lambda s, d: _parsed(s, d).select("event_id", "reading_ts")
    q["forward_split"] = lambda s, d: forward(raw_messages(s, d), keep=("event_id",)).select(
        "event_id", "key", "reason", "value")
    return q


# The stream replays the whole events table as files cut by time into three
# slices of STREAM_FILES files, so it runs as three micro-batches in event order.
STREAM_FILES = 8
STREAM_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
STREAM_FLAGS = (*(f"rule_{r.metric}" for r in DEFAULT.rules), "rule_any",
                *(f"{p}_{t.metric}" for t in DEFAULT.trends for p in ("cnt", "avg", "trend")), "trend_any", "is_anomaly")
_stream_runs: dict = {}


def _slices(rows: DataFrame, at: str, cuts: tuple[str, ...], folder: str, files: int = STREAM_FILES) -> None:
    """Text files of ``value``, one write per time slice, so that file times follow the slices."""
    bounds = [F.expr(f"TIMESTAMP_NTZ'{c}'") for c in cuts]
    for i in range(len(cuts) + 1):
        low = F.col(at) >= bounds[i - 1] if i else F.lit(True)
        high = F.col(at) < bounds[i] if i < len(cuts) else F.lit(True)
        rows.where(low & high).select("value").repartition(files).write.text(f"{folder}/part{i}")


def _source_files(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    return (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "true").load(folder))


def _run_stream(flagged: DataFrame, checkpoint: str, writer) -> None:
    q = flagged.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


BY_EVENT = {"extra_fields": {"event_id": "bigint"}, "order": ("reading_ts", "event_id")}


def stream_run(spark: SparkSession, sf_dir: str) -> str:
    """Run the streaming job to completion once per session and state of the files; the folder of its tables."""
    key = _source(spark, sf_dir)
    if key in _stream_runs:
        return _stream_runs[key]
    base = scratch_dir(spark, f"stream-{uuid.uuid4().hex}")
    _slices(raw_messages(spark, sf_dir, damaged=False, with_time=True), "reading_ts", STREAM_CUTS, f"{base}/in")
    flagged = flag_stream(_source_files(spark, f"{base}/in", STREAM_FILES), **BY_EVENT)
    _run_stream(flagged, f"{base}/checkpoint", batch_writer(f"{base}/readings", f"{base}/alerts", with_means=True,
                                                            then=refresh.Refresher(f"{base}/answers")))
    _stream_runs[key] = base
    return base


def stream_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{stream_run(spark, sf_dir)}/readings").select(
        "event_id", "device_id", "reading_ts", *ALL_METRICS, *STREAM_FLAGS)


def stream_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{stream_run(spark, sf_dir)}/alerts").select("device_id", "reading_ts", "event_id", "subject", "body")


def refresh_top_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest anomalies as kept up to date over three micro-batches; the readings table is not read."""
    return refresh.top_recent(spark, f"{stream_run(spark, sf_dir)}/answers")


def refresh_last_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.answer(spark, f"{stream_run(spark, sf_dir)}/answers", refresh.LAST).select(F.col("is_anomaly").cast("int").alias("last_flag"))


def refresh_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.answer(spark, f"{stream_run(spark, sf_dir)}/answers", refresh.DAYS).withColumn("day", F.col("day").cast("string"))


def stream_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages by a second query with a checkpoint of its own, into the same table, then compacted."""
    base = stream_run(spark, sf_dir)
    path = scratch_dir(spark, f"two-runs-{uuid.uuid4().hex}")
    for i, files in enumerate((STREAM_FILES, 2 * STREAM_FILES)):  # the second in other batch bounds
        flagged = flag_stream(_source_files(spark, f"{base}/in", files), **BY_EVENT)
        _run_stream(flagged, f"{path}/checkpoint{i}", batch_writer(f"{path}/readings", f"{path}/alerts"))
    compact(spark, f"{path}/readings")
    stored = commits.read_table(spark, f"{path}/readings", "reading_date")  # as it lies there, no reading twice
    return stored.select("event_id", "device_id", "reading_ts", *ALL_METRICS, "is_anomaly")


WAIT_SECONDS = 7200
FILE_ROWS = 250_000
DISORDER_CUTS = tuple(f"2024-01-{d:02d} 00:00:00" for d in range(7, 31, 6))
DISORDER = {"extra_fields": {"event_id": "bigint", "seq": "bigint"}, "order": ("seq", "event_id")}


def disordered_run(spark: SparkSession, sf_dir: str, slices_per_batch: int = 1) -> DataFrame:
    """Messages out of order through a stream that waits for two hours; the rows of its end are drained."""
    base = scratch_dir(spark, f"disorder-{uuid.uuid4().hex}")
    messages = disordered_messages(spark, sf_dir)
    # a slice is written by a task for each file
    files = max(2, -(-messages.count() // ((len(DISORDER_CUTS) + 1) * FILE_ROWS)))
    _slices(messages, "arrival", DISORDER_CUTS, f"{base}/in", files)
    source = _source_files(spark, f"{base}/in", files * slices_per_batch)
    flagged = flag_stream(source, wait_seconds=WAIT_SECONDS, **DISORDER)
    _run_stream(flagged, f"{base}/checkpoint", batch_writer(f"{base}/readings", f"{base}/alerts", late_path=f"{base}/late"))
    flags = ["event_id", "rule_any", "trend_any", "is_anomaly"]
    done = read_table(spark, f"{base}/readings").select(*flags)
    held = drain(spark, f"{base}/checkpoint", source, **DISORDER).select(*flags)
    late = commits.read_table(spark, f"{base}/late", empty=T.StructType.fromDDL("event_id bigint, reason string")).select("event_id", *[F.lit(None).cast("boolean").alias(c) for c in flags[1:]], "reason")
    rows = done.unionByName(held).withColumn("reason", F.lit(None).cast("string")).unionByName(late)
    return rows.select("event_id", *[F.col(c).cast("string").alias(c) for c in flags[1:]], "reason")  # a late row has no flags


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the month as a batch job, the second as a stream that takes over every device's past."""
    base = scratch_dir(spark, f"resumed-{uuid.uuid4().hex}")
    half = F.expr(f"TIMESTAMP_NTZ'{HALF}'")
    before = readings(spark, sf_dir).where(F.col("reading_ts") < half)
    overwrite_days(detect(before), f"{base}/first")
    first = spark.read.parquet(f"{base}/first")
    cooldown(first.where("is_anomaly").select("device_id", "reading_ts", "event_id"), LONG_GAP).write.parquet(f"{base}/first-alerts")
    alerts = spark.read.parquet(f"{base}/first-alerts")
    later = raw_messages(spark, sf_dir, damaged=False, with_time=True).where(F.col("reading_ts") >= half)
    _slices(later, "reading_ts", ("2024-01-23 00:00:00",), f"{base}/in")
    device_past(first, alerts).write.parquet(f"{base}/past")
    flagged = flag_stream(_source_files(spark, f"{base}/in", STREAM_FILES), gap_seconds=LONG_GAP,
                          initial=spark.read.parquet(f"{base}/past"), **BY_EVENT)
    _run_stream(flagged, f"{base}/checkpoint", batch_writer(f"{base}/readings", f"{base}/alerts"))
    told = alerts.select("event_id").unionByName(read_table(spark, f"{base}/alerts").select("event_id")).withColumn("alert", F.lit(True))
    flags = ["event_id", "trend_any", "is_anomaly"]
    return (first.select(*flags).unionByName(read_table(spark, f"{base}/readings").select(*flags))
            .join(told, "event_id", "left").withColumn("alert", F.coalesce("alert", F.lit(False))))


HALF = "2024-01-16 00:00:00"
LONG_GAP = 7200


def faulty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of which some lack a device, a time or a flag, or have too long a device name."""
    r = readings(spark, sf_dir, extra="event_type, props").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    some = lambda kind: (F.col("event_type") == kind) & (F.col("k") < 10)
    flagged = add_rule_flags(r).withColumn("is_anomaly", F.when(~some("view"), F.col("rule_any")))
    return flagged.select("event_id", F.when(some("error"), F.rpad("device_id", 300, "x")).when(~some("signup"), F.col("device_id")).alias("device_id"),
                          F.when(~some("purchase"), F.col("reading_ts")).alias("reading_ts"), *ALL_METRICS, "is_anomaly")


def sink_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored and rejected rows; a missing flag is stored as false."""
    path = scratch_dir(spark, f"constraints-{uuid.uuid4().hex}")
    constraints.write_checked(faulty_rows(spark, sf_dir), f"{path}/rows", f"{path}/rejected", "once", 0)
    stored = read_table(spark, f"{path}/rows").withColumn(constraints.BROKEN, F.lit(None).cast("string"))
    rejected = commits.read_table(spark, f"{path}/rejected", empty=stored.schema)
    columns = ["event_id", "device_id", "reading_ts", "is_anomaly", constraints.BROKEN]
    return stored.select(*columns).unionByName(rejected.select(*columns))


def sink_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the flagged table twice (a replay); the table holds each reading once."""
    path = scratch_dir(spark, f"sink-{uuid.uuid4().hex}")
    flagged = _detected(spark, sf_dir).select("event_id", "device_id", "reading_ts",
                                              *ALL_METRICS, "is_anomaly")
    append_new(flagged, path)
    append_new(flagged, path)
    return spark.read.parquet(path).drop(*OWN_COLUMNS)


# Rows per window task / cooldown group in the skew queries: small enough that
# the hot device (a third of all readings) is split in fixtures of 1,500 readings or more.
HOT_CHUNK_ROWS = 500
HOT_COLUMNS = tuple(f"{p}_{t.metric}" for t in DEFAULT.trends for p in ("cnt", "avg", "trend")) + (
    "trend_any", "is_anomaly")


def is_anomaly_hot_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection when one device holds a third of the rows: it runs in time chunks."""
    r = skewed_readings(spark, sf_dir)
    hot = check_hot(r, HOT_CHUNK_ROWS)
    return detect(r, chunk_rows=HOT_CHUNK_ROWS, hot=hot).select(
        "event_id", "device_id", "reading_ts", *HOT_COLUMNS)


def is_anomaly_time_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one reading of the hot device in 1970: chunks go by rows, not by time."""
    r = skewed_readings(spark, sf_dir)
    first = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    r = r.withColumn("reading_ts", F.when(F.col("event_id") == 300, first).otherwise(F.col("reading_ts")))
    hot = check_hot(r, HOT_CHUNK_ROWS)
    return detect(r, chunk_rows=HOT_CHUNK_ROWS, hot=hot).select(
        "event_id", "device_id", "reading_ts", *HOT_COLUMNS)


def alert_cooldown_hot_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cooldown when one device holds a third of the rows: pointer doubling for it."""
    r = skewed_readings(spark, sf_dir)
    hot = check_hot(r, HOT_CHUNK_ROWS)
    anomalies = detect(r, chunk_rows=HOT_CHUNK_ROWS, hot=hot).where(F.col("is_anomaly")).select(
        "device_id", "reading_ts", "event_id")
    return cooldown(anomalies, DEFAULT.cooldown_seconds, chunk_rows=HOT_CHUNK_ROWS, hot=hot)


def stream_queries() -> dict[str, Query]:
    return {"stream_detect": stream_detect, "stream_cooldown": stream_cooldown,
            "stream_two_runs": stream_two_runs, "stream_out_of_order": disordered_run, "stream_resumed": stream_resumed,
            "refresh_top_recent": refresh_top_recent, "refresh_last_flag": refresh_last_flag, "refresh_per_day": refresh_per_day,
            "sink_constraints": sink_constraints, "sink_idempotent": sink_idempotent, "is_anomaly_hot_device": is_anomaly_hot_device,
            "is_anomaly_time_skew": is_anomaly_time_skew,
            "alert_cooldown_hot_device": alert_cooldown_hot_device}


def oracle_sql() -> dict[str, str]:
    return oracle_queries(*RANGE, RULE_IDS, TREND_IDS)

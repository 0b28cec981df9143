"""The streaming job: raw messages in, flagged readings and alerts out.

    source (Kafka topic, or a folder of JSON-lines files)
      -> parse + quarantine reason          built-ins, no state
      -> range rules                        built-ins, no state
      -> groupBy(bucket of devices).transformWithStateInPandas(DetectProcessor)
         (one exchange on the bucket; history + cooldown of its devices in RocksDB state)
      -> columns of the flags               built-ins, no state
      -> foreachBatch: readings, alerts and late rows, each a committed folder per batch

A second, stateless query from the same source appends the quarantined
messages. Both keep offsets in their checkpoint folders, so a restart goes
on where it stopped (the deployed job's 5 s checkpoint becomes the trigger). A new
checkpoint is a new run: its folders stand beside those of the first
(:mod:`vitalwatch.sinks.commits`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.messages import alert_rows
from ..functions.parse import forward, parse_messages, to_message
from ..operators.rules import add_rule_flags
from ..operators.sizing import micros
from ..sinks.commits import commit, query_run
from ..sinks.constraints import write_checked
from ..sinks.parquet import identity, write_batch
from ..thresholds import DEFAULT, Thresholds
from .accounting import counted
from .processor import BUCKET, BUCKETS, PACKED, DetectProcessor, bucket_of, spread_out, step_schema

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
TIME_TEXT = "ts_text"
LATE = "late"


def kafka_source(spark: SparkSession, servers: str, topic: str = "iot_raw_data",
                 max_offsets_per_trigger: int | None = 5_000_000) -> DataFrame:
    """Topic from the earliest offset; value as text, (partition, offset) as the arrival order.

    ``max_offsets_per_trigger`` bounds a micro-batch, and with it the rows one
    device brings into the stateful step at once (``None``: no bound). The Kafka
    connector jar is not part of this environment, so this source is written but
    not run here; tests use :func:`file_source`.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def file_source(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-lines files, one message per line, oldest files first."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def state_store(spark: SparkSession) -> None:
    """Keyed state needs RocksDB: taken where the session names it, set where it names none."""
    named = spark.conf.get(PROVIDER, None)
    if named is None or named.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)
    spark.streams.active  # noqa: B018  (creates the state store coordinator)


def to_step(good: DataFrame, arrival: tuple[str, ...], th: Thresholds) -> tuple[DataFrame, list[str], T.StructType]:
    """(narrow rows for the stateful step, arrival columns, schema of the payload).

    The rule verdict, the trend metrics and the arrival order travel as columns, all else as one text.
    """
    metrics = [t.metric for t in th.trends]
    ruled = add_rule_flags(good, th)
    rest = [c for c in good.columns if c not in ("device_id", "reading_ts", *metrics)]
    has = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(m).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, m in enumerate(metrics)])
    # a time and its text leave Python as they came: whole microseconds
    carried = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(None).cast("int").alias("_none"))
    by = ["vw_us" if c == "reading_ts" else f"vw_by_{c}" for c in arrival]
    out = ruled.select("device_id", micros(ruled, "reading_ts").alias("vw_us"), F.to_json(carried).alias("vw_payload"), has.alias("vw_has"),
                       "rule_any", *[F.col(m).cast("double").alias(m) for m in metrics],
                       *[F.col(c).alias(b) for c, b in zip(arrival, by, strict=True) if b != "vw_us"])
    return out, by, T.StructType([good.schema[c] for c in rest])


def from_step(out: DataFrame, payload: T.StructType, reading_ts: T.DataType, th: Thresholds) -> DataFrame:
    """The rows of the step (``PACKED``) with all their columns: rules again, counts, means and flags of each trend, ``is_anomaly``."""
    ts = (F.expr("timestampadd(MICROSECOND, vw_us, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
          if isinstance(reading_ts, T.TimestampNTZType) else F.timestamp_micros("vw_us"))
    out = out.mapInArrow(spread_out(th), step_schema(th))
    had = lambda i: F.col("vw_has").bitwiseAND(F.lit(1 << i)) != 0
    wide = out.select("device_id", ts.alias("reading_ts"), F.from_json("vw_payload", payload).alias("_p") if payload.fields else F.lit(None).alias("_p"),
                      *[F.when(had(i), F.col(t.metric)).alias(t.metric) for i, t in enumerate(th.trends)],
                      *[F.col(f"avg_{t.metric}").alias(f"_avg_{t.metric}") for t in th.trends], "vw_counts", "vw_trends", "alert", LATE)
    count = lambda i: F.shiftright("vw_counts", 8 * i).bitwiseAND(F.lit(255).cast("long"))
    trend = []
    for i, t in enumerate(th.trends):
        trend += [count(i).alias(f"cnt_{t.metric}"), F.when(count(i) > 0, F.col(f"_avg_{t.metric}")).alias(f"avg_{t.metric}"),
                  (F.col("vw_trends").bitwiseAND(F.lit(1 << i)) != 0).alias(f"trend_{t.metric}")]
    flat = wide.select("device_id", "reading_ts", *[t.metric for t in th.trends], *[F.col(f"_p.{f.name}").alias(f.name) for f in payload.fields],
                       *trend, (F.col("vw_trends") != 0).alias("trend_any"), "alert", LATE)
    ruled = add_rule_flags(flat, th)
    return ruled.withColumn("is_anomaly", F.col("rule_any") | F.col("trend_any"))


def flag_stream(raw: DataFrame, th: Thresholds = DEFAULT, gap_seconds: float | None = None,
                keep: tuple[str, ...] = (), extra_fields: dict[str, str] | None = None,
                order: tuple[str, ...] = ("reading_ts",), mode: str = "strict",
                dedupe_delay: str | None = None, state_ttl_ms: int | None = None, wait_seconds: float | None = None,
                idle_ms: int | None = None, initial: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Good readings with rule, trend, ``is_anomaly``, ``alert`` and ``late`` columns.

    ``order`` is the order of arrival within a micro-batch (topic position, or fields of the message).
    ``wait_seconds`` processes a device in event order however its rows are cut into micro-batches: rows
    wait until the device's newest reading is that much later, and a row later than that is returned as
    ``late`` without flags (see :mod:`vitalwatch.streaming.processor`). ``idle_ms`` releases the rows of a
    device that has been silent for so long.

    ``extra_fields`` reads more JSON fields (name -> type) to carry along, for
    instance an event id used as the order tie. ``dedupe_delay`` keeps replays of a
    reading (device, time and event id or topic position) out of the state; rows later
    than the delay are then dropped by the watermark, so leave it unset where devices
    may send late. Without it no reading is dropped.

    ``initial`` is the past of devices known from a stored table (``handover.device_past``): a new
    checkpoint goes on where the table ends. ``state_ttl_ms`` forgets a device that has sent nothing for
    so long. TTL and ``idle_ms`` run on processing time; a stream with them is ended by ``stop``, since
    ``availableNow`` keeps starting batches for its timers.

    ``buckets`` is the number of groups of devices that are the keys of the state, about one for every 100 devices;
    it is fixed for the life of a checkpoint.
    """
    state_store(raw.sparkSession)
    parsed = parse_messages(raw, keep=keep, mode=mode, extra_fields=extra_fields, time_text=TIME_TEXT)
    good = parsed.where(F.col("reason").isNull()).drop("raw", "reason")
    if dedupe_delay:
        good = (good.withColumn("_event_time", F.col("reading_ts").cast("timestamp"))
                .withWatermark("_event_time", dedupe_delay)
                .dropDuplicatesWithinWatermark(list(identity(good.columns))).drop("_event_time"))
    narrow, arrival, payload = to_step(good, order, th)
    wait = None if wait_seconds is None else int(round(wait_seconds * 1e6))
    proc = DetectProcessor(arrival, th, gap_seconds, wait, state_ttl_ms, idle_ms, buckets)
    timed = state_ttl_ms is not None or idle_ms is not None
    by_bucket = lambda df: df.withColumn(BUCKET, bucket_of("device_id", buckets)).groupBy(BUCKET)
    out = by_bucket(narrow).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=PACKED, outputMode="Append",
        timeMode="ProcessingTime" if timed else "None",
        initialState=None if initial is None else by_bucket(initial))
    return from_step(out, payload, good.schema["reading_ts"].dataType, th)


def kafka_writer(servers: str, topic: str = "iot_raw_data"):
    """Write ``key, value`` rows of a micro-batch to a Kafka topic (not run here)."""
    def write(rows: DataFrame) -> None:
        (rows.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
    return write


def forward_writer(valid_sink, quarantine_path: str, keep: tuple[str, ...] = ()):
    """``foreachBatch`` function of the ingest bridge.

    Valid JSON is re-serialised and handed to ``valid_sink`` keyed by device
    (so a device's messages stay in one topic partition, in order); invalid
    messages go to the quarantine with their text, committed under the query's run and
    the batch (a replay adds nothing, another run overwrites nothing). Nothing is
    dropped, and no message blocks the next one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = forward(batch, keep=keep).persist()
        try:
            valid_sink(out.where(F.col("reason").isNull()))
            commit(out.where(F.col("reason").isNotNull()).select(*keep, "raw", "reason"), quarantine_path,
                   run_of(batch), batch_id)
        finally:
            out.unpersist()
    return write


def run_of(batch: DataFrame) -> str:
    """The run of the micro-batch: the streaming query's id."""
    run = query_run(batch.sparkSession)
    if run is None:
        raise RuntimeError("call this from foreachBatch, or pass the run: its id tells two runs apart")
    return run


def quarantine_stream(raw: DataFrame, keep: tuple[str, ...] = (), mode: str = "strict") -> DataFrame:
    """Bad messages with their text and reason; every message is counted by reason on the way (``accounting``)."""
    parsed = counted(parse_messages(raw, keep=keep, mode=mode))
    return parsed.where(F.col("reason").isNotNull()).select(*keep, "raw", "reason")


def late_rows(batch: DataFrame) -> DataFrame:
    """Late readings in the form of the quarantine: the message again, reason ``late``."""
    from ..functions.messages import iso_text

    text: Column = F.col(TIME_TEXT) if TIME_TEXT in batch.columns else iso_text(F.col("reading_ts"))
    keep = [c for c in ("event_id", "partition", "offset") if c in batch.columns]
    return batch.where(F.col(LATE)).select(*keep, "device_id", "reading_ts", to_message(batch, text).alias("raw"), F.lit(LATE).alias("reason"))


def batch_writer(readings_path: str, alerts_path: str, th: Thresholds = DEFAULT, run: str | None = None, late_path: str | None = None,
                 with_means: bool = False, then=None):
    """``foreachBatch`` function: readings, alerts and late rows, committed under (run, batch).

    A replay adds nothing and another run overwrites nothing. Rows that break a constraint of the table
    (:mod:`vitalwatch.sinks.constraints`) go beside the readings as rejected, with its name. Late rows go to ``late_path`` (default:
    beside the readings). ``with_means`` keeps the counts and means of the trends in the table.
    ``then(readings, run, batch_id)`` sees the readings of the batch, for instance ``refresh.Refresher``.
    """
    aside = late_path or f"{readings_path.rstrip('/')}_late"

    def write(batch: DataFrame, batch_id: int) -> None:
        own = run or run_of(batch)
        batch.persist()
        try:
            means = () if with_means else [c for c in batch.columns if c.startswith(("cnt_", "avg_"))]
            on_time = batch.where(~F.col(LATE))
            readings = on_time.drop("alert", LATE, TIME_TEXT, *means)
            if write_checked(readings, readings_path, f"{readings_path.rstrip('/')}_rejected", own, batch_id) is None:
                # a replay of what is stored: the state of the step still needs every row of the batch
                batch.write.format("noop").mode("overwrite").save()
            alerts = alert_rows(on_time.where(F.col("alert")), th, filter_anomalies=False, ts_text=TIME_TEXT)
            write_batch(alerts, alerts_path, batch_id, own)
            late = late_rows(batch)
            if not late.isEmpty():
                commit(late, aside, own, batch_id)
            if then is not None:
                then(readings, own, batch_id)
        finally:
            batch.unpersist()
    return write


def start(raw: DataFrame, readings_path: str, alerts_path: str, quarantine_path: str,
          checkpoint: str, trigger: dict | None = None, **kw):
    """Start the detection query and the quarantine query; returns both handles.

    A topic's (partition, offset) is carried along and is the order of arrival, in which a device's
    readings are processed as the deployed job does, however they are cut into micro-batches (pass
    ``wait_seconds`` for event order). Without a position, event time orders a micro-batch.
    """
    trigger = trigger or {"processingTime": "5 seconds"}
    position = tuple(c for c in ("partition", "offset") if c in raw.columns)
    kw.setdefault("keep", position)
    kw.setdefault("order", tuple(c for c in position if c in kw["keep"]) or ("reading_ts",))
    flagged = flag_stream(raw, **kw)
    q1 = (flagged.writeStream.foreachBatch(batch_writer(readings_path, alerts_path))
          .option("checkpointLocation", f"{checkpoint}/detect").trigger(**trigger).start())
    q2 = (quarantine_stream(raw, keep=kw.get("keep", ()), mode=kw.get("mode", "strict")).writeStream.format("parquet")
          .option("path", quarantine_path)
          .option("checkpointLocation", f"{checkpoint}/quarantine").trigger(**trigger).start())
    return q1, q2


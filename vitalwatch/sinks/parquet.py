"""The flagged-readings table as partitioned Parquet, written without doubling rows.

Layout: one folder per ``reading_date``; inside, rows sorted by device and
time, so Parquet row-group min/max statistics answer "one device" and "a time
range" lookups the way the four B-tree indexes of the SQL table did, and a
time filter prunes whole date folders.

Three ways to write, all safe to re-run:

* :func:`write_batch` for micro-batches: a folder of its own, committed under the
  query's run and the batch (:mod:`vitalwatch.sinks.commits`). A replay adds nothing,
  a second run over the same input stands beside the first, and the reader or a
  compaction keeps one row per reading.
* :func:`overwrite_days` for batch jobs that recompute whole days: dynamic
  partition overwrite replaces exactly the days present in the output.
* :func:`append_new` for batch appends to a plain table: rows are de-duplicated and
  anti-joined against the keys already stored for their days (only those date
  folders and only the key columns are read), then appended.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import micros
from . import commits

KEY = ("device_id", "reading_ts")
DATE, MICROS = "reading_date", "reading_us"
OWN_COLUMNS = (DATE, MICROS, "created_at")
# a lookup of one device skips row groups by the filter where min and max cannot
WRITER = {"parquet.bloom.filter.enabled#device_id": "true"}


def with_sink_columns(df: DataFrame, ts: str = "reading_ts") -> DataFrame:
    """The table's own columns: date partition, the time in microseconds (whole numbers have minima and maxima
    in the footers that aggregates can be pushed to), ``created_at`` (write time) and ``is_anomaly`` kept
    non-null (default false)."""
    out = df.withColumn(DATE, F.to_date(F.col(ts))).withColumn(MICROS, micros(df, ts))
    if "created_at" not in out.columns:
        out = out.withColumn("created_at", F.current_timestamp())
    if "is_anomaly" in out.columns:
        out = out.withColumn("is_anomaly", F.coalesce(F.col("is_anomaly"), F.lit(False)))
    return out


def _layout(df: DataFrame) -> DataFrame:
    """Files per date, rows sorted by device then time.

    REBALANCE (not a plain repartition by date): AQE splits a big day over
    many writer tasks and packs small days together, so one day never lands
    in one task and files come out near the advisory size.
    """
    return df.hint("rebalance", DATE).sortWithinPartitions(DATE, *KEY)


def overwrite_days(df: DataFrame, path: str) -> None:
    """Replace the date folders present in ``df``; other days stay as they are."""
    out = _layout(with_sink_columns(df))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**WRITER)
     .partitionBy(DATE).parquet(path))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def identity(columns: list[str]) -> tuple[str, ...]:
    """What tells readings apart: the event id or the topic position, with (device, time);
    (device, time) alone only where a table has neither."""
    more = next((c for c in (("event_id",), ("topic", "partition", "offset"), ("partition", "offset"))
                 if set(c) <= set(columns)), ())
    return (*KEY, *more)


def write_batch(df: DataFrame, path: str, batch_id: int, run: str) -> bool:
    """A micro-batch as a commit of (run, batch): every reading is kept, nothing stored is read again."""
    return commits.commit(with_sink_columns(df), path, run, batch_id, DATE, KEY, options=WRITER)


def compact(spark: SparkSession, path: str) -> int:
    """Each reading once, that of the earliest commit; rewrites only days that may hold one twice."""
    columns = [f.name for f in commits.read_table(spark, path, DATE).schema.fields]
    return commits.compact(spark, path, identity(columns), DATE, KEY, WRITER)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed table, each reading once (see ``identity``)."""
    columns = commits.read_table(spark, path, DATE).columns
    return commits.read_table(spark, path, DATE, identity(columns))


def append_new(df: DataFrame, path: str, key: tuple[str, ...] | None = None) -> None:
    """Append the rows whose key is not stored yet (exactly-once by key, see ``identity``)."""
    spark = df.sparkSession
    key = key or identity(df.columns)
    # de-duplicate and anti-join on the same key: one hash partitioning serves both
    batch = with_sink_columns(df).dropDuplicates(list(key))
    if _exists(spark, path):
        # the batch's days: a short list (bounded by its time span), used as
        # literals so that only those date folders are listed and read
        days = [r[0] for r in with_sink_columns(df.select(*key)).select(DATE).distinct().collect()]
        if days:
            stored = spark.read.schema(batch.schema).parquet(path).where(F.col(DATE).isin(days)).select(*key)
            batch = batch.join(stored, list(key), "left_anti")
    _layout(batch).write.mode("append").options(**WRITER).partitionBy(DATE).parquet(path)

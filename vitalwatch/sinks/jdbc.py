"""The flagged-readings table over JDBC (the deployed job's SQL table).

Written with Spark's JDBC data source from ``foreachBatch``: 100 rows per
insert batch as deployed, one connection per partition, and up to three more
tries of a micro-batch as deployed. A try removes the keys the table already
holds first (read back by several tasks, a time slice of the batch each, as
pushed predicates), so neither a try after a half-written one nor a replay
inserts twice.

No JDBC driver or database is available in the build environment, so the
connection has not been run here; rows, predicates and retries are tested.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import METRICS

COLUMNS = ("device_id", "timestamp", *METRICS, "is_anomaly")


def to_table_rows(df: DataFrame) -> DataFrame:
    """13 columns of the table, ``timestamp`` as TIMESTAMP, ``created_at`` now."""
    return df.select(F.col("device_id"), F.col("reading_ts").cast("timestamp").alias("timestamp"),
                     *[F.col(m) for m in METRICS],
                     F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
                     F.current_timestamp().alias("created_at"))


def time_predicates(start: dt.datetime, end: dt.datetime, parts: int, column: str = "timestamp") -> list[str]:
    """Adjoining time slices that cover [start, end], one read task each."""
    text = lambda t: f"'{t:%Y-%m-%d %H:%M:%S.%f}'"
    n = max(1, parts if end > start else 1)
    edges = [start + (end - start) * i / n for i in range(n)] + [end]
    return [f"{column} >= {text(a)} AND {column} {'<=' if i == n - 1 else '<'} {text(b)}"
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


def with_retries(write, retries: int, wait_seconds: float = 1.0):
    """``write()``, tried again up to ``retries`` times after an error, waiting longer each time."""
    for i in range(retries + 1):
        try:
            return write()
        except Exception:
            if i == retries:
                raise
            time.sleep(wait_seconds * 2**i)


def write_jdbc(df: DataFrame, url: str, table: str = "anomalies", properties: dict | None = None, batch_size: int = 100,
               dedupe: bool = True, retries: int = 3, read_parts: int = 16) -> None:
    """Append the rows whose (device, time) the table lacks; safe to run again."""
    props = dict(properties or {})
    rows = to_table_rows(df).persist()

    def attempt() -> None:
        new = rows
        bounds = rows.agg(F.min("timestamp"), F.max("timestamp")).first() if dedupe else (None, None)
        if bounds[0] is not None:
            slices = time_predicates(bounds[0], bounds[1], read_parts)
            stored = df.sparkSession.read.jdbc(url, table, predicates=slices, properties=props).select("device_id", "timestamp")
            new = rows.join(stored, ["device_id", "timestamp"], "left_anti")
        new.write.mode("append").option("batchsize", batch_size).jdbc(url, table, properties=props)

    try:
        with_retries(attempt, retries)
    finally:
        rows.unpersist()


def jdbc_batch_writer(url: str, table: str = "anomalies", properties: dict | None = None):
    """A ``foreachBatch`` function for the streaming job."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch, url, table, properties)
    return write

"""The dashboard's answers kept up to date batch by batch, without reading the table again.

The deployed dashboard asks its queries anew every few seconds. Here each micro-batch is
reduced to its own small answer (newest anomalies, last flag, counts per day), which is
merged with the stored one:

    newest anomalies   the first ``limit`` of stored and new rows
    last flag          the later of stored and new
    counts per day     sums per day

An answer is a committed table of its own (:mod:`vitalwatch.sinks.commits`): a batch's
entry replaces that of the batch before, so a replayed batch changes nothing and a reader
sees the answer of whole batches only. Answers are kept per run. The first two may be
merged over runs (a reading of two runs is one); counts belong to one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.dashboard import SERIES, TIE, TS
from ..sinks import commits
from ..sinks.parquet import identity
from ..thresholds import RECENT_LIMIT

TOP, LAST, DAYS = "top_recent", "last_flag", "per_day"


def _newest(rows: DataFrame, limit: int) -> DataFrame:
    keys = [c for c in (TS, TIE, "partition", "offset", "device_id") if c in rows.columns]
    # at most one row per reading: the limit rows of each side suffice
    return rows.dropDuplicates(list(identity(rows.columns))).orderBy(*[F.desc(k) for k in keys]).limit(limit)


def top_part(readings: DataFrame, limit: int) -> DataFrame:
    keep = [c for c in (TIE, "partition", "offset") if c in readings.columns]
    return _newest(readings.where("is_anomaly").select(TS, "device_id", *keep, *SERIES, "is_anomaly"), limit)


def last_part(readings: DataFrame) -> DataFrame:
    order = F.struct(*[F.col(c) for c in (TS, TIE, "partition", "offset") if c in readings.columns])
    return (readings.where("is_anomaly is not null").agg(F.max(F.struct(order.alias("at"), "is_anomaly")).alias("m"))
            .where("m is not null").select("m.at", "m.is_anomaly"))


def days_part(readings: DataFrame) -> DataFrame:
    return readings.groupBy(F.to_date(TS).alias("day")).agg(F.count("*").alias("n_readings"), F.count_if("is_anomaly").alias("n_anomalies"))


class Refresher:
    """Pass as ``then`` to ``batch_writer``: merges each batch into the answers under ``path``."""

    def __init__(self, path: str, limit: int = RECENT_LIMIT):
        self.path, self.limit = path.rstrip("/"), limit

    def __call__(self, readings: DataFrame, run: str, batch_id: int) -> None:
        self._merge(TOP, top_part(readings, self.limit), lambda both: _newest(both, self.limit), run, batch_id)
        self._merge(LAST, last_part(readings), lambda both: both.orderBy(F.desc("at"), F.desc("is_anomaly")).limit(1), run, batch_id)
        self._merge(DAYS, days_part(readings), lambda both: both.groupBy("day").agg(
            F.sum("n_readings").alias("n_readings"), F.sum("n_anomalies").alias("n_anomalies")), run, batch_id)

    def _merge(self, name: str, new: DataFrame, merge, run: str, batch_id: int) -> None:
        spark, path = new.sparkSession, f"{self.path}/{name}"
        if commits.is_committed(spark, path, run, batch_id):
            return
        before = [e for e in commits.entries(spark, path) if e.run == run]
        parts = tuple(commits.live_parts(before))
        both = commits.read_table(spark, path, run=run).unionByName(new) if before else new
        # an answer is small; merged in its own partitions first, as one task merging all would hold the buffers of each until its end
        commits.commit(merge(both).repartition(1), path, run, batch_id, replaces=parts)


def answer(spark: SparkSession, path: str, name: str, run: str | None = None) -> DataFrame:
    """The stored answer; newest anomalies and last flag merged over all runs unless one is named."""
    table = f"{path.rstrip('/')}/{name}"
    runs = {e.run for e in commits.entries(spark, table)}
    if name == DAYS and run is None and len(runs) > 1:
        raise ValueError("counts are kept per run: name one, as two runs may hold the same readings")
    rows = commits.read_table(spark, table, run=run)
    if name == LAST:
        return rows.orderBy(F.desc("at"), F.desc("is_anomaly")).limit(1)
    return rows


def top_recent(spark: SparkSession, path: str, run: str | None = None, limit: int = RECENT_LIMIT) -> DataFrame:
    """The table of newest anomalies, as ``dashboard.top_recent`` answers over the whole table."""
    return _newest(answer(spark, path, TOP, run), limit).select(F.col(TS).alias("time"), "device_id", *SERIES, "is_anomaly")

"""Partitions of the trend stage follow the rows, not their compressed bytes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import READING_SCHEMA
from vitalwatch.operators import sizing, trends
from vitalwatch.operators.detect import ORDER, check_hot, detect


def _readings(spark, n, devices):
    r = spark.range(n).select(F.col("id").alias("event_id"), F.concat(F.lit("d"), F.col("id") % devices).alias("device_id"),
                              F.expr("timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("reading_ts"))
    return r.select(*[F.col(f.name) if f.name in r.columns else (F.col("event_id") % 7).cast(f.dataType).alias(f.name)
                      for f in READING_SCHEMA.fields])


@pytest.mark.parametrize("chunk_rows", [1_000_000, 10])  # no hot device, every device hot
def test_rows_of_a_task_are_bounded(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(sizing, "TASK_ROWS", 250, raising=False)
    out = detect(_readings(spark, 4000, 200), chunk_rows=chunk_rows)
    rows = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(rows) == 4000 and max(rows) <= 3 * 250


def test_rows_are_counted_with_and_without_hot_keys(spark):
    r = _readings(spark, 100, 4).unionByName(_readings(spark, 30, 1)).withColumn(
        "device_id", F.when(F.col("event_id") != 3, F.col("device_id")))
    assert check_hot(r).n_rows == 130
    hot = check_hot(r, 40)  # d0 has 54 rows; the two rows without a device are never hot
    assert (hot.n_rows, hot.n_keys, hot.n_chunks) == (130, 1, 2) and hot.table.first()[0] == "d0"
    assert check_hot(r.limit(0)).n_rows == 0 and not check_hot(r.limit(0))


@pytest.mark.parametrize("task_rows", [250_000, 300])
def test_short_chunks_need_no_task_each(spark, monkeypatch, task_rows):
    monkeypatch.setattr(trends, "TASK_ROWS", task_rows, raising=False)
    r = _readings(spark, 2000, 2).withColumn("reading_ts", F.expr("timestampadd(SECOND, event_id % 500, TIMESTAMP_NTZ'2024-01-01 00:00:00')"))
    hot = check_hot(r, 10)
    cut = trends.chunks(r, "device_id", list(ORDER), hot)
    assert cut.rdd.getNumPartitions() == -(-3000 // task_rows) + 1  # 301 when each chunk was a range
    sizes = [x["count"] for x in cut.groupBy("_chunk").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 10 and len(sizes) <= 200 + cut.rdd.getNumPartitions()
    # chunks follow one another along device and order
    ends = cut.groupBy("_chunk").agg(F.min(F.struct("device_id", *ORDER)).alias("a"), F.max(F.struct("device_id", *ORDER)).alias("e")).orderBy("_chunk").collect()
    assert all(x["e"] < y["a"] for x, y in zip(ends, ends[1:], strict=False))

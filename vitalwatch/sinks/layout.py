"""A copy of the table for lookups by device, by time and by both: files in a space-filling order.

The deployed table has four indexes: device, time, flag, and (device, time). Folders by
date answer time ranges, but a device's history lies in every one of them. Here rows are
ordered along a Z curve over (device, time): the bits of a device's rank and of a time's
rank alternate, so a file (and a row group) covers a small box of both, and the minima and
maxima in the footers let a lookup by either, or by both, skip most of them. Bloom filters
on the device let it skip row groups whose range holds the device by chance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.dashboard import ts_literal
from .parquet import WRITER, with_sink_columns

ROW_GROUP = 32 * 1024 * 1024


def _rank(c: Column, cuts: list) -> Column:
    """How many of the (few) cut values are below or at ``c``."""
    return reduce(lambda a, b: a + b, [F.when(c >= cut, 1).otherwise(0) for cut in cuts], F.lit(0))


def z_value(device: Column, time: Column, bits: int) -> Column:
    """The bits of both ranks, taken in turn, the device's first."""
    z = F.lit(0)
    for i in range(bits):
        bit = lambda c: F.shiftright(c, i).bitwiseAND(F.lit(1))  # noqa: B023, E731
        z = z.bitwiseOR(F.shiftleft(bit(device), 2 * i + 1)).bitwiseOR(F.shiftleft(bit(time), 2 * i))
    return z


def cuts(df: DataFrame, column: str, n: int, sample: int) -> list[Column]:
    """At most ``n`` - 1 literal bounds from the quantiles of the ``sample`` rows of least hash (a bounded list)."""
    rows = (df.where(F.col(column).isNotNull()).select(column).orderBy(F.xxhash64(*df.columns)).limit(sample))
    values = sorted(r[0] for r in rows.collect())
    found = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    if df.schema[column].dataType.typeName().startswith("timestamp"):
        return [ts_literal(df, v, column) for v in found]
    return [F.lit(v) for v in found]


def write_clustered(df: DataFrame, path: str, files: int, device: str = "device_id", ts: str = "reading_ts", bits: int = 5,
                    sample: int = 10000, row_group_bytes: int = ROW_GROUP, options: dict | None = None) -> None:
    """Write ``df`` as about ``files`` files along the Z curve (pick files for some hundred MB each).

    A row group with few devices lists them in a dictionary, which lookups use like a bloom filter; Parquet
    writes the filter where the dictionary grows too large.
    """
    rows = with_sink_columns(df, ts)
    d, t = (_rank(F.col(c), cuts(df.select(device, ts), c, 1 << bits, sample)) for c in (device, ts))
    ranked = rows.withColumn("_d", d).withColumn("_t", t).withColumn("_z", z_value(F.col("_d"), F.col("_t"), bits)).drop("_d", "_t")
    out = ranked.repartitionByRange(files, "_z", device, ts).sortWithinPartitions("_z", device, ts).drop("_z")
    out.write.mode("overwrite").options(**(WRITER | (options or {}))).option("parquet.block.size", row_group_bytes).parquet(path)


def device_history(spark: SparkSession, path: str, device_id: str, start=None, end=None, device: str = "device_id",
                   ts: str = "reading_ts") -> DataFrame:
    """One device's readings, newest first, in an optional time range (both ends inclusive)."""
    df = spark.read.parquet(path).where(F.col(device) == F.lit(device_id))
    if start is not None:
        df = df.where(F.col(ts) >= ts_literal(df, start, ts))
    if end is not None:
        df = df.where(F.col(ts) <= ts_literal(df, end, ts))
    return df.orderBy(*[F.desc(c) for c in (ts, "event_id") if c in df.columns])

"""The read side: the dashboard's questions over the flagged readings table.

Every query is select-filter-sort over one table. Time bounds are literals of
the column's own type, so the filter reaches the Parquet scan (and, on a
table written by :mod:`vitalwatch.sinks.parquet`, prunes date partitions).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..thresholds import FLAG_RED_FROM, METRIC_RED_FROM, RANGE_PRESETS, RECENT_LIMIT

SERIES = ("heart_rate", "temperature", "systolic_pressure", "diastolic_pressure",
          "oxygen_saturation", "respiration_rate", "blood_glucose", "stress_level")
TS = "reading_ts"
TIE = "event_id"


def ts_literal(df: DataFrame, value, col: str = TS) -> Column:
    """A literal of the same timestamp type as ``col`` (keeps the filter pushable)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    return F.expr(f"TIMESTAMP'{text}'")


DATE, MICROS = "reading_date", "reading_us"


def time_filter(df: DataFrame, start, end, col: str = TS) -> DataFrame:
    """``start <= ts <= end``, both ends inclusive (the dashboard's BETWEEN).

    On the stored table the same range is also stated on the date partition
    column, so only the folders of the range are listed and read.
    """
    c = F.col(col)
    out = df.where((c >= ts_literal(df, start, col)) & (c <= ts_literal(df, end, col)))
    if DATE in df.columns:
        lo, hi = (dt.datetime.fromisoformat(x) if isinstance(x, str) else x for x in (start, end))
        out = out.where(F.col(DATE).between(F.lit(lo.date()), F.lit(hi.date())))
    return out


_PRESET = re.compile(r"^(\d+)([mhd])$")


def preset_range(preset: str, anchor: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """Relative range ``now-<preset> .. now`` with an explicit ``now``."""
    if preset not in RANGE_PRESETS:
        raise ValueError(f"unknown preset {preset!r}; one of {RANGE_PRESETS}")
    n, unit = _PRESET.match(preset).groups()
    delta = {"m": dt.timedelta(minutes=int(n)), "h": dt.timedelta(hours=int(n)),
             "d": dt.timedelta(days=int(n))}[unit]
    return anchor - delta, anchor


def latest_ts(df: DataFrame, col: str = TS) -> dt.datetime | None:
    """The anchor used when ``now`` is the newest reading (one aggregate)."""
    return df.agg(F.max(col)).first()[0]


def newest_from_footers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The newest time of a stored table as one row, from the minima and maxima in its footers: no row is read.

    The aggregate is pushed into Spark's Parquet reader of the newer kind, which only a session of its own is
    told to use. Spark pushes whole numbers, not times, so the table keeps its times in microseconds too.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(*([path] if isinstance(path, str) else path))
    newest = table.agg(F.max(MICROS).alias("us"))
    if isinstance(table.schema[TS].dataType, T.TimestampNTZType):
        return newest.select(F.expr("timestampadd(MICROSECOND, us, TIMESTAMP_NTZ'1970-01-01 00:00:00')").alias("newest"))
    return newest.select(F.timestamp_micros("us").alias("newest"))


def _ordered(df: DataFrame, desc: bool = False) -> DataFrame:
    keys = [TS] + ([TIE] if TIE in df.columns else [])
    return df.orderBy(*[F.col(k).desc() if desc else F.col(k).asc() for k in keys])


def series(df: DataFrame, metric: str, start, end) -> DataFrame:
    """``time, <metric>`` in range, ordered by time (one panel series)."""
    out = time_filter(df, start, end)
    keys = [TS] + ([TIE] if TIE in df.columns else [])
    return (out.select(*keys, metric).transform(_ordered)
            .select(F.col(TS).alias("time"), metric))


def series_overlay(df: DataFrame, start, end, metrics=SERIES) -> DataFrame:
    """All series of the vitals panel from one scan, long form ``time, metric, value``."""
    # the wide rows are sorted; stack then gives each row's metrics in name order
    out = time_filter(df, start, end).transform(_ordered)
    pairs = ", ".join(f"'{m}', cast(`{m}` AS double)" for m in sorted(metrics))
    return out.select(F.col(TS).alias("time"), F.expr(f"stack({len(metrics)}, {pairs}) AS (metric, value)"))


def top_recent(flagged: DataFrame, start, end, limit: int = RECENT_LIMIT) -> DataFrame:
    """Newest anomalous readings, newest first; plans as TakeOrderedAndProject."""
    out = time_filter(flagged.where(F.col("is_anomaly")), start, end)
    return (out.transform(lambda d: _ordered(d, desc=True)).limit(limit)
            .select(F.col(TS).alias("time"), "device_id", *SERIES, "is_anomaly"))


def flag_series(flagged: DataFrame, start, end) -> DataFrame:
    out = time_filter(flagged, start, end)
    keys = [TS] + ([TIE] if TIE in flagged.columns else [])
    return (out.select(*keys, "is_anomaly").transform(_ordered)
            .select(F.col(TS).alias("time"), F.col("is_anomaly").cast("int").alias("is_anomaly")))


def last_not_null(flagged: DataFrame, start, end) -> DataFrame:
    """The stat panel: last non-null flag value in range; one aggregate, no sort."""
    out = time_filter(flagged, start, end).where(F.col("is_anomaly").isNotNull())
    order = F.struct(*[F.col(k) for k in ([TS] + ([TIE] if TIE in flagged.columns else []))])
    return out.agg(F.max_by(F.col("is_anomaly").cast("int"), order).alias("last_flag"))


def newest_flag(flagged: DataFrame, start, end) -> DataFrame:
    """``last_not_null`` over a table with day folders: the newest day in range that holds a flag, and no other.

    The days come from the folder names and footers (no column is read); the flag is nearly always in the first.
    """
    if DATE not in flagged.columns:
        return last_not_null(flagged, start, end)
    lo, hi = (dt.datetime.fromisoformat(x) if isinstance(x, str) else x for x in (start, end))
    listed = flagged.where(F.col(DATE).between(F.lit(lo.date()), F.lit(hi.date()))).select(DATE).distinct()
    for day in sorted((r[0] for r in listed.collect()), reverse=True):
        found = last_not_null(flagged.where(F.col(DATE) == F.lit(day)), start, end)
        if found.first()[0] is not None:
            return found
    return last_not_null(flagged.where(F.lit(False)), start, end)


def band(value: Column, red_from: float) -> Column:
    """Colour step: ``red`` from ``red_from`` up, else ``green``; NULL stays NULL."""
    return F.when(value.isNull(), F.lit(None).cast("string")).when(
        value >= F.lit(red_from), F.lit("red")).otherwise(F.lit("green"))


def bands(flagged: DataFrame, start, end) -> DataFrame:
    """Per reading: the flag panel colour (red from 1) and the vitals colour (red from 80)."""
    out = time_filter(flagged, start, end)
    return out.select(F.col(TS).alias("time"), TIE,
                      band(F.col("is_anomaly").cast("int"), FLAG_RED_FROM).alias("flag_band"),
                      *[band(F.col(m), METRIC_RED_FROM).alias(f"band_{m}") for m in SERIES])


def no_value(flagged: DataFrame, start, end) -> DataFrame:
    """The stat panel text: the last flag, or ``N/A`` when the range is empty."""
    last = newest_flag(flagged, start, end)
    return last.select(F.coalesce(F.col("last_flag").cast("string"), F.lit("N/A")).alias("display"))


def range_preset(flagged: DataFrame, preset: str, anchor: dt.datetime | None = None) -> DataFrame:
    """The flag series over ``now-<preset> .. now``; ``now`` defaults to the newest reading."""
    anchor = anchor or latest_ts(flagged)
    if anchor is None:  # an empty table has no newest reading
        return flag_series(flagged.where(F.lit(False)), dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1))
    start, end = preset_range(preset, anchor)
    return flag_series(flagged, start, end)

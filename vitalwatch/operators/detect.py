"""Flag every reading: range rules OR trend rules; every reading is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..thresholds import DEFAULT, Thresholds
from .rules import add_rule_flags
from .sizing import HotKeys, hot_keys
from .trends import DEFAULT_CHUNK_ROWS, add_trend_columns

ORDER = ("reading_ts", "event_id")


def detect(df: DataFrame, th: Thresholds = DEFAULT, order: tuple[str, ...] = ORDER,
           chunk_rows: int = DEFAULT_CHUNK_ROWS, hot: HotKeys | None = None) -> DataFrame:
    """Readings with ``rule_*``, ``cnt_*``, ``avg_*``, ``trend_*`` and ``is_anomaly``.

    The range rules are evaluated after the window stage, so the shuffle
    carries only the input columns.
    """
    out = add_trend_columns(df, th, order=order, chunk_rows=chunk_rows, hot=hot)
    out = add_rule_flags(out, th)
    return out.withColumn("is_anomaly", F.col("rule_any") | F.col("trend_any"))


def check_hot(df: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> HotKeys:
    """The hot-device check of the readings, to share between detect and cooldown."""
    return hot_keys(df, "device_id", chunk_rows)

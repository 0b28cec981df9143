"""Cleaning and enrichment columns (the device simulator's value handling).

* :func:`clamp` keeps a metric inside its normal range; NULL stays NULL
  (Spark's ``greatest``/``least`` skip NULLs, so they are guarded).
* :func:`hour_band` maps the hour of day to the simulator's activity band.
* :func:`round_half_even` is Python's ``round``: ties go to the even digit
  (Spark's ``round`` goes half up; ``bround`` is the half-even one).
* :func:`truncate` drops the fraction toward zero, as ``int(x)`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..thresholds import CLAMP_BOUNDS, HOUR_BANDS


def clamp_column(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def clamp(df: DataFrame, bounds=CLAMP_BOUNDS) -> DataFrame:
    """Every metric of ``bounds`` clamped into [lo, hi]; other columns unchanged."""
    repl = {m: clamp_column(F.col(m), lo, hi) for m, lo, hi in bounds if m in df.columns}
    return df.withColumns(repl)


def hour_band(ts: Column, bands=HOUR_BANDS) -> Column:
    """Band name of the hour of ``ts`` (bands are (start hour, name), ascending)."""
    h = F.hour(ts)
    # `when` branches are tried in order: test the latest start first
    expr = None
    for start, name in sorted(bands, key=lambda b: -b[0]):
        expr = (F.when(h >= F.lit(start), F.lit(name)) if expr is None
                else expr.when(h >= F.lit(start), F.lit(name)))
    return expr


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def truncate(c: Column) -> Column:
    """Toward zero, NULL-safe, no overflow error (``try_cast``)."""
    return c.try_cast("int")

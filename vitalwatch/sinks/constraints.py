"""The table's constraints, checked in the pass that writes it.

The deployed table declares ``device_id VARCHAR(255) NOT NULL``, a time ``NOT NULL`` and a
flag ``NOT NULL DEFAULT FALSE``. A row that breaks one fails the deployed insert; here it
goes to a table of rejected rows with the name of the first constraint it breaks, and the
others are stored. Counts come from ``DataFrame.observe`` on the writing job itself, so a
clean input is read once; only where something was broken a second pass picks those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import commits
from .parquet import DATE, with_sink_columns, write_batch

BROKEN = "broken"
DEVICE_LENGTH = 255


def constraints(ts: str = "reading_ts") -> dict[str, Column]:
    """Name -> condition that a stored row must meet, in the order in which they are told."""
    return {"device_id_not_null": F.col("device_id").isNotNull(),
            "device_id_length": F.length("device_id") <= DEVICE_LENGTH,
            "time_not_null": F.col(ts).isNotNull()}


def with_broken(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with the first broken constraint (NULL where all hold); a NULL flag becomes false."""
    out = F.lit(None).cast("string")
    for name, holds in reversed((rules or constraints()).items()):
        out = F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)).otherwise(out)
    flagged = df.withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False))) if "is_anomaly" in df.columns else df
    return flagged.withColumn(BROKEN, out)


def write_checked(df: DataFrame, path: str, rejected: str, run: str, batch_id: int,
                  rules: dict[str, Column] | None = None) -> dict[str, int] | None:
    """Commit the rows that meet every constraint to ``path`` and the others to ``rejected``.

    Returns the counts (``stored`` and one per constraint), or None where (run, batch) is stored already: then
    only rejected rows that a stop between the two commits left out are added.
    """
    names = list(rules or constraints())
    seen = Observation()
    told = with_broken(df, rules)
    watched = told.observe(seen, F.count_if(F.col(BROKEN).isNull()).alias("stored"),
                           *[F.count_if(F.col(BROKEN) == n).alias(n) for n in names])
    bad = with_sink_columns(told).drop(DATE).where(F.col(BROKEN).isNotNull())
    counts = None
    if write_batch(watched.where(F.col(BROKEN).isNull()).drop(BROKEN), path, batch_id, run):
        counts = {k: int(v) for k, v in seen.get.items()}
    if any(counts[n] for n in names) if counts else not bad.isEmpty():
        commits.commit(bad, rejected, run, batch_id)
    return counts

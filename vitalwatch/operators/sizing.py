"""Hot keys and size-checked broadcasts.

``hot_keys`` runs one aggregate (partial aggregation map-side, so the shuffle
carries at most one row per key and map task) and keeps the keys with more
than ``chunk_rows`` rows. Their number is bounded by ``total_rows /
chunk_rows`` however skewed the data is, which is what makes broadcasting
that table safe; the bound is still checked against a limit, and above it
the join falls back to a shuffle join.

The same aggregate counts the rows, from which ``dealt`` takes the number of
partitions of a stage with many sorts: the adaptive reader sizes partitions by
their compressed bytes, so a stage that sorts eight times would hold eight times
what those grow to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

# Rows of a partition in a stage that sorts its rows several times.
TASK_ROWS = 250_000


def micros(df: DataFrame, col: str):
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))


class HotKeys:
    """Keys with more than ``chunk_rows`` rows, and in how many chunks they go.

    ``table`` has the key column; it is only built when ``n_keys > 0``. A key
    set found on a table is also valid for any subset of its rows (for
    instance the anomalies of the same readings), since a subset holds no
    more rows per key.
    """

    def __init__(self, table: DataFrame | None, n_keys: int, n_chunks: int, chunk_rows: int, n_rows: int):
        self.table, self.n_keys, self.n_chunks, self.chunk_rows = table, n_keys, n_chunks, chunk_rows
        self.n_rows = n_rows  # of the whole input

    def __bool__(self) -> bool:
        return self.n_keys > 0


def hot_keys(df: DataFrame, key: str, chunk_rows: int) -> HotKeys:
    """One aggregate job: how many keys exceed ``chunk_rows``, in how many chunks, and how many rows there are."""
    stats = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    is_hot = F.col(key).isNotNull() & (F.col("_n") > F.lit(chunk_rows))
    row = stats.agg(F.count_if(is_hot).alias("n"), F.sum("_n").alias("rows"),
                    F.sum(F.when(is_hot, F.ceil(F.col("_n") / F.lit(chunk_rows)))).alias("k")).first()
    n_rows = int(row["rows"] or 0)
    if not row["n"]:
        return HotKeys(None, 0, 0, chunk_rows, n_rows)
    # hot keys exist: write the (small, bounded) table once, so the branches
    # that join it do not each re-run the aggregate over the whole input
    ensure_checkpoint_dir(df.sparkSession)
    return HotKeys(stats.where(is_hot).select(key).checkpoint(), int(row["n"]), int(row["k"]), chunk_rows, n_rows)


def dealt(df: DataFrame, n_rows: int, *by: str) -> DataFrame:
    """``df`` (at most ``n_rows`` rows) by hash of ``by``, about ``TASK_ROWS`` rows in a partition.

    The count is given, so the adaptive reader does not merge partitions, unless all rows would do for one.
    """
    if n_rows <= TASK_ROWS:
        return df.repartition(*by)
    spark = df.sparkSession
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(max(least, -(-n_rows // TASK_ROWS)), *by)


def broadcast_if_small(df: DataFrame, bound_rows: int, limit_rows: int) -> DataFrame:
    """Broadcast ``df`` only when its proven row bound is under the limit."""
    return F.broadcast(df) if bound_rows <= limit_rows else df

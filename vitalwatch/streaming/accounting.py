"""What a stream took and set aside, per micro-batch and reason, without another pass.

``counted`` observes the parsed messages on their way (Spark's observed metrics);
``ErrorAccounting`` is a query listener that keeps the counts of every batch.
"""

from __future__ import annotations

from collections import Counter
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.parse import BAD_JSON, BAD_TIMESTAMP, MISSING_KEY

NAME = "messages"
REASONS = (BAD_JSON, MISSING_KEY, BAD_TIMESTAMP)


def counted(parsed: DataFrame, name: str = NAME) -> DataFrame:
    """The same rows; messages, good ones and those of each reason are counted as they pass."""
    per = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return parsed.observe(name, F.count(F.lit(1)).alias("received"), F.count_if(F.col("reason").isNull()).alias("good"), *per)


class ErrorAccounting(StreamingQueryListener):
    """Counts per (query id, batch id); ``tell(query id, batch id, counts)`` is called for each batch.

    A replayed batch replaces its counts, so totals hold every message once.
    """

    def __init__(self, name: str = NAME, tell=None):
        self.name, self.tell, self.lock = name, tell, Lock()
        self.batches: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        counts = {k: int(v or 0) for k, v in row.asDict().items()}
        with self.lock:
            self.batches[str(event.progress.id), event.progress.batchId] = counts
        if self.tell is not None:
            self.tell(str(event.progress.id), event.progress.batchId, counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self) -> dict[str, int]:
        with self.lock:
            return dict(sum((Counter(c) for c in self.batches.values()), Counter()))

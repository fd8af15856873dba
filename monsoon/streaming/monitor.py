"""What running streams report about themselves."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from monsoon import schemas as S
from monsoon.session import matches, put_text

NEW_ARTICLES = "artikel_baru"


def counted(articles: DataFrame, name: str = "poll") -> DataFrame:
    """Count the rows passing here, reported with each micro-batch."""
    return articles.observe(name, F.count(F.lit(1)).alias(NEW_ARTICLES))


# One record per stream and batch that had events.
COUNTS = S.shape(stream=S.TEXT, batch=S.WHOLE, jumlah_event=S.WHOLE, artikel_baru=S.WHOLE)


class BatchCounts(StreamingQueryListener):
    """Counts of every micro-batch of every stream that had any events.

    ``told`` is called with each as it comes. With ``store`` each is a file of its own there,
    named after stream and batch, written as the batch ends: what was counted is there
    whatever becomes of the streams or this process, and a batch counted again replaces
    itself. ``batches`` maps (stream, batch) to the events taken in and the new articles,
    the latter None where none are counted; what is stored is not held here as well.
    """

    def __init__(
        self,
        told: Callable[[str], None] | None = None,
        spark: SparkSession | None = None,
        store: str | None = None,
    ) -> None:
        self.batches: dict[tuple[str, int], tuple[int, int | None]] = {}
        self.told, self.spark, self.store = told, spark, store
        self._last: dict[str, int] = {}

    def record(self, name: str, batch: int, events: int, new: int | None) -> None:
        if not events or batch <= self._last.get(name, -1):
            return
        self._last[name] = batch
        if self.store:
            row = dict(zip(COUNTS.names, (name, batch, events, new)))
            put_text(self.spark, f"{self.store}/{quote(name, safe='')}-{batch:012d}.json", json.dumps(row) + "\n")
        else:
            self.batches[name, batch] = events, new
        if self.told:
            fresh = f", {new} artikel baru" if new is not None else ""
            self.told(f"  {name:15s} : batch {batch}, {events} event{fresh}")

    def take(self, progress) -> None:
        metrics = (progress.observedMetrics or {}).values()
        new = [m[NEW_ARTICLES] for m in metrics if NEW_ARTICLES in m]
        name = progress.name or str(progress.id)
        self.record(name, progress.batchId, progress.numInputRows, new[0] if new else None)

    def catch_up(self, query: StreamingQuery) -> None:
        """What an ended query reports and the listener has not heard of yet."""
        for progress in query.recentProgress:
            self.take(progress)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.take(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def status_lines(queries: dict[str, StreamingQuery]) -> list[str]:
    """Which streams are alive."""
    return [f"  {n:15s} : {S.ALIVE if q.isActive else S.DEAD}" for n, q in queries.items()]


def stored_counts(spark: SparkSession, store: str) -> DataFrame:
    """The counts that are stored, one row per stream and batch."""
    if not matches(spark, store):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).option("pathGlobFilter", "*.json").json(store)

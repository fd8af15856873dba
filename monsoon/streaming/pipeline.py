"""Several streams started, watched and stopped together."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from monsoon.streaming.monitor import BatchCounts, status_lines
from monsoon.streaming.triggers import DRAIN

# Starts a stream with a trigger; calling it again goes on from the same checkpoint.
Start = Callable[[dict], StreamingQuery]


def run_together(
    spark: SparkSession,
    starts: dict[str, tuple[Start, dict]],
    seconds: float | None = None,
    status_every: float = 60.0,
    told: Callable[[str], None] = print,
    store: str | None = None,
) -> BatchCounts:
    """Run the streams until interrupted, or for a time, then store the remainder.

    Counts of every batch and the status are told as they come, and kept below ``store``.
    On the way out each stream is stopped and run once more over what has arrived, in the
    order given, so that what one passes on still reaches the next. If a stream fails, or
    cannot be started, the others are drained all the same and its error is raised; one that
    failed is not run again.
    """
    counts = BatchCounts(told, spark, store)
    spark.streams.resetTerminated()
    spark.streams.addListener(counts)
    queries: dict[str, StreamingQuery] = {}
    errors: dict[str, Exception] = {}
    began = time.monotonic()
    try:
        for name, (start, trigger) in starts.items():
            try:
                queries[name] = start(trigger)
            except Exception as error:
                errors[name] = error
                raise
        while all(q.isActive for q in queries.values()):
            for line in status_lines(queries):
                told(line)
            left = None if seconds is None else seconds - (time.monotonic() - began)
            if left is not None and left <= 0:
                break
            spark.streams.awaitAnyTermination(min(status_every, status_every if left is None else left))
    except KeyboardInterrupt:
        told("berhenti")
    finally:
        try:
            for name, query in queries.items():
                if query.exception() is not None:
                    errors[name] = query.exception()
                query.stop()
                counts.catch_up(query)
            for name, (start, _) in starts.items():
                if name in errors:
                    continue
                try:
                    rest = start(DRAIN)
                    rest.awaitTermination()
                    counts.catch_up(rest)
                except Exception as error:
                    errors[name] = error
            for line in status_lines(queries):
                told(line)
        finally:
            spark.streams.removeListener(counts)
            spark.streams.resetTerminated()
    for error in errors.values():
        raise error
    return counts

"""Streams that store topics as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from monsoon.streaming.triggers import FLUSH


def store_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = FLUSH,
    name: str | None = None,
) -> StreamingQuery:
    """Write what arrived since the last flush as JSON files, nothing if nothing arrived.

    A batch that fails is repeated from the checkpoint and its files are committed
    once. Files hold one record per line, so large ones can be split when read.
    """
    writer = (
        events.writeStream.format("json")
        .option("ignoreNullFields", "false")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()

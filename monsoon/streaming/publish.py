"""Streams that publish to the bus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from monsoon.session import stream_id
from monsoon.sinks.bus import publish
from monsoon.streaming.triggers import DRAIN


def publish_stream(
    messages: DataFrame,
    checkpoint: str,
    path: str | None = None,
    servers: str | None = None,
    trigger: dict = DRAIN,
    name: str | None = None,
) -> StreamingQuery:
    """Publish messages as they arrive.

    Each batch is a part of its own, named after the stream and the batch. On the
    file-backed bus a repeated batch finds its part complete. A broker gets it again after
    a failure, as with any at-least-once sink, with the same ids.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}"
        publish(batch, path, servers, part=own)

    writer = messages.writeStream.foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

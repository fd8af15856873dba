"""Each link once, over the life of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monsoon.operators.articles import with_link
from monsoon.session import ADAPTIVE, stateful, stream_id, using
from monsoon.streaming.monitor import counted
from monsoon.streaming.triggers import POLL_NEWS

Forward = Callable[[DataFrame, str], None]


def newly_seen(articles: DataFrame, order: list, within: str | None = None, time: str = "fetched_at") -> DataFrame:
    """The first article of each link, in the batch that brings the link first.

    The state store keeps the first article of every link, without expiry, and the times of
    the batches that had the link first and last; all rows of a batch have one time, which
    a repeated batch has again. A link that is new has both times alike. Each task reduces
    its rows to one per link before the shuffle, so a link that much of a batch carries is
    no heavier than any other, and nothing that was stored is read again.

    With ``within``, such as "1 day", a link is new once in every period of that length, by
    the column ``time``. A period's links are forgotten when times have gone on by as much
    again, so the state holds two periods or so however long the stream runs; an article
    that comes later than that is left out, as is one without a time.
    """
    keys = [F.col("link").alias("_link")]
    if within:
        articles = articles.withWatermark(time, within)
        keys.append(F.window(time, within).alias("_period"))
    first = F.min_by(F.struct(*articles.columns), F.struct("_seen", *order))
    return (
        with_link(articles)
        .withColumn("_seen", F.current_timestamp())
        .groupBy(*keys)
        .agg(first.alias("first"), F.min("_seen").alias("_from"), F.max("_seen").alias("_to"))
        .filter(F.col("_from") == F.col("_to"))
        .select("first.*")
    )


def first_seen_stream(
    articles: DataFrame,
    path: str,
    order: list,
    trigger: dict = POLL_NEWS,
    forward: Forward | None = None,
    name: str | None = None,
    within: str | None = None,
) -> StreamingQuery:
    """The first article of each link in arrival order, appended batch by batch; with
    ``within`` the first in each period of that length, on bounded state.

    Each batch writes a directory of its own, so a repeated batch replaces its own files.
    The position and the links seen are kept below the same path, for without them the
    batches would be numbered anew and replace older ones.

    ``forward`` gets the new articles of each batch once they are stored, for example to
    publish them, with a name for the batch that is the same if it is repeated. After a
    failure it may get a batch again, but none is left out.
    """
    checkpoint = f"{path}/_checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{path}/batch={batch_id}"
        # A stream turns adaptive execution off in its session; its shuffle has many small
        # partitions, which are written as few files.
        with using(spark, ADAPTIVE):
            batch.hint("rebalance").write.mode("overwrite").parquet(own)
            if forward:
                new = spark.read.schema(batch.schema).parquet(own)
                forward(new, f"{stream_id(spark, checkpoint)}-{batch_id}")

    with using(articles.sparkSession, stateful(articles.sparkSession)):
        writer = counted(newly_seen(articles, order, within)).writeStream.outputMode("update")
        if name:
            writer = writer.queryName(name)
        return (
            writer.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

"""Storing results and curated events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monsoon.operators.analyses import with_event_time
from monsoon.session import using
from monsoon.sources.weather import count_refused, documents, indented_files, readable, refused
from monsoon.streaming.triggers import DRAIN

# Without this a batch that has no readable row is replaced by an empty one as it runs, and
# its counts with it.
KEEP_EMPTY_STAGES = {
    "spark.sql.adaptive.optimizer.excludedRules": (
        "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    )
}


def write_json(df: DataFrame, path: str) -> None:
    """Replace a JSON directory; NULL fields are written, not left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_document(document: DataFrame, path: str) -> None:
    """Replace the one-row dashboard document."""
    document.write.mode("overwrite").text(path)


def write_curated(observations: DataFrame, path: str, batch: int = 0) -> None:
    """Observations as Parquet by day, for scans that prune days and columns.

    The parsed time is stored with them, so analyses need not parse it again. A batch
    written again replaces its own files only. Rows are regrouped by day; adaptive execution
    cuts a day that holds much of the data into several files and joins small ones.
    """
    dated = with_event_time(observations).withColumn("event_date", F.to_date("ts_obj"))
    (
        dated.withColumn("batch", F.lit(batch).cast("long"))
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch")
        .parquet(path)
    )


def curate_stream(records: DataFrame, path: str, rejects: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Add what is new to the observations stored by day, and what cannot be read to the rejects.

    The position is kept below the same path. A batch is read once: unreadable lines are
    counted while its rows are stored. Only if there are any is it read again, to tell
    documents over several lines, which are then read whole, from lines that are broken.
    """

    def keep(batch: DataFrame, number: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        counted = batch.observe(seen, count_refused().alias("n"))
        with using(spark, KEEP_EMPTY_STAGES):
            write_curated(readable(counted), path, number)
        if not seen.get["n"]:
            return
        indented = indented_files(batch)
        lines = refused(batch)
        if indented:
            whole = documents(spark, indented)
            # No line of these files was a record, so none of their rows is stored yet.
            write_curated(readable(batch).unionByName(readable(whole)), path, number)
            lines = lines.filter(~F.col("path").isin(indented)).unionByName(refused(whole))
        write_json(lines, f"{rejects}/batch={number}")

    return (
        records.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(**trigger)
        .start()
    )


def display(df: DataFrame, truncate: bool = False) -> None:
    """Print the schema and all rows of a report."""
    df.printSchema()
    df.show(df.count(), truncate=truncate)


def print_rows(df: DataFrame) -> None:
    """Print any number of rows, fetched a partition at a time."""
    for row in df.toLocalIterator(prefetchPartitions=True):
        print(*row, sep="\t")

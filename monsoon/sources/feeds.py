"""Landed feed documents and their entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.functions.clock import iso_text


def landed_feeds_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.RAW_FEED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _documents(raw: DataFrame) -> DataFrame:
    return raw.withColumn("doc", F.from_xml("xml", S.FEED_DOCUMENT)).drop("xml")


def _is_atom() -> Column:
    return F.col("doc._xmlns").eqNullSafe(S.ATOM)


def _as_item(entry: Column) -> Column:
    """An Atom entry in the shape of an RSS item: the first link to a page, else the id; the
    summary, else the content."""
    page = F.filter(
        entry["link"],
        lambda x: F.coalesce(x["_rel"], F.lit("alternate")).eqNullSafe("alternate")
        & F.coalesce(x["_type"], F.lit(S.PAGE_TYPES[0])).isin(S.PAGE_TYPES),
    )
    return F.struct(
        entry["title"].alias("title"),
        F.coalesce(F.get(page, F.lit(0))["_href"], entry["id"]).alias("link"),
        F.coalesce(entry["summary"], entry["content"]).alias("description"),
        entry["published"].alias("pubDate"),
    )


def _title() -> Column:
    return F.when(_is_atom(), F.col("doc.title")).otherwise(F.col("doc.channel.title"))


def _items() -> Column:
    return F.when(_is_atom(), F.transform("doc.entry", _as_item)).otherwise(F.col("doc.channel.item"))


def feed_entries(raw: DataFrame) -> DataFrame:
    """One row per entry of an RSS 2.0 or Atom document, with its place in the document.

    A document that cannot be read yields no entries, leaves the other feeds alone and is
    listed by ``feed_rejects``.
    """
    kept = [c for c in raw.columns if c != "xml"]
    return (
        _documents(raw)
        .select(
            *kept,
            _title().alias("feed_title"),
            F.posexplode(_items()).alias("pos", "item"),
        )
        .select(*kept, "feed_title", "pos", "item.*")
    )


def feed_rejects(raw: DataFrame) -> DataFrame:
    """Landed documents that are neither a channel nor an Atom feed that can be read, whole,
    with the reason."""
    read = raw.select("*", F.inline(F.array(F.struct(F.from_xml("xml", S.FEED_DOCUMENT).alias("doc")))))
    reason = F.when(F.col("xml").isNull(), "no_document").when(
        F.col("doc.channel").isNull() & ~_is_atom(), "no_channel"
    )
    return (
        read.withColumn("alasan", reason)
        .filter(F.col("alasan").isNotNull())
        .select("feed_url", iso_text(F.col("fetched_at")).alias("fetched_at"), "xml", "alasan")
    )


def together(*entries: DataFrame) -> DataFrame:
    """Entries landed in separate places as one frame; every one of them is kept."""
    return reduce(DataFrame.unionByName, entries)


def feed_summaries(raw: DataFrame) -> DataFrame:
    """Title and number of entries of each landed document."""
    kept = [c for c in raw.columns if c != "xml"]
    return _documents(raw).select(
        *kept,
        F.coalesce(_title(), F.lit(S.NO_FEED_TITLE)).alias("judul_feed"),
        F.coalesce(F.size(_items()), F.lit(0)).alias("jumlah_artikel"),
    )

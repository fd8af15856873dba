"""Observations, answers, articles and feeds derived from the given tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon import schemas as S
from monsoon.functions.text import prefix
from monsoon.functions.wire import KEEP_NULLS

EVENTS = S.shape(
    event_id=S.WHOLE,
    ts=T.TimestampNTZType(),
    user_id=S.WHOLE,
    event_type=S.TEXT,
    value=S.REAL,
    props=S.TEXT,
)
DOCUMENTS = S.shape(doc_id=S.WHOLE, text=S.TEXT, lang=S.TEXT, source=S.TEXT, n_chars=S.WHOLE)

TABLES = {"events": EVENTS, "documents": DOCUMENTS}

DOCS_PER_POLL = 100
FIRST_ARRIVAL = 1704067200  # 2024-01-01 00:00:00 UTC
ENTRY_COLUMNS = ["title", "link", "description", "pubDate"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The bracket makes this a pattern, which a file stream accepts for a table of
    # one file as well as for a directory.
    return spark.readStream.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parque[t]")


def _quoted(values: Iterable[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def as_observations(events: DataFrame, *keep: str) -> DataFrame:
    """Events as observations of the six cities: both time layouts, unknown
    temperatures, unreadable and missing times all occur."""
    return events.selectExpr(
        "event_id",
        *keep,
        f"get(array({_quoted(code for code, *_ in S.CITIES)}), int(user_id % 6)) AS kode_kota",
        f"get(array({_quoted(name for _, name, *_ in S.CITIES)}), int(user_id % 6)) AS nama_kota",
        "IF(event_id % 97 = 0, NULL, double(200 + event_id * 7 % 180) / 10D) AS temperature",
        "double(40 + event_id * 13 % 55) AS humidity",
        "value / 10D AS wind_speed",
        "user_id % 100 AS weather_code",
        """CASE WHEN event_id % 89 = 0 THEN 'garbage'
                WHEN event_id % 83 = 0 THEN NULL
                WHEN event_id % 2 = 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS `timestamp`""",
    ).filter("kode_kota IS NOT NULL")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(read(spark, sf_dir, "events"))


def observations_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(read_stream(spark, sf_dir, "events"), "ts")


def as_responses(events: DataFrame) -> DataFrame:
    """The observations as landed answers, some of them failed in each possible way."""
    obs = as_observations(events, "ts")
    fields = [F.col(name).alias(source) for source, name in S.RESPONSE_FIELDS.items()]
    whole = F.struct(F.struct(*fields).alias("current"))
    partial = F.struct(F.struct(*fields[1:]).alias("current"))
    stamp = F.col("timestamp")
    # JSON text may end in any white space.
    ending = F.get(F.array(F.lit(""), F.lit("\n"), F.lit("\r\n"), F.lit("\t")), (F.col("event_id") % 4).cast("int"))
    return obs.select(
        "event_id",
        F.when(F.col("weather_code") == 17, "XXX").otherwise(F.col("kode_kota")).alias("kode"),
        F.when(stamp.isNull(), None)
        .when(stamp == "garbage", "not json")
        .when(F.col("weather_code") == 13, '{"error":true}')
        .when(F.col("temperature").isNull() & (F.col("weather_code") > 50), F.to_json(partial))
        .when(F.col("weather_code") == 17, F.to_json(whole, KEEP_NULLS))
        .otherwise(F.concat(F.to_json(whole, KEEP_NULLS), ending))
        .alias("body"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_responses(read(spark, sf_dir, "events"))


def responses_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_responses(read_stream(spark, sf_dir, "events"))


def _arrival(seconds: Column) -> Column:
    return F.timestamp_seconds(F.lit(FIRST_ARRIVAL) + seconds)


def poll_of(doc_id: Column) -> Column:
    return F.floor(doc_id / DOCS_PER_POLL)


def as_candidates(documents: DataFrame) -> DataFrame:
    """Documents as feed entries in arrival order; links repeat, some are empty."""
    n = F.col("doc_id")
    return documents.select(
        "doc_id",
        F.when(n % 50 == 0, "")
        .otherwise(F.concat(F.lit("https://news.example/"), (n % 700).cast("string")))
        .alias("link"),
        prefix(F.col("text"), S.PREVIEW_TITLE_CHARS).alias("title"),
        F.col("text").alias("description"),
        F.date_format(_arrival(n * 60), "EEE, dd MMM yyyy HH:mm:ss Z").alias("pubDate"),
        F.col("source").alias("feed_title"),
        F.concat(F.lit("https://feed.example/"), "source", F.lit(".xml")).alias("feed_url"),
        _arrival(poll_of(n) * S.POLL_NEWS_SECONDS).alias("fetched_at"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_candidates(read(spark, sf_dir, "documents"))


def _polled(entries: DataFrame, *columns: str | Column) -> DataFrame:
    """Entries listed by poll and feed, at most DOCS_PER_POLL, and the feed's number."""
    entry = F.struct("doc_id", F.struct(*columns).alias("e"))
    items = F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["e"])
    grouped = entries.groupBy("feed_url", "fetched_at", "feed_title").agg(items.alias("item"))
    number = F.regexp_extract("feed_title", r"(\d+)$", 1).try_cast("int")
    return grouped.withColumn("feed_ord", number)


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries as feed documents, one per feed and poll."""
    channel = F.struct(F.col("feed_title").alias("title"), "item")
    return _polled(candidates(spark, sf_dir), *ENTRY_COLUMNS).select(
        "feed_ord",
        "feed_url",
        F.to_xml(F.struct(channel.alias("channel")), {"rowTag": "rss"}).alias("xml"),
        "fetched_at",
    )


def atom_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``feeds`` in Atom. An entry's link is not its first, or its id; its text is its
    summary or its content."""
    n = F.col("doc_id")

    def link(rel: str | None, href: Column) -> Column:
        return F.struct(F.lit(rel).alias("_rel"), F.lit(None).cast("string").alias("_type"), href.alias("_href"))

    links = F.array(
        link("self", F.concat("link", F.lit("?self"))),
        F.when(n % 4 == 1, link(None, F.col("link"))).when(n % 4 > 1, link("alternate", F.col("link"))),
    )
    entry = {
        "id": F.when(n % 4 == 0, F.col("link")).otherwise(F.lit("urn:no-page")),
        "title": F.col("title"),
        "link": F.filter(links, lambda x: x.isNotNull()),
        "summary": F.when(n % 3 != 0, F.col("description")),
        "content": F.when(n % 3 == 0, F.col("description")).otherwise("not this"),
        "published": F.date_format(_arrival(n * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    polled = _polled(candidates(spark, sf_dir), *(value.alias(name) for name, value in entry.items()))
    feed = F.struct(F.lit(S.ATOM).alias("_xmlns"), F.col("feed_title").alias("title"), F.col("item").alias("entry"))
    return polled.select(
        "feed_ord", "feed_url", F.to_xml(feed, {"rowTag": "feed"}).alias("xml"), "fetched_at"
    )

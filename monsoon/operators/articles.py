"""Feed entries to articles: defaults, first-seen, previews, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.functions.clock import iso_text, published_time
from monsoon.functions.text import prefix


def as_articles(
    entries: DataFrame, *keep: str, summary_chars: int = S.SUMMARY_CHARS
) -> DataFrame:
    """Entries in the shape of an article, absent fields defaulted."""
    fetched = iso_text(F.col("fetched_at"))
    empty = F.lit("")
    return entries.select(
        *keep,
        F.coalesce("title", empty).alias("judul"),
        F.coalesce("link", empty).alias("link"),
        prefix(F.coalesce("description", empty), summary_chars).alias("ringkasan"),
        F.coalesce("pubDate", fetched).alias("waktu_terbit"),
        F.coalesce("feed_title", "feed_url").alias("sumber"),
        fetched.alias("timestamp"),
    )


def with_link(articles: DataFrame) -> DataFrame:
    """Articles that can be identified: neither absent nor empty link."""
    return articles.filter(F.col("link") != "")


def first_per_group(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group.

    Spark limits each group within every task before the shuffle, so a group holding
    a large part of the rows sends at most n rows per task.
    """
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def first_seen(articles: DataFrame, order: list) -> DataFrame:
    """The first article of each link in arrival order."""
    return first_per_group(with_link(articles), ["link"], order, 1)


def not_sent_before(articles: DataFrame, history: DataFrame, order: list) -> DataFrame:
    """Articles whose link is not in the history, one per link.

    Both sides are reduced to one row per link first: no link is heavy in the join,
    and the join reuses the partitioning of that reduction.
    """
    sent = history.select("link").distinct()
    return first_seen(articles, order).join(sent, "link", "left_anti")


def new_per_poll(articles: DataFrame, poll: Column) -> DataFrame:
    """Number of links first seen in each poll; a poll without any counts 0."""
    polled = articles.select(poll.alias("poll"), "link")
    firsts = with_link(polled).groupBy("link").agg(F.min("poll").alias("poll"))
    return (
        firsts.select("poll", F.lit(1).alias("baru"))
        .unionByName(polled.select("poll", F.lit(0).alias("baru")))
        .groupBy("poll")
        .agg(F.sum("baru").alias("artikel_baru"))
    )


def preview(entries: DataFrame, feed: list[str], order: list, n: int = S.PREVIEW_ENTRIES) -> DataFrame:
    """First entries of each feed in document order; repeats and empty links stay."""
    return first_per_group(entries, feed, order, n)


def latest_news(articles: DataFrame, k: int) -> DataFrame:
    """The k most recently published articles, a report of fixed length."""
    published = published_time(F.col("waktu_terbit"))
    return (
        articles.withColumn("_published", published)
        .orderBy(F.col("_published").desc_nulls_last(), "link")
        .limit(k)
        .drop("_published")
    )

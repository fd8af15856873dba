"""The registered queries, each over the whole of the tables it reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon import schemas as S
from monsoon.functions.clock import iso_text, published_time
from monsoon.functions.text import article_line, key_text, link_key, observation_line
from monsoon.functions.wire import json_text
from monsoon.operators import analyses as A
from monsoon.operators import articles as N
from monsoon.operators import observations as O
from monsoon.operators import report as R
from monsoon.operators.current import current_conditions
from monsoon.operators.history import LinkHistory
from monsoon.plans import tables
from monsoon.plans.analyse import CITIES, CURRENT, DOCUMENT, NEWS, analyse
from monsoon.session import scratch, stateful, using
from monsoon.sinks.bus import answer_messages, identified, news_messages, publish, to_messages, weather_messages
from monsoon.sinks.results import curate_stream, write_json
from monsoon.sources.bus import message_rejects, messages, once, peek, read_topic
from monsoon.sources.feeds import feed_entries, feed_rejects, feed_summaries
from monsoon.sources.inventory import count_stream, counted_files, inventory, stored_files, with_counts
from monsoon.sources.weather import (
    curated_weather,
    weather_files,
    weather_of_any_layout,
    weather_records_stream,
    weather_rejects,
)
from monsoon.streaming.dedup import first_seen_stream
from monsoon.streaming.monitor import BatchCounts, stored_counts
from monsoon.streaming.publish import publish_stream
from monsoon.streaming.store import store_stream
from monsoon.streaming.triggers import DRAIN

Query = Callable[[SparkSession, str], DataFrame]

ARRIVAL = ["doc_id"]
EVENT_ID = S.shape(event_id=S.WHOLE)
DOC_ID = S.shape(doc_id=S.WHOLE)
EVENT = T.StructType([*EVENT_ID.fields, *S.OBSERVATION.fields])
NUMBERED_ARTICLE = T.StructType([*DOC_ID.fields, *S.ARTICLE.fields])

# Landed one after the other, each a batch of its own.
PIECES = 5

# How long a link is remembered where that is bounded: nine polls.
PERIOD = "45 minutes"


def _over_observations(analysis: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: analysis(tables.observations(spark, sf_dir))


def _over_report(result: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: result(R.report_rows(tables.observations(spark, sf_dir)))


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.as_articles(tables.candidates(spark, sf_dir), "doc_id")


# --- Landed answers -------------------------------------------------------------


def observations_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.observations(O.checked_responses(tables.responses(spark, sf_dir)), "event_id")


def rejected_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.rejected(O.checked_responses(tables.responses(spark, sf_dir)), "event_id")


# --- News -----------------------------------------------------------------------


def articles_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.with_link(_articles(spark, sf_dir))


def articles_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = N.first_seen(_articles(spark, sf_dir), ARRIVAL)
    return first.withColumn("kunci", link_key(F.col("link")))


def articles_new_vs_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the arrivals against the earlier half."""
    articles = _articles(spark, sf_dir)
    documents = tables.read(spark, sf_dir, "documents")
    middle = documents.agg(F.floor((F.max("doc_id") + 1) / 2)).scalar()
    history = articles.filter(F.col("doc_id") < middle)
    return N.not_sent_before(articles.filter(F.col("doc_id") >= middle), history, ARRIVAL)


def articles_new_vs_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half against the links stored of the earlier one, in buckets."""
    articles = _articles(spark, sf_dir)
    middle = articles.agg(F.floor((F.max("doc_id") + 1) / 2)).scalar()
    history = LinkHistory(spark, scratch(spark, "history"), buckets=32)
    history.take(articles.filter(F.col("doc_id") < middle), ARRIVAL, "earlier")
    return history.take(articles.filter(F.col("doc_id") >= middle), ARRIVAL, "later")


def articles_new_per_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.new_per_poll(_articles(spark, sf_dir), tables.poll_of(F.col("doc_id")))


def feed_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three entries of each feed as the preview shows them."""
    entries = tables.candidates(spark, sf_dir)
    shown = N.as_articles(entries, "doc_id", summary_chars=S.PREVIEW_SUMMARY_CHARS)
    return N.preview(shown, ["sumber"], ARRIVAL)


def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("doc_id", article_line().alias("baris"))


def published_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = published_time(F.col("waktu_terbit"))
    return _articles(spark, sf_dir).select("doc_id", iso_text(published).alias("terbit"))


def latest_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.latest_news(N.first_seen(_articles(spark, sf_dir), ARRIVAL), S.LATEST_NEWS)


def feed_entries_from_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = feed_entries(tables.feeds(spark, sf_dir))
    return N.as_articles(entries, "feed_ord", "pos")


def feed_entries_of_both_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of even feeds in RSS, of odd ones in Atom, read as one frame."""
    odd = F.col("feed_ord") % 2 == 1
    raw = tables.feeds(spark, sf_dir).filter(~odd).unionByName(tables.atom_feeds(spark, sf_dir).filter(odd))
    return N.as_articles(feed_entries(raw), "feed_ord", "pos")


def feed_entry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_summaries(tables.feeds(spark, sf_dir)).withColumn(
        "fetched_at", iso_text(F.col("fetched_at"))
    )


# --- Bus and stored files -------------------------------------------------------


def _weather_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "bus")
    events = tables.as_observations(tables.read(spark, sf_dir, "events"), "ts")
    publish(weather_messages(events, F.col("ts"), extra=("event_id",)), path)
    return read_topic(spark, S.TOPIC_WEATHER, path)


def bus_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(_weather_bus(spark, sf_dir), EVENT)


def bus_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peek(_weather_bus(spark, sf_dir))


def messages_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are no JSON, through the bus."""
    path = scratch(spark, "bus")
    events = tables.as_observations(tables.read(spark, sf_dir, "events"), "ts")
    text = F.concat(F.lit("not json "), F.col("event_id"))
    value = F.when(F.col("timestamp") == "garbage", text).otherwise(json_text(*EVENT.names))
    topic = F.lit(S.TOPIC_WEATHER)
    publish(to_messages(events, topic, F.col("kode_kota"), value, F.col("ts")), path)
    return message_rejects(read_topic(spark, S.TOPIC_WEATHER, path), EVENT)


def article_bus_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "bus")
    entries = N.as_articles(tables.candidates(spark, sf_dir), "doc_id", "fetched_at")
    first = N.first_seen(entries, ARRIVAL)
    publish(news_messages(first, F.col("fetched_at"), extra=("doc_id",)), path)
    bus = read_topic(spark, S.TOPIC_NEWS, path)
    return messages(bus, NUMBERED_ARTICLE, "key").withColumn("key", key_text(F.col("key")))


def results_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "json")
    write_json(tables.observations(spark, sf_dir), path)
    return weather_files(spark, path, extra=EVENT_ID)


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What does not depend on how the rows were put in files: all rows are in files, and
    all files have a size and a time."""
    path = scratch(spark, "json")
    write_json(tables.observations(spark, sf_dir), path)
    files = stored_files(spark, path).filter(~F.col("path").like("%/_SUCCESS"))
    return _inventory_summary(inventory(files, weather_files(spark, path)))


def _inventory_summary(listed: DataFrame) -> DataFrame:
    sized = (F.col("length") > 0) & F.col("modificationTime").isNotNull()
    return listed.agg(
        (F.count(F.lit(1)) > 0).alias("ada_file"),
        F.coalesce(F.bool_and(sized | (F.col("jumlah_event") == 0)), F.lit(True)).alias("lengkap"),
        F.coalesce(F.sum("jumlah_event"), F.lit(0)).alias("jumlah_event"),
    )


def file_inventory_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of files that came in two parts and were counted as they came."""
    path = scratch(spark, "kept")
    events = tables.observations(spark, sf_dir)
    for rest in range(2):
        events.filter(F.col("event_id") % 2 == rest).write.mode("append").json(f"{path}/json")
        records = weather_records_stream(spark, f"{path}/json")
        count_stream(records, f"{path}/counts").awaitTermination()
    files = stored_files(spark, f"{path}/json").filter(~F.col("path").like("%/_SUCCESS"))
    return _inventory_summary(with_counts(files, counted_files(spark, f"{path}/counts")))


# Most records in a document over several lines.
IN_DOCUMENT = 5000


def _both_layouts(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Every other row as a line, the rest in documents over several lines."""
    events = tables.observations(spark, sf_dir)
    odd = F.col("event_id") % 2 == 1
    write_json(events.filter(odd), f"{path}/piece=-1")
    shown = {"pretty": "true", "ignoreNullFields": "false"}
    records = F.to_json(F.collect_list(F.struct(*EVENT.names)), shown)
    whole = events.filter(~odd).groupBy(F.floor(F.col("event_id") / IN_DOCUMENT).alias("piece"))
    whole.agg(records.alias("value")).write.mode("append").partitionBy("piece").text(path)


def mixed_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "mixed")
    _both_layouts(spark, sf_dir, path)
    rows, _ = weather_of_any_layout(spark, path, extra=EVENT_ID)
    return rows.drop("piece")


def mixed_layouts_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of both layouts through the stream that curates them."""
    path = scratch(spark, "mixed")
    _both_layouts(spark, sf_dir, f"{path}/json")
    records = weather_records_stream(spark, f"{path}/json/*")
    curate_stream(records, f"{path}/days", f"{path}/rejects").awaitTermination()
    return curated_weather(spark, f"{path}/days").drop("ts_obj", "event_date")


def weather_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of stored files that cannot be read."""
    path = scratch(spark, "lines")
    text = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(', "kode_kota'))
    line = F.when(F.col("timestamp") == "garbage", text).otherwise(json_text(*EVENT.names))
    tables.observations(spark, sf_dir).select(line.alias("value")).write.text(path)
    return weather_rejects(spark, path).select("isi")


def feeds_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed documents of which every third feed's are cut off."""
    cut = F.left("xml", F.length("xml") - 9)
    broken = tables.feeds(spark, sf_dir).withColumn(
        "xml", F.when(F.col("feed_ord") % 3 == 0, cut).otherwise(F.col("xml"))
    )
    return feed_rejects(broken).select("feed_url", "fetched_at", "alasan")


def stored_rows_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated in two runs, the second of which adds to the first."""
    path = scratch(spark, "curated")
    events = tables.observations(spark, sf_dir)
    for rest in range(2):
        events.filter(F.col("event_id") % 2 == rest).write.mode("append").json(f"{path}/json")
        records = weather_records_stream(spark, f"{path}/json")
        curate_stream(records, f"{path}/days", f"{path}/rejects").awaitTermination()
    day = F.col("event_date").cast("string").alias("event_date")
    stored = curated_weather(spark, f"{path}/days")
    return stored.groupBy(day).agg(F.count(F.lit(1)).alias("jumlah_event"))


def _analysed(spark: SparkSession, sf_dir: str, news: bool = False) -> str:
    path = scratch(spark, "hasil")
    articles = N.first_seen(_articles(spark, sf_dir), ARRIVAL).drop("doc_id") if news else None
    analyse(tables.observations(spark, sf_dir), path, articles)
    return path


def stored_city_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [f for f in S.OBSERVATION if f.name in A.CITY]
    measures = S.shape(
        suhu_avg=S.REAL, suhu_tertinggi=S.REAL, suhu_terendah=S.REAL, jumlah_event=S.WHOLE
    )
    schema = T.StructType([*fields, *measures])
    return spark.read.schema(schema).json(f"{_analysed(spark, sf_dir)}/{CITIES}")


def stored_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_analysed(spark, sf_dir)}/{DOCUMENT}"
    return spark.read.text(path).withColumnRenamed("value", "dokumen")


def stored_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = S.shape(waktu=S.TEXT, warna=S.TEXT, ekstrem=T.BooleanType())
    schema = T.StructType([*S.OBSERVATION.fields[:-1], *shown.fields])
    return spark.read.schema(schema).json(f"{_analysed(spark, sf_dir)}/{CURRENT}")


def stored_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(S.ARTICLE).json(f"{_analysed(spark, sf_dir, news=True)}/{NEWS}")


# --- Streams, drained -----------------------------------------------------------


def _pieces(df: DataFrame, number: str) -> list[DataFrame]:
    """The rows in PIECES by their number, each row in one of them. Ranges of the number are
    pushed to the files, so that a piece is read without the others."""
    n = F.col(number)
    top = (df.agg(F.max(number)).first()[0] or 0) + 1
    bounds = [-(-piece * top // PIECES) for piece in range(1, PIECES)]
    inner = [(n >= low) & (n < high) for low, high in zip(bounds, bounds[1:])]
    own = [n.isNull() | (n < bounds[0]), *inner, n >= bounds[-1]]
    return [df.filter(rows) for rows in own]


def _landed_in_pieces(df: DataFrame, number: str, path: str, run: Callable[[], None]) -> None:
    """Land the rows in PIECES by their number, and run after each."""
    for piece in _pieces(df, number):
        piece.write.mode("append").parquet(path)
        run()


def _stream_answers(spark: SparkSession, sf_dir: str) -> str:
    """Landed answers to the bus as one stream."""
    path = scratch(spark, "answers")
    checked = O.checked_responses(tables.responses_stream(spark, sf_dir))
    publish_stream(
        answer_messages(checked, extra=("event_id",)), f"{path}/checkpoint", f"{path}/bus"
    ).awaitTermination()
    return f"{path}/bus"


def stream_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bus = read_topic(spark, S.TOPIC_WEATHER, _stream_answers(spark, sf_dir))
    return messages(bus, EVENT)


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    bus = read_topic(spark, S.TOPIC_REJECTED, _stream_answers(spark, sf_dir))
    return messages(bus, T.StructType([*EVENT_ID.fields, *S.REJECTED.fields]))


def stream_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to the bus, the bus to JSON files, two streams with their own position."""
    path = scratch(spark, "store")
    events = tables.observations_stream(spark, sf_dir)
    publish_stream(
        weather_messages(events, F.col("ts"), extra=("event_id",)),
        f"{path}/bus-checkpoint",
        f"{path}/bus",
    ).awaitTermination()
    bus = read_topic(spark, S.TOPIC_WEATHER, f"{path}/bus", stream=True)
    store_stream(
        messages(bus, EVENT), f"{path}/api", f"{path}/api-checkpoint", trigger=DRAIN
    ).awaitTermination()
    return weather_files(spark, f"{path}/api", extra=EVENT_ID)


def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part that was sent twice, as a broker's writer does after a failure, stored once."""
    path = scratch(spark, "once")
    events = tables.as_observations(tables.read(spark, sf_dir, "events"))
    sent = identified(weather_messages(events, F.current_timestamp(), extra=("event_id",)), "part")
    for copy in ("first", "again"):
        if copy == "first":
            publish(sent, f"{path}/bus", part=copy)
        else:
            publish(read_topic(spark, S.TOPIC_WEATHER, f"{path}/bus"), f"{path}/bus", part=copy)
        bus = once(read_topic(spark, S.TOPIC_WEATHER, f"{path}/bus", stream=True))
        with using(spark, stateful(spark)):
            store_stream(messages(bus, EVENT), f"{path}/api", f"{path}/checkpoint", DRAIN).awaitTermination()
    return weather_files(spark, f"{path}/api", extra=EVENT_ID)


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored in several runs, each going on from the position of the one before."""
    path = scratch(spark, "resumed")
    events = tables.as_observations(tables.read(spark, sf_dir, "events"))

    def run() -> None:
        landed = spark.readStream.schema(events.schema).parquet(f"{path}/landed")
        store_stream(landed, f"{path}/api", f"{path}/checkpoint", trigger=DRAIN).awaitTermination()

    _landed_in_pieces(events, "event_id", f"{path}/landed", run)
    return weather_files(spark, f"{path}/api", extra=EVENT_ID)


def _first_seen(
    spark: SparkSession, sf_dir: str, path: str, forward=None, within: str | None = None, counts: str | None = None
) -> DataFrame:
    """Articles landed and taken in piece by piece, the stream restarted for each."""
    entries = tables.candidates(spark, sf_dir)

    def run() -> None:
        landed = spark.readStream.schema(entries.schema).parquet(f"{path}/landed")
        articles = N.as_articles(landed, "doc_id", "fetched_at")
        query = first_seen_stream(articles, f"{path}/sent", ARRIVAL, DRAIN, forward, "berita", within)
        query.awaitTermination()
        if counts:
            BatchCounts(None, spark, counts).catch_up(query)

    _landed_in_pieces(entries, "doc_id", f"{path}/landed", run)
    return spark.read.parquet(f"{path}/sent").drop("batch", "fetched_at")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_seen(spark, sf_dir, scratch(spark, "dedup")).select("link")


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_seen(spark, sf_dir, scratch(spark, "first-seen"))


def stream_dedup_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each link once in every period, the links of past periods forgotten."""
    return _first_seen(spark, sf_dir, scratch(spark, "within"), within=PERIOD)


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch took in and how many links were new, as stored while it ran."""
    path = scratch(spark, "counted")
    _first_seen(spark, sf_dir, path, counts=f"{path}/batches")
    return stored_counts(spark, f"{path}/batches").select("stream", "jumlah_event", "artikel_baru")


def pipeline_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather and news sent to one bus by turns, and the news stored from it."""
    path = scratch(spark, "news")
    bus = f"{path}/bus"
    events = tables.observations_stream(spark, sf_dir)

    def forward(new: DataFrame, part: str) -> None:
        publish(news_messages(new, F.col("fetched_at")), bus, part=part)

    publish_stream(weather_messages(events, F.col("ts")), f"{path}/w", bus).awaitTermination()
    _first_seen(spark, sf_dir, path, forward)
    read = read_topic(spark, S.TOPIC_NEWS, bus, stream=True)
    store_stream(messages(read, S.ARTICLE), f"{path}/rss", f"{path}/s", DRAIN).awaitTermination()
    return spark.read.schema(S.ARTICLE).json(f"{path}/rss")


def registry() -> dict[str, Query]:
    return {
        "city_temperature_stats": _over_observations(A.city_temperatures),
        "city_temperature_by_name": _over_observations(
            lambda df: A.city_temperatures(df, A.CITY_NAME, digits=6, with_count=False)
        ),
        "total_events": _over_observations(A.total_events),
        "extreme_events": _over_observations(A.extreme_events),
        "extreme_by_city": _over_observations(A.extreme_by_city),
        "extreme_by_name": _over_observations(lambda df: A.extreme_by_city(df, A.CITY_NAME)),
        "extreme_total": _over_observations(A.extreme_total),
        "hourly_trend": _over_observations(A.hourly_trend),
        "hourly_trend_with_null": _over_observations(
            lambda df: A.hourly_trend_with_null(df, digits=6)
        ),
        "hottest_city": _over_observations(A.hottest_city),
        "most_extreme_city": _over_observations(A.most_extreme_city),
        "coldest_hour": _over_observations(A.coldest_hour),
        "flush_batch_counts": _over_observations(A.flush_batches),
        "current_temperature": _over_observations(lambda df: current_conditions(df, "event_id")),
        "observation_lines": _over_observations(
            lambda df: df.select("event_id", observation_line().alias("baris"))
        ),
        "report_city_rows": _over_report(R.city_rows),
        "report_hour_rows": _over_report(R.hour_rows),
        "report_totals": _over_report(R.totals),
        "insight_sentences": _over_report(R.insights),
        "dashboard_document": _over_report(R.dashboard_document),
        "observations_from_raw": observations_from_raw,
        "rejected_raw": rejected_raw,
        "articles_normalized": articles_normalized,
        "articles_first_seen": articles_first_seen,
        "articles_new_vs_history": articles_new_vs_history,
        "articles_new_vs_stored": articles_new_vs_stored,
        "articles_new_per_poll": articles_new_per_poll,
        "feed_preview": feed_preview,
        "article_lines": article_lines,
        "published_times": published_times,
        "latest_news": latest_news,
        "feed_entries_from_xml": feed_entries_from_xml,
        "feed_entries_of_both_kinds": feed_entries_of_both_kinds,
        "feed_entry_counts": feed_entry_counts,
        "bus_roundtrip": bus_roundtrip,
        "bus_peek": bus_peek,
        "article_bus_roundtrip": article_bus_roundtrip,
        "results_json_roundtrip": results_json_roundtrip,
        "file_inventory": file_inventory,
        "file_inventory_kept": file_inventory_kept,
        "mixed_layouts": mixed_layouts,
        "mixed_layouts_curated": mixed_layouts_curated,
        "weather_rejected": weather_rejected,
        "messages_rejected": messages_rejected,
        "feeds_rejected": feeds_rejected,
        "stored_rows_per_day": stored_rows_per_day,
        "stored_city_results": stored_city_results,
        "stored_document": stored_document,
        "stored_current": stored_current,
        "stored_news": stored_news,
        "stream_observations": stream_observations,
        "stream_rejected": stream_rejected,
        "stream_store": stream_store,
        "stream_once": stream_once,
        "stream_resumed": stream_resumed,
        "stream_dedup": stream_dedup,
        "stream_first_seen": stream_first_seen,
        "stream_dedup_within": stream_dedup_within,
        "stream_batch_counts": stream_batch_counts,
        "pipeline_news": pipeline_news,
    }

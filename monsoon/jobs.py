"""The jobs: ``python -m monsoon.jobs <command> ...``, or the same file by spark-submit
with this package on the Python path."""

from __future__ import annotations

import argparse
import signal
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monsoon import schemas as S
from monsoon.operators import report as R
from monsoon.operators.articles import as_articles
from monsoon.operators.observations import checked_responses
from monsoon.plans.analyse import analyse
from monsoon.session import session, stateful, using, widen_for
from monsoon.sinks.bus import answer_messages, news_messages, publish
from monsoon.sinks.results import curate_stream, display, print_rows, write_json
from monsoon.sources.bus import heads, message_lines, message_rejects, messages, once, peek, read_topic
from monsoon.sources.feeds import feed_entries, feed_rejects, landed_feeds_stream
from monsoon.sources.inventory import count_stream, counted_files, inventory, stored_files, with_counts
from monsoon.sources.weather import (
    curated_weather,
    landed_responses_stream,
    weather_files,
    weather_of_any_layout,
    weather_records_stream,
    weather_rejects,
    wrong_layout,
)
from monsoon.streaming import triggers
from monsoon.streaming.dedup import first_seen_stream
from monsoon.streaming.pipeline import run_together
from monsoon.streaming.publish import publish_stream
from monsoon.streaming.store import store_stream

TOPICS = {S.TOPIC_WEATHER: S.OBSERVATION, S.TOPIC_NEWS: S.ARTICLE, S.TOPIC_REJECTED: S.REJECTED}

# Ending of the directory with what an input could not be read from.
REJECTS = "-ditolak"


def _stop_on_several_documents(spark: SparkSession, path: str) -> None:
    wrong = wrong_layout(spark, path, multi_line=True).limit(1).collect()
    if wrong:
        sys.exit(f"{wrong[0].path}: {wrong[0].alasan}; leave out --indented")


def _report_rejects(rejects: DataFrame, path: str) -> None:
    write_json(rejects, path)
    n = rejects.sparkSession.read.schema(rejects.schema).json(path).count()
    print(f"{n} ditolak: {path}")


def run_analyse(spark: SparkSession, args: argparse.Namespace) -> None:
    widen_for(spark, args.input)
    if args.curated:
        stored = curated_weather(spark, args.input)
        if args.since:
            stored = stored.filter(F.col("event_date") >= F.lit(args.since).cast("date"))
        if args.until:
            stored = stored.filter(F.col("event_date") <= F.lit(args.until).cast("date"))
    elif args.indented:
        _stop_on_several_documents(spark, args.input)
        stored = weather_files(spark, args.input, multi_line=True)
        rejects = weather_rejects(spark, args.input, multi_line=True)
    else:
        stored, rejects = weather_of_any_layout(spark, args.input)
    news = spark.read.schema(S.ARTICLE).json(args.news) if args.news else None
    rows = analyse(stored, args.output, news)
    for result in (R.totals(rows), R.city_rows(rows), R.extreme_rows(rows), R.hour_rows(rows)):
        display(result)
    display(R.insights(rows))
    if not args.curated:
        _report_rejects(rejects, f"{args.output}/ditolak")


def run_curate(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    widen_for(spark, args.input)
    records = weather_records_stream(spark, args.input, args.max_files)
    return [curate_stream(records, args.output, f"{args.output}{REJECTS}")]


def publish_weather(spark, landed, bus, servers, checkpoint, trigger, max_files) -> StreamingQuery:
    checked = checked_responses(landed_responses_stream(spark, landed, max_files))
    return publish_stream(answer_messages(checked), checkpoint, bus, servers, trigger, "ProducerAPI")


def publish_news(spark, landed, sent, bus, servers, trigger, max_files) -> StreamingQuery:
    order = ["fetched_at", "feed_ord", "pos"]
    entries = feed_entries(landed_feeds_stream(spark, landed, max_files))

    def forward(new, part):
        publish(news_messages(new, F.col("fetched_at")), bus, servers, part)

    return first_seen_stream(
        as_articles(entries, *order), sent, order, trigger, forward, "ProducerRSS"
    )


def feeds_refused(spark, landed, path, trigger, max_files) -> StreamingQuery:
    refused = feed_rejects(landed_feeds_stream(spark, landed, max_files))
    return store_stream(refused, path, f"{path}/_checkpoint", trigger, "RejectedRSS")


def store_topic(spark, topic, path, bus, servers, checkpoint, trigger, most, repeats=False) -> StreamingQuery:
    """A broker may hold messages twice; the file-backed bus only where asked for."""
    read = read_topic(spark, topic, bus, servers, stream=True, max_per_trigger=most)
    events = messages(once(read) if servers or repeats else read, TOPICS[topic])
    with using(spark, stateful(spark)):
        return store_stream(events, path, checkpoint, trigger, f"Store-{topic}")


def messages_refused(spark, topic, path, bus, servers, checkpoint, trigger, most) -> StreamingQuery:
    read = read_topic(spark, topic, bus, servers, stream=True, max_per_trigger=most)
    refused = message_rejects(read, TOPICS[topic])
    return store_stream(refused, path, checkpoint, trigger, f"Rejected-{topic}")


def run_publish_weather(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    trigger = triggers.DRAIN if args.drain else triggers.POLL_WEATHER
    return [
        publish_weather(
            spark, args.input, args.bus, args.servers, args.checkpoint, trigger, args.max_files
        )
    ]


def run_publish_news(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    trigger = triggers.DRAIN if args.drain else triggers.POLL_NEWS
    return [
        publish_news(spark, args.input, args.sent, args.bus, args.servers, trigger, args.max_files),
        feeds_refused(spark, args.input, f"{args.sent}{REJECTS}", trigger, args.max_files),
    ]


def run_store(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    trigger = triggers.DRAIN if args.drain else triggers.FLUSH
    where = args.bus, args.servers
    return [
        store_topic(
            spark, args.topic, args.output, *where, args.checkpoint, trigger, args.max_files, args.once
        ),
        messages_refused(
            spark, args.topic, f"{args.output}{REJECTS}", *where,
            f"{args.checkpoint}{REJECTS}", trigger, args.max_files,
        ),
    ]


def run_run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Both paths from landed inputs to stored files, each stream with its own position."""
    data, where, most = args.data, (args.bus, args.servers), args.max_files
    check = f"{data}/_checkpoints"

    def every(trigger: dict) -> dict:
        return {"processingTime": f"{args.every} seconds"} if args.every else trigger

    starts = {
        "ProducerAPI": (
            lambda t: publish_weather(spark, args.answers, *where, f"{check}/api", t, most),
            every(triggers.POLL_WEATHER),
        ),
        "ProducerRSS": (
            lambda t: publish_news(spark, args.feeds, f"{data}/sent", *where, t, most),
            every(triggers.POLL_NEWS),
        ),
        "RejectedRSS": (
            lambda t: feeds_refused(spark, args.feeds, f"{data}/rss{REJECTS}", t, most),
            every(triggers.POLL_NEWS),
        ),
    }
    for topic, name in (
        (S.TOPIC_WEATHER, "api"),
        (S.TOPIC_NEWS, "rss"),
        (S.TOPIC_REJECTED, f"answers{REJECTS}"),
    ):
        starts[f"Store-{topic}"] = (
            lambda t, topic=topic, name=name: store_topic(
                spark, topic, f"{data}/{name}", *where, f"{check}/store-{name}", t, most
            ),
            every(triggers.FLUSH),
        )
        starts[f"Rejected-{topic}"] = (
            lambda t, topic=topic, name=name: messages_refused(
                spark, topic, f"{data}/messages{REJECTS}/{topic}", *where,
                f"{check}/rejects-{name}", t, most,
            ),
            every(triggers.FLUSH),
        )
    signal.signal(signal.SIGTERM, signal.default_int_handler)
    run_together(spark, starts, args.seconds, store=f"{data}/batches")


def run_peek(spark: SparkSession, args: argparse.Namespace) -> None:
    bus = read_topic(spark, args.topic, args.bus, args.servers)
    # A broker serves each partition from its earliest message, so reading can just stop.
    shown = heads(bus.limit(args.n)) if args.servers else peek(bus, args.n)
    print_rows(message_lines(shown))


def run_files(spark: SparkSession, args: argparse.Namespace) -> None:
    files = stored_files(spark, args.path)
    if args.counts:
        records = weather_records_stream(spark, args.path, args.max_files)
        count_stream(records, args.counts).awaitTermination()
        found = with_counts(files, counted_files(spark, args.counts))
    else:
        found = inventory(files, weather_files(spark, args.path))
    print_rows(found.orderBy("path"))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="monsoon", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, run, *paths, bus=False, stream=False, checkpoint=True):
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(path)
        if bus:
            where = sub.add_mutually_exclusive_group(required=True)
            where.add_argument("--bus", help="directory of the file-backed bus")
            where.add_argument("--servers", help="address of a Kafka broker")
        if stream:
            if checkpoint:
                sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--drain", action="store_true", help="handle what is there, then stop")
            sub.add_argument("--max-files", type=int, help="most files (messages) in a batch")
        return sub

    analysis = command("analyse", run_analyse, "input", "output")
    analysis.add_argument("--curated", action="store_true", help="input written by curate")
    analysis.add_argument("--since", help="first day of curated input")
    analysis.add_argument("--until", help="last day of curated input")
    analysis.add_argument("--indented", action="store_true", help="every file is one document over several lines")
    analysis.add_argument("--news", help="stored articles, for the latest news")
    curate = command("curate", run_curate, "input", "output")
    curate.add_argument("--max-files", type=int)
    command("publish-weather", run_publish_weather, "input", bus=True, stream=True)
    command("publish-news", run_publish_news, "input", "sent", bus=True, stream=True, checkpoint=False)
    store = command("store", run_store, "output", bus=True, stream=True)
    store.add_argument("--topic", choices=TOPICS, required=True)
    store.add_argument("--once", action="store_true", help="drop messages sent again (always with --servers)")
    both = command("run", run_run, "answers", "feeds", "data", bus=True)
    both.add_argument("--seconds", type=float, help="stop after so long; default: when interrupted")
    both.add_argument("--every", type=float, help="seconds between batches, for all streams")
    both.add_argument("--max-files", type=int, help="most files (messages) in a batch")
    look = command("peek", run_peek, bus=True)
    look.add_argument("--topic", choices=TOPICS, required=True)
    look.add_argument("-n", type=int, default=S.PEEK_MESSAGES)
    files = command("files", run_files, "path")
    files.add_argument("--counts", help="where rows per file are kept, so that only new files are read")
    files.add_argument("--max-files", type=int, help="most files counted in a batch")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session(f"monsoon-{args.command}")
    for query in args.run(spark, args) or ():
        query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])

"""The streaming paths: batch = stream, restart, drain, dedup."""

from __future__ import annotations

import json
import re
import time

import pytest
from pyspark.errors import StreamingQueryException
from conftest import FIELDS, OBSERVATIONS, tuples
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.operators import articles as N
from monsoon.plans.queries import _pieces
from monsoon.session import using
from monsoon.sinks.bus import identified, news_messages, publish, weather_messages
from monsoon.sources.bus import messages, once, read_topic
from monsoon.sources.weather import weather_files
from monsoon.streaming import triggers
from monsoon.streaming.dedup import first_seen_stream
from monsoon.streaming.monitor import BatchCounts, status_lines, stored_counts
from monsoon.streaming.pipeline import run_together
from monsoon.streaming.publish import publish_stream
from monsoon.streaming.store import store_stream

ARTICLES = S.shape(poll=S.WHOLE, pos=S.WHOLE, link=S.TEXT, judul=S.TEXT, at=S.INSTANT)
ORDER = ["poll", "pos"]

# poll -> links in document order
POLLS = {
    1: ["a", "", "b", "a"],
    2: ["b", "c", None],
    3: ["a", "b", "c"],
    4: ["d", "c", "d"],
}
FIRST = {"a": "1-0", "b": "1-2", "c": "2-1", "d": "4-0"}


def land(path, poll, hours=0):
    path.mkdir(exist_ok=True)
    lines = [
        json.dumps(
            {
                "poll": poll,
                "pos": pos,
                "link": link,
                "judul": f"{poll}-{pos}",
                "at": f"2026-05-0{poll}T00:00:00Z" if not hours else "2026-01-01T00:00:00Z",
            }
        )
        for pos, link in enumerate(POLLS[poll])
    ]
    (path / f"poll-{poll}.json").write_text("\n".join(lines))


def stream_of(spark, path, per_trigger=None):
    reader = spark.readStream.schema(ARTICLES)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.json(str(path))


def stored(spark, path):
    return {r.link: r.judul for r in spark.read.parquet(str(path)).collect()}


@pytest.mark.parametrize("at_once", [True, False])
def test_first_seen_batch_equals_stream(spark, tmp_path, at_once):
    """One batch or one per poll, with a restart in between: the same articles."""
    landed, out = tmp_path / "in", tmp_path / "out"

    def run():
        first_seen_stream(
            stream_of(spark, landed), str(out), ORDER, trigger=triggers.DRAIN
        ).awaitTermination()

    for poll in POLLS:
        land(landed, poll)
        if not at_once:
            run()
    run()
    assert stored(spark, out) == FIRST
    assert spark.read.parquet(str(out)).count() == len(FIRST)
    batch = N.first_seen(spark.read.schema(ARTICLES).json(str(landed)), ORDER)
    assert {r.link: r.judul for r in batch.collect()} == FIRST
    run()
    assert spark.read.parquet(str(out)).count() == len(FIRST)


def test_state_does_not_grow_with_the_shuffles(spark, tmp_path):
    """A restart keeps the partitions of the state, whatever the session says by then."""
    landed, out = tmp_path / "in", tmp_path / "out"
    for poll, shuffled in zip(POLLS, ("48", "3", "48", "3")):
        land(landed, poll)
        with using(spark, {"spark.sql.shuffle.partitions": shuffled}):
            first_seen_stream(stream_of(spark, landed), str(out), ORDER, triggers.DRAIN).awaitTermination()
    assert stored(spark, out) == FIRST
    kept = [path for path in (out / "_checkpoint" / "state" / "0").iterdir() if path.name.isdigit()]
    assert len(kept) == max(32, spark.sparkContext.defaultParallelism)


@pytest.mark.parametrize("numbers", [range(23), [0], [], [-7, -2, None, 3], [-7, -2], [None], [2**63 - 1, 0]])
def test_every_row_is_in_one_piece(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    pieces = [[r.n for r in piece.collect()] for piece in _pieces(df, "n")]
    assert sorted(map(str, sum(pieces, []))) == sorted(map(str, numbers))
    if numbers and all(n is not None and n >= 0 for n in numbers):
        top = max(numbers) + 1
        assert all(n * len(pieces) // top == k for k, own in enumerate(pieces) for n in own)


def test_a_piece_is_read_without_the_others(spark, tmp_path):
    spark.range(1000).withColumnRenamed("id", "n").write.parquet(f"{tmp_path}/t")
    for piece in _pieces(spark.read.parquet(f"{tmp_path}/t"), "n"):
        plan = piece._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: \[.*(LessThan|GreaterThanOrEqual)\(n,\d+\)", plan)


def hot_feed(tmp_path, polls=6, rows=600):
    """A third of the rows of every poll carry one link; the others repeat in turn."""
    landed, first = tmp_path / "in", {}
    landed.mkdir()
    for poll in range(polls):
        lines = []
        for pos in range(rows):
            n = poll * rows + pos
            link = "hot" if n % 3 == 0 else f"l{n % 1000}"
            first.setdefault(link, f"{poll}-{pos}")
            lines.append(json.dumps({"poll": poll, "pos": pos, "link": link, "judul": f"{poll}-{pos}"}))
        (landed / f"poll-{poll}.json").write_text("\n".join(lines))
        time.sleep(0.02)
    return landed, first


def test_hot_link_in_streams(spark, tmp_path):
    landed, first = hot_feed(tmp_path)
    first_seen_stream(
        stream_of(spark, landed, 2), str(tmp_path / "out"), ORDER, triggers.DRAIN
    ).awaitTermination()
    assert stored(spark, tmp_path / "out") == first


def test_new_articles_are_forwarded(spark, tmp_path):
    landed, passed = tmp_path / "in", []
    for poll in POLLS:
        land(landed, poll)
        first_seen_stream(
            stream_of(spark, landed),
            str(tmp_path / "out"),
            ORDER,
            triggers.DRAIN,
            forward=lambda new, part: passed.append((part, sorted(r.link for r in new.collect()))),
        ).awaitTermination()
    assert [links for _, links in passed] == [["a", "b"], ["c"], [], ["d"]]
    assert [part.rpartition("-")[2] for part, _ in passed] == ["0", "1", "2", "3"]
    assert len({part.rpartition("-")[0] for part, _ in passed}) == 1


def test_a_failed_batch_is_repeated_whole(spark, tmp_path):
    """Publishing fails after the articles are stored: nothing is lost or stored twice."""
    landed, out, passed = tmp_path / "in", tmp_path / "out", []

    def run(forward):
        first_seen_stream(
            stream_of(spark, landed), str(out), ORDER, triggers.DRAIN, forward
        ).awaitTermination()

    def keep(new, part):
        passed.extend(sorted(r.link for r in new.collect()))

    def fail(new, part):
        raise ValueError("no broker")

    land(landed, 1)
    run(keep)
    land(landed, 2)
    with pytest.raises(StreamingQueryException, match="no broker"):
        run(fail)
    land(landed, 4)
    run(keep)
    assert passed == ["a", "b", "c", "d"]
    assert stored(spark, out) == FIRST
    assert spark.read.parquet(str(out)).count() == len(FIRST)


def land_weather(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(dict(zip(FIELDS, r))) for r in rows))


def weather_stream(spark, path):
    return spark.readStream.schema(S.OBSERVATION).json(str(path))


def by_text(rows):
    return sorted(rows, key=repr)


def test_publish_store_and_resume(spark, tmp_path, weather):
    landed, bus, api = tmp_path / "in", str(tmp_path / "bus"), str(tmp_path / "api")

    def run():
        events = weather_stream(spark, landed)
        publish_stream(
            weather_messages(events, F.current_timestamp()),
            str(tmp_path / "bus-check"),
            bus,
        ).awaitTermination()
        topic = read_topic(spark, S.TOPIC_WEATHER, bus, stream=True)
        query = store_stream(
            messages(topic, S.OBSERVATION), api, str(tmp_path / "api-check"), triggers.DRAIN
        )
        query.awaitTermination()
        return query

    land_weather(landed, "one.json", OBSERVATIONS[:4])
    run()
    assert weather_files(spark, api).count() == 4
    land_weather(landed, "two.json", OBSERVATIONS[4:])
    run()
    files = set((tmp_path / "api").glob("part-*"))
    run()
    # A run without news adds no file.
    assert set((tmp_path / "api").glob("part-*")) == files
    back = weather_files(spark, api)
    assert by_text(tuples(back)) == by_text(tuples(weather))


@pytest.mark.parametrize("weather_first", [True, False])
def test_both_orders_on_one_bus(spark, tmp_path, weather_first):
    """Whoever writes first, and again after a restart, every message can be read."""
    bus, landed = str(tmp_path / "bus"), tmp_path / "in"

    def weather_run(name, rows):
        land_weather(tmp_path / "w", name, rows)
        events = weather_stream(spark, tmp_path / "w")
        publish_stream(
            weather_messages(events, F.current_timestamp()), str(tmp_path / "check"), bus
        ).awaitTermination()

    def news_run(poll):
        land(landed, poll)

        def forward(new, part):
            shaped = new.select(*(F.lit(None).cast(f.dataType).alias(f.name) if f.name not in new.columns else F.col(f.name) for f in S.ARTICLE))
            publish(news_messages(shaped, F.current_timestamp()), bus, part=part)

        first_seen_stream(
            stream_of(spark, landed), str(tmp_path / "sent"), ORDER, triggers.DRAIN, forward
        ).awaitTermination()

    steps = [
        lambda: weather_run("one.json", OBSERVATIONS[:4]), lambda: news_run(1),
        lambda: weather_run("two.json", OBSERVATIONS[4:]), lambda: news_run(2), lambda: news_run(4),
    ]
    if not weather_first:
        steps[0], steps[1] = steps[1], steps[0]
    for step in steps:
        step()
    links = messages(read_topic(spark, S.TOPIC_NEWS, bus), S.ARTICLE).collect()
    assert sorted(r.link for r in links) == sorted(FIRST)
    assert messages(read_topic(spark, S.TOPIC_WEATHER, bus), S.OBSERVATION).count() == 6


def test_messages_sent_again_are_stored_once(spark, tmp_path):
    """A repeated part within a batch, in a later one, and equal messages of different parts."""
    bus = str(tmp_path / "bus")
    land_weather(tmp_path / "in", "one.json", OBSERVATIONS)
    rows = weather_files(spark, str(tmp_path / "in"))
    sent = weather_messages(rows, F.to_timestamp(F.lit("2026-05-06 00:00:00")))

    def run():
        read = once(read_topic(spark, S.TOPIC_WEATHER, bus, stream=True))
        query = store_stream(messages(read, S.OBSERVATION), str(tmp_path / "out"), str(tmp_path / "c"), triggers.DRAIN)
        query.awaitTermination()
        return weather_files(spark, str(tmp_path / "out")).count()

    publish(identified(sent, "one"), bus, part="one")
    publish(identified(sent, "one").repartition(3, "value"), bus, part="one-again")
    assert run() == len(OBSERVATIONS)
    publish(identified(sent, "one").orderBy(F.desc("value")), bus, part="one-later")
    assert run() == len(OBSERVATIONS)
    publish(sent, bus, part="two")
    assert run() == 2 * len(OBSERVATIONS)
    # Parts without ids, as they were written before.
    old = sent.withColumn("id", F.lit(None).cast("string")).withColumn("timestamp", F.to_timestamp(F.lit("2026-05-07 00:00:00")))
    publish(old, bus, part="old")
    assert run() == 3 * len(OBSERVATIONS)


def test_streams_run_together_drain_and_stop(spark, tmp_path):
    """Processing-time triggers, own checkpoints, status, counts, the remainder stored."""
    told = []

    def starter(name):
        return lambda trigger: store_stream(
            weather_stream(spark, tmp_path / name), str(tmp_path / f"{name}-out"),
            str(tmp_path / f"{name}-check"), trigger, name,
        )

    def tell(line):
        told.append(line)
        if "batch 0" in line:  # arrives while the streams run
            land_weather(tmp_path / "ConsumerAPI", "two.json", OBSERVATIONS[3:])

    names = ("ConsumerAPI", "ConsumerRSS")
    for name in names:
        land_weather(tmp_path / name, "one.json", OBSERVATIONS[:3])
    starts = {name: (starter(name), {"processingTime": "1 hour"}) for name in names}
    counts = run_together(spark, starts, seconds=6, status_every=1, told=tell)
    assert f"  ConsumerAPI     : {S.ALIVE}" in told and told[-1] == f"  ConsumerRSS     : {S.DEAD}"
    sizes = {n: weather_files(spark, str(tmp_path / f"{n}-out")).count() for n in names}
    assert sizes == {"ConsumerAPI": 6, "ConsumerRSS": 3}
    assert counts.batches["ConsumerRSS", 0] == (3, None)
    assert not spark.streams.active


def test_a_failing_stream_stops_the_others(spark, tmp_path):
    for name in ("good", "bad"):
        land_weather(tmp_path / name, "one.json", OBSERVATIONS[:3])

    def bad(trigger):
        def fail(batch, batch_id):
            raise ValueError("no broker")

        return weather_stream(spark, tmp_path / "bad").writeStream.foreachBatch(fail).trigger(**trigger).start()

    def good(trigger):
        return store_stream(weather_stream(spark, tmp_path / "good"), str(tmp_path / "out"), str(tmp_path / "c"), trigger)

    every = {"processingTime": "1 second"}
    with pytest.raises(StreamingQueryException, match="no broker"):
        run_together(spark, {"good": (good, every), "bad": (bad, every)}, status_every=1, told=lambda _: None)
    assert not spark.streams.active
    # What came for the others before the failure, and until they were drained, is stored.
    assert weather_files(spark, str(tmp_path / "out")).count() == 3


def test_others_are_drained_if_one_cannot_start(spark, tmp_path):
    land_weather(tmp_path / "good", "one.json", OBSERVATIONS[:3])

    def good(trigger):
        return store_stream(
            weather_stream(spark, tmp_path / "good"), str(tmp_path / "out"), str(tmp_path / "c"), trigger, "Good")

    def bad(trigger):
        raise ValueError("no such topic")

    every = {"processingTime": "1 hour"}
    store = str(tmp_path / "batches")
    with pytest.raises(ValueError, match="no such topic"):
        run_together(spark, {"good": (good, every), "bad": (bad, every)}, told=lambda _: None, store=store)
    assert not spark.streams.active
    assert weather_files(spark, str(tmp_path / "out")).count() == 3
    # The counts are there though the run ended with an error.
    assert sum(r.jumlah_event for r in stored_counts(spark, store).collect()) == 3


def test_counts_are_stored_as_they_come(spark, tmp_path):
    """Each batch's counts are a file at once; a stream that dies leaves those before it, and
    its restart goes on from there."""
    store, landed = str(tmp_path / "batches"), tmp_path / "in"
    assert stored_counts(spark, store).collect() == []

    def run(fail):
        def forward(new, part):
            if fail:
                raise ValueError("dead")

        return first_seen_stream(
            stream_of(spark, landed), str(tmp_path / "out"), ORDER, triggers.DRAIN, forward, name="News/x")

    for poll, fail in ((1, False), (2, True), (None, False)):
        if poll:
            land(landed, poll)
        query = run(fail)
        if fail:
            with pytest.raises(StreamingQueryException, match="dead"):
                query.awaitTermination()
        else:
            query.awaitTermination()
        counts = BatchCounts(None, spark, store)
        counts.catch_up(query)
        counts.catch_up(query)
        assert not counts.batches
        if fail:
            assert sorted(tuples(stored_counts(spark, store))) == [("News/x", 0, 3, 2)]
    assert sorted(tuples(stored_counts(spark, store))) == [("News/x", 0, 3, 2), ("News/x", 1, 2, 1)]


def test_links_of_past_periods_are_forgotten(spark, tmp_path):
    """A link is new once a day; the state holds two days or so, and late articles are left out."""
    landed, kept = tmp_path / "in", []
    landed.mkdir()

    def day(number, links, at):
        rows = [{"poll": number, "pos": i, "link": x, "judul": f"{number}-{i}", "at": at} for i, x in enumerate(links)]
        (landed / f"{number}.json").write_text("\n".join(map(json.dumps, rows)))
        query = first_seen_stream(
            stream_of(spark, landed).withColumnRenamed("at", "fetched_at"), str(tmp_path / "out"), ORDER, triggers.DRAIN,
            within="1 day")
        query.awaitTermination()
        kept.append(query.lastProgress.stateOperators[0].numRowsTotal)

    for number in range(1, 9):
        links = [f"{number}-{i}" for i in range(20)] + ["same", "same"]
        day(number, links, f"2026-05-{number:02d}T10:00:00Z")
    day(9, ["same"], "2026-05-08T11:00:00Z")
    day(10, ["same", "old"], "2026-05-01T11:00:00Z")
    got = [(r.poll, r.link) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted((n, x) for n in range(1, 9) for x in [*(f"{n}-{i}" for i in range(20)), "same"])
    assert max(kept) <= 3 * 21 < 8 * 21


def test_new_articles_are_counted_per_batch(spark, tmp_path):
    landed, counts = tmp_path / "in", BatchCounts()
    spark.streams.addListener(counts)
    try:
        for poll in (1, 2):
            land(landed, poll)
            first_seen_stream(
                stream_of(spark, landed), str(tmp_path / "out"), ORDER, triggers.DRAIN, name="News"
            ).awaitTermination()
        for _ in range(50):
            if len(counts.batches) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    assert counts.batches == {("News", 0): (3, 2), ("News", 1): (2, 1)}


def test_status():
    class Query:
        isActive = True

    dead = Query()
    dead.isActive = False
    assert status_lines({"ConsumerAPI": Query(), "X": dead}) == [
        "  ConsumerAPI     : 🟢 berjalan", "  X               : 🔴 mati"]


def test_triggers():
    assert triggers.POLL_WEATHER == {"processingTime": "600 seconds"}
    assert triggers.POLL_NEWS == {"processingTime": "300 seconds"}
    assert triggers.FLUSH == {"processingTime": "120 seconds"}

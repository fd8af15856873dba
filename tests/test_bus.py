"""Messages, the file-backed bus and peeking."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

import pytest
from conftest import tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.sinks.bus import broker_options, news_messages, publish, weather_messages
from monsoon.sources.bus import message_lines, message_rejects, messages, peek, read_topic


@pytest.fixture
def numbered(weather):
    # Numbered by the fixed order of the handwritten rows.
    return weather.withColumn(
        "n", F.xxhash64("kode_kota", "timestamp", "humidity").cast("bigint")
    ).withColumn("at", F.timestamp_seconds(F.lit(1778068800)))


def test_round_trip(spark, numbered, weather, tmp_path):
    path = str(tmp_path / "bus")
    publish(weather_messages(numbered, F.col("at")), path)
    bus = read_topic(spark, S.TOPIC_WEATHER, path)
    assert {f.name: f.dataType for f in bus.schema if f.name != "id"} == {f.name: f.dataType for f in S.BUS}
    assert bus.select("id").distinct().count() == 6
    assert sorted(tuples(messages(bus, S.OBSERVATION)), key=repr) == sorted(tuples(weather), key=repr)
    keyed = messages(bus, S.OBSERVATION, "key").collect()
    assert all(r.key.decode() == r.kode_kota for r in keyed)


def test_topics_are_apart(spark, numbered, tmp_path):
    path = str(tmp_path / "bus")
    publish(weather_messages(numbered, F.col("at")), path)
    news = spark.createDataFrame([("t", "http://x", "r", "w", "s", "ts")], S.ARTICLE)
    publish(news_messages(news, F.current_timestamp()), path)
    [message] = read_topic(spark, S.TOPIC_NEWS, path).collect()
    assert message.key.decode() == hashlib.md5(b"http://x").hexdigest()[:8]
    assert json.loads(message.value)["judul"] == "t"
    assert read_topic(spark, S.TOPIC_WEATHER, path).count() == 6


def test_a_part_is_written_once(spark, numbered, tmp_path):
    path = str(tmp_path / "bus")
    for _ in range(2):
        publish(weather_messages(numbered, F.col("at")), path, part="w-0")
    assert read_topic(spark, S.TOPIC_WEATHER, path).count() == 6
    (tmp_path / "bus" / "w-0" / "_SUCCESS").unlink()  # as if the job had died
    publish(weather_messages(numbered, F.col("at")), path, part="w-0")
    assert read_topic(spark, S.TOPIC_WEATHER, path).count() == 6


def test_a_topic_without_messages(spark, tmp_path):
    none = read_topic(spark, S.TOPIC_NEWS, str(tmp_path / "bus"))
    assert none.columns == [*S.BUS.names, "id"] and none.count() == 0


def test_undecodable_messages_are_rejected(spark):
    values = [b'{"judul":"t"}', b"not json", None, b"", b'{"judul":', b"[1]", b'{"judul":"u"}\n', b'{"judul":null}']
    at = datetime(2026, 5, 6, 12, tzinfo=timezone.utc)
    bus = spark.createDataFrame([("t", at, b"k", v) for v in values], S.BUS)
    assert sorted(str(r.judul) for r in messages(bus, S.ARTICLE).collect()) == ["None", "t", "u"]
    rejects = message_rejects(bus, S.ARTICLE).collect()
    assert sorted(str(r.isi) for r in rejects) == ["", "None", "[1]", "not json", '{"judul":']
    assert {(r.topic, r.key, r.dikirim) for r in rejects} == {("t", "k", "2026-05-06T12:00:00")}


def test_a_message_with_one_bad_field_keeps_the_others(spark):
    value = b'{"kode_kota":null,"humidity":"wet","temperature":30.5}'
    bus = spark.createDataFrame([("t", None, None, value)], S.BUS)
    [row] = messages(bus, S.OBSERVATION).collect()
    assert (row.temperature, row.humidity) == (30.5, None)
    assert message_rejects(bus, S.OBSERVATION).count() == 0


def test_peek(spark):
    rows = [("t", datetime(2026, 5, 6, 12, m, tzinfo=timezone.utc), key, b'{"a":"' + b"x" * 200 + b'"}') for m, key in [
        (4, b"k"), (1, b""), (0, None), (2, b"k"), (2, b"a"), (6, b"z"),
    ]]
    bus = spark.createDataFrame(rows, S.BUS)
    first = peek(bus).collect()
    assert [(r.waktu[14:16], r.key) for r in first] == [
        ("00", None), ("01", None), ("02", "a"), ("02", "k"), ("04", "k"),
    ]
    assert all(len(r.value) == S.PEEK_CHARS for r in first)
    assert peek(bus, 2).count() == 2
    assert tuples(message_lines(peek(bus, 1)))[0][0] == (
        '  waktu=2026-05-06T12:00:00 | key=None | value={"a":"' + "x" * 114 + "..."
    )


def test_broker_settings():
    assert broker_options("h:9092") == {
        "kafka.bootstrap.servers": "h:9092",
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def test_broker_needs_the_connector(spark, numbered):
    """The connector is not installed here; with a broker address it is what is asked for."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_topic(spark, S.TOPIC_WEATHER, servers="h:9092")

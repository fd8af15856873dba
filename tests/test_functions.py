"""Scalar functions against plain Python."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest
from conftest import FIELDS, OBSERVATIONS, tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.functions import clock, text, wire
from monsoon.functions.conditions import temperature_band


def typed_observations():
    return [
        (a, b, t, None if h is None else float(h), w, c, s) for a, b, t, h, w, c, s in OBSERVATIONS
    ]


def one(spark, column, **values):
    frame = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()), "id")
    return frame.select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "written, hour",
    [
        ("2026-05-06T12:34:56.123456", 12),
        ("2026-05-06T12:34:56", 12),
        ("2026-05-06 00:00:00", 0),
        ("2026-05-06 23:59:59", 23),
        ("12:30", None),
        ("T12:30", None),
        ("garbage", None),
        ("", None),
        (None, None),
        ("2026-13-45 99:00:00", None),
    ],
)
def test_event_time(spark, written, hour):
    ts = clock.event_time(F.col("s").cast("string"))
    assert one(spark, clock.hour_of_day(ts), s=written) == hour


@pytest.mark.parametrize("when", [datetime(2026, 5, 6, 1, 2, 3, 45), datetime(2026, 5, 6, 1, 2, 3)])
def test_time_as_text(spark, when):
    ts = F.col("s").cast("timestamp")
    assert one(spark, clock.iso_text(ts), s=str(when)) == when.isoformat()
    assert one(spark, clock.plain_text(ts), s=str(when)) == when.strftime("%Y-%m-%d %H:%M:%S")
    assert one(spark, clock.file_stamp(ts), s=str(when)) == when.strftime("%Y-%m-%d_%H-%M-%S")
    assert one(spark, clock.clock_text(ts), s=str(when)) == when.strftime("%H:%M:%S")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\0")), min_size=1, max_size=20))
def test_text_functions(spark, strings):
    df = spark.createDataFrame([(s,) for s in strings], "s string").select(
        "s",
        text.link_key(F.col("s")).alias("key"),
        text.prefix(F.col("s"), 5).alias("head"),
        text.key_text(text.to_bytes(F.col("s"))).alias("back"),
    )
    for s, key, head, back in tuples(df):
        assert key == hashlib.md5(s.encode()).hexdigest()[:8]
        assert head == s[:5]
        assert back == (s or None)


def test_display_lines(spark):
    df = spark.createDataFrame(typed_observations(), S.OBSERVATION)
    lines = [r[0] for r in df.select(text.observation_line()).collect()]
    assert lines[0] == f"  JKT | {'Jakarta':10s} | 30.5°C |  10.0 km/h |  80.0%"
    assert lines[5] == f"  DPS | {'Denpasar':10s} | None°C |  None km/h |  None%"
    assert one(spark, text.article_line(), judul="x" * 100) == f"  → {'x' * 70}..."
    assert one(spark, text.padded(F.col("s"), 3), s="longer") == "longer"
    assert one(spark, text.hour_label(F.col("h")), h=7) == "07:00"
    shown = one(spark, text.message_line(), offset=3, key="JKT", value="{}")
    assert shown == "  offset=3 | key=JKT | value={}..."
    shown = one(spark, text.message_line("waktu"), waktu="t", key="JKT", value="{}")
    assert shown == "  waktu=t | key=JKT | value={}..."


def test_json_round_trip(spark):
    rows = typed_observations()
    df = spark.createDataFrame(rows, S.OBSERVATION)
    sent = df.select(wire.json_text(*df.columns).alias("j"))
    assert all(set(json.loads(r.j)) == set(FIELDS) for r in sent.collect())
    back = sent.select(wire.decoded(F.encode("j", "utf-8"), S.OBSERVATION).alias("e")).select("e.*")
    assert tuples(back.drop(S.CORRUPT)) == rows
    assert back.filter(f"{S.CORRUPT} IS NOT NULL").count() == 0


def test_non_ascii_is_kept(spark):
    assert one(spark, wire.json_text("s"), s="é→漢") == '{"s":"é→漢"}'


def test_bands(spark):
    df = spark.createDataFrame([(t,) for t in (None, 21.9, 22.0, 26.9, 31.9, 32.0)], "t double")
    assert [r[0] for r in df.select(temperature_band(F.col("t"))).collect()] == [
        "abu-abu", "biru", "hijau", "hijau", "kuning", "merah",
    ]

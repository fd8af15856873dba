"""The analyses on handwritten edges, each alone and from the one-pass report."""

from __future__ import annotations

import json
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.functions.conditions import is_extreme
from monsoon.operators import analyses as A
from monsoon.operators import report as R
from monsoon.operators.current import current_conditions

CITY_ROWS = [
    ("SBY", "Surabaya", 35.55, 36.0, 35.1, 2),
    ("JKT", "Jakarta", 32.75, 35.0, 30.5, 3),
    ("DPS", "Denpasar", None, None, None, 1),
]
EXTREME_ROWS = [("SBY", "Surabaya", 2), ("JKT", "Jakarta", 1)]
HOUR_ROWS = [(12, 32.75, 2), (13, None, 1), (23, 35.1, 1)]


def test_city_temperatures(weather):
    assert tuples(A.city_temperatures(weather)) == CITY_ROWS


def test_city_temperatures_by_name_unrounded(weather):
    rows = tuples(A.city_temperatures(weather, A.CITY_NAME, digits=None, with_count=False))
    assert rows[0] == ("Surabaya", (35.1 + 36.0) / 2, 36.0, 35.1)
    assert [row[0] for row in rows] == ["Surabaya", "Jakarta", "Denpasar"]


def test_extremes_are_strict_and_survive_nulls(weather):
    assert tuples(A.extreme_by_city(weather)) == EXTREME_ROWS
    assert tuples(A.extreme_by_city(weather, A.CITY_NAME)) == [("Surabaya", 2), ("Jakarta", 1)]
    assert tuples(A.extreme_total(weather)) == [(3,)]
    assert A.extreme_events(weather).count() == 3


def test_extreme_limits_are_parameters(weather):
    assert A.extreme_events(weather, is_extreme(9, 200, 200)).count() == 4


def test_totals(weather):
    assert tuples(A.total_events(weather)) == [(6,)]


def test_hourly_trend(weather):
    assert tuples(A.hourly_trend(weather)) == HOUR_ROWS
    assert weather.sparkSession.table("weather_api").count() == 6


def test_hourly_trend_with_null_bucket_first(weather):
    rows = tuples(A.hourly_trend_with_null(weather))
    assert rows == [(None, 36.0), (12, 32.75), (13, None), (23, 35.1)]


def test_top_rows(weather):
    assert tuples(A.hottest_city(weather)) == [CITY_ROWS[0]]
    assert tuples(A.most_extreme_city(weather)) == [EXTREME_ROWS[0]]
    # A mean of NULL sorts first but must not win.
    assert tuples(A.coldest_hour(weather)) == [HOUR_ROWS[0]]


def test_flush_batches(weather):
    rows = sorted(tuples(A.flush_batches(weather)))
    assert rows == [
        ("2026-05-06 12:34:00", 1),
        ("2026-05-06 12:40:00", 1),
        ("2026-05-06 13:00:00", 1),
        ("2026-05-06 23:58:00", 1),
    ]


def test_report_agrees_with_the_single_analyses(weather):
    rows = R.report_rows(weather)
    assert tuples(R.city_rows(rows)) == CITY_ROWS
    assert tuples(R.extreme_rows(rows)) == EXTREME_ROWS
    assert tuples(R.hour_rows(rows)) == HOUR_ROWS
    assert tuples(R.totals(rows)) == [(6, 3)]


def test_insights(weather):
    said = dict(tuples(R.insights(R.report_rows(weather))))
    assert said["suhu"].startswith("Surabaya memiliki rata-rata suhu tertinggi (35.55 C).")
    assert said["ekstrem"].startswith("Surabaya paling sering mengalami kondisi ekstrem (2 event).")
    assert said["tren"].startswith("Jam 12:00 memiliki rata-rata suhu terendah (32.75 C).")


def test_insights_without_data(no_weather):
    said = dict(tuples(R.insights(R.report_rows(no_weather))))
    assert said == {"suhu": R.NO_TEMPERATURE, "ekstrem": R.NO_EXTREME, "tren": R.NO_HOUR}


def test_dashboard_document(weather):
    [(text,)] = tuples(R.dashboard_document(R.report_rows(weather)))
    document = json.loads(text, parse_constant=lambda c: 1 / 0)  # no NaN
    assert [tuple(r.values()) for r in document["suhu_kota"]] == CITY_ROWS
    assert [tuple(r.values()) for r in document["ekstrem"]] == EXTREME_ROWS
    assert [tuple(r.values()) for r in document["tren_jam"]] == HOUR_ROWS
    assert list(document["suhu_kota"][2]) == [
        "kode_kota",
        "nama_kota",
        "suhu_avg",
        "suhu_tertinggi",
        "suhu_terendah",
        "jumlah_event",
    ]


def test_dashboard_document_of_too_many_rows(weather, monkeypatch):
    rows = R.report_rows(weather)
    n = rows.count()
    monkeypatch.setattr(R, "MOST_LISTED", n)
    assert len(tuples(R.dashboard_document(rows))) == 1
    monkeypatch.setattr(R, "MOST_LISTED", n - 1)
    with pytest.raises(Exception, match=f"at most {n - 1} rows"):
        R.dashboard_document(rows).collect()


def test_dashboard_document_without_data(no_weather):
    [(text,)] = tuples(R.dashboard_document(R.report_rows(no_weather), pretty=True))
    assert json.loads(text) == {"suhu_kota": [], "ekstrem": [], "tren_jam": []}
    assert "\n" in text


def test_current_conditions(weather):
    numbered = weather.withColumn("n", F.monotonically_increasing_id())
    rows = {r.kode_kota: r for r in current_conditions(numbered, "n").collect()}
    assert set(rows) == {"JKT", "SBY"}  # Denpasar's only event has no time
    assert rows["JKT"].waktu == "2026-05-06 13:00:00"
    assert (rows["JKT"].temperature, rows["JKT"].warna, rows["JKT"].ekstrem) == (None, "abu-abu", True)
    assert (rows["SBY"].temperature, rows["SBY"].warna, rows["SBY"].ekstrem) == (35.1, "merah", True)


def test_current_conditions_ties_are_decided(spark):
    rows = [
        ("JKT", "Jakarta", float(t), 1.0, 1.0, 1, "2026-05-06 12:00:00", n)
        for t, n in [(20, 5), (30, 9), (25, 7)]
    ]
    df = spark.createDataFrame(
        rows,
        "kode_kota string, nama_kota string, temperature double, humidity double, "
        "wind_speed double, weather_code bigint, timestamp string, n bigint",
    )
    assert current_conditions(df, "n").first().temperature == 30.0


def test_means_on_a_half_are_rounded_up(spark):
    """Small groups of tenths often average to exactly half a hundredth."""
    source = random.Random(7)
    groups = {
        f"c{g}": [Decimal(source.randrange(0, 400)) / 10 for _ in range(source.choice([4, 8, 20, 40]))]
        for g in range(400)
    }
    rows = [(g, g, float(t), 1.0, 1.0, 1, "2026-05-06 12:00:00") for g, ts in groups.items() for t in ts]
    source.shuffle(rows)
    df = spark.createDataFrame(rows, S.OBSERVATION).repartition(5)
    half_up = {
        g: float((sum(ts) / len(ts)).quantize(Decimal("0.01"), ROUND_HALF_UP))
        for g, ts in groups.items()
    }
    assert sum((sum(ts) / len(ts) * 1000) % 10 == 5 for ts in groups.values()) > 50
    assert {r.kode_kota: r.suhu_avg for r in A.city_temperatures(df).collect()} == half_up
    report = R.city_rows(R.report_rows(df))
    assert {r.kode_kota: r.suhu_avg for r in report.collect()} == half_up


def test_counts_add_up(weather):
    total = A.total_events(weather).first()[0]
    assert sum(r.jumlah_event for r in A.city_temperatures(weather).collect()) == total
    extremes = sum(r.jumlah_event_ekstrem for r in A.extreme_by_city(weather).collect())
    assert extremes == A.extreme_total(weather).first()[0]
    timed = A.with_event_time(weather).filter("ts_obj IS NOT NULL").count()
    assert sum(r.jumlah_event for r in A.hourly_trend(weather).collect()) == timed

"""The plans are the ones wanted."""

from __future__ import annotations

import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as driver
from monsoon.operators import analyses as A
from monsoon.operators import report as R
from monsoon.operators.articles import not_sent_before
from monsoon.plans import queries as registered
from monsoon.sinks.results import write_curated
from monsoon.sources.weather import curated_weather, weather_files

SF = f"{TESTDATA}/sf0.001"
LAZY = sorted(
    n
    for n in registered.registry()
    if not re.match("stream_|.*roundtrip|file_|stored_|bus_", n)
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    assert not re.search(r"Python|Pandas|ArrowEval", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def test_columns_are_pruned(spark, weather, tmp_path):
    """In curated files; stored JSON is parsed whole, so that all queries see the same rows."""
    path = str(tmp_path / "curated")
    write_curated(weather, path)
    text = plan(A.city_temperatures(curated_weather(spark, path)))
    [schema] = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert set(re.findall(r"(\w+):", schema)) == {"kode_kota", "nama_kota", "temperature"}


def test_extreme_filter_is_pushed(spark, weather_dir, tmp_path):
    path = str(tmp_path / "events")
    weather_files(spark, weather_dir).write.parquet(path)
    text = plan(A.extreme_total(spark.read.parquet(path)))
    assert re.search(r"PushedFilters: \[Or\(Or\(GreaterThan\(wind_speed,40.0\)", text)


def test_table_scans_read_only_what_is_used(spark):
    text = plan(driver.queries()["city_temperature_stats"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text
    text = plan(driver.queries()["articles_new_per_poll"](spark, SF))
    assert set(re.findall(r"ReadSchema: struct<(.*?)>", text)) == {"doc_id:bigint"}


def test_aggregates_reduce_before_the_shuffle(spark):
    for name in ("city_temperature_stats", "extreme_by_city", "hourly_trend", "flush_batch_counts"):
        text = plan(driver.queries()[name](spark, SF))
        assert re.search(r"partial_(avg|count)", text), name


def test_first_seen_limits_each_link_before_the_shuffle(spark):
    for name in ("articles_first_seen", "feed_preview"):
        text = plan(driver.queries()[name](spark, SF))
        assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .*Partial", text)


def test_anti_join_reuses_the_partitioning(spark):
    """One shuffle per side, none for the join itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select(F.col("id"), F.concat(F.lit("l"), F.col("id") % 7).alias("link"))
        text = plan(not_sent_before(df.filter("id > 50"), df.filter("id <= 50"), ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(link") == 2


def test_report_scans_the_events_once(spark):
    for result in (R.insights, R.dashboard_document, R.totals):
        from monsoon.plans import tables

        text = plan(result(R.report_rows(tables.observations(spark, SF))))
        assert text.count("FileScan") == 1


def test_answers_are_parsed_once(spark):
    text = plan(driver.queries()["observations_from_raw"](spark, SF))
    assert len(re.findall(r"Generate inline", text)) == 1
    assert len(re.findall(r"from_json", text)) == 1


def test_peek_reads_values_only_up_to_the_last_message(spark, tmp_path):
    from monsoon.sources.bus import peek

    path = str(tmp_path / "bus")
    spark.range(1000).selectExpr(
        "'t' AS topic", "timestamp_seconds(id) AS timestamp",
        "encode('k', 'utf-8') AS key", "encode(repeat('x', 100), 'utf-8') AS value",
    ).write.parquet(path)
    first = peek(spark.read.parquet(path))
    assert [r.waktu[-2:] for r in first.collect()] == ["00", "01", "02", "03", "04"]
    text = plan(first)
    scans = dict.fromkeys(re.findall(r"FileScan parquet .*", text))
    reading = [scan for scan in scans if "value:binary" in scan]
    assert reading and all("LessThanOrEqual(timestamp," in scan for scan in reading)


def test_current_conditions_are_one_pass(spark):
    """One scan, one shuffle of a row per task and city, no job beforehand."""
    text = plan(driver.queries()["current_temperature"](spark, SF))
    assert text.count("FileScan parquet") == 1 and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning")


def test_new_articles_do_not_read_what_was_stored(spark, tmp_path):
    from monsoon.streaming.dedup import newly_seen

    spark.range(3).selectExpr("concat('l', id) AS link", "id AS n").write.parquet(f"{tmp_path}/in")
    articles = spark.read.parquet(f"{tmp_path}/in")
    text = plan(newly_seen(articles, ["n"]))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "partial_min_by" in text

def test_top_one_is_no_full_sort(spark):
    for name in ("hottest_city", "latest_news", "coldest_hour"):
        assert "TakeOrderedAndProject" in plan(driver.queries()[name](spark, SF))

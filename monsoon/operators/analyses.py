"""The analyses over weather observations, each on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.functions.clock import event_time, hour_of_day, plain_text
from monsoon.functions.conditions import is_extreme

CITY = ("kode_kota", "nama_kota")
CITY_NAME = ("nama_kota",)


def with_event_time(observations: DataFrame) -> DataFrame:
    """Observations with parsed time; curated ones have it already."""
    if "ts_obj" in observations.columns:
        return observations
    return observations.withColumn("ts_obj", event_time(F.col("timestamp")))


def register_view(observations: DataFrame, name: str = "weather_api") -> DataFrame:
    """Observations with parsed time, also as a SQL view."""
    timed = with_event_time(observations)
    timed.createOrReplaceTempView(name)
    return timed


def rounded(mean: Column, digits: int) -> Column:
    """Half up to the digits wanted.

    Adding doubles in another order changes the last bits of a mean, which would tip
    a mean that lies on a half. Rounding those bits away first settles it.
    """
    return F.round(F.round(mean, 10), digits)


def _mean(column: Column, digits: int | None) -> Column:
    return F.avg(column) if digits is None else rounded(F.avg(column), digits)


def total_events(observations: DataFrame) -> DataFrame:
    return observations.agg(F.count(F.lit(1)).alias("total_event"))


def city_temperatures(
    observations: DataFrame,
    by: tuple[str, ...] = CITY,
    digits: int | None = 2,
    with_count: bool = True,
) -> DataFrame:
    """Mean, highest and lowest temperature per city, warmest first.

    Six groups: partial aggregation leaves a few rows per task to shuffle, however the
    rows are spread over the cities. The sort is over the grouped rows.
    """
    t = F.col("temperature")
    measures = [
        _mean(t, digits).alias("suhu_avg"),
        F.max(t).alias("suhu_tertinggi"),
        F.min(t).alias("suhu_terendah"),
    ]
    if with_count:
        measures.append(F.count(F.lit(1)).alias("jumlah_event"))
    return (
        observations.groupBy(*by)
        .agg(*measures)
        .orderBy(F.col("suhu_avg").desc_nulls_last(), *by)
    )


def extreme_events(observations: DataFrame, limits: Column | None = None) -> DataFrame:
    return observations.filter(is_extreme() if limits is None else limits)


def extreme_by_city(
    observations: DataFrame, by: tuple[str, ...] = CITY, limits: Column | None = None
) -> DataFrame:
    """Extreme events per city, most first."""
    return (
        extreme_events(observations, limits)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("jumlah_event_ekstrem"))
        .orderBy(F.col("jumlah_event_ekstrem").desc(), *by)
    )


def extreme_total(observations: DataFrame, limits: Column | None = None) -> DataFrame:
    return extreme_events(observations, limits).agg(F.count(F.lit(1)).alias("total_ekstrem"))


def hourly_trend(observations: DataFrame, view: str = "weather_api") -> DataFrame:
    """Mean temperature and events per hour of day over all cities, as SQL on the view.

    Events of unknown time form one group, which the HAVING clause drops. As a WHERE
    clause the same test would parse every time a second time.
    """
    register_view(observations, view)
    return observations.sparkSession.sql(
        f"""
        SELECT jam, round(round(avg(temperature), 10), 2) AS suhu_avg, count(*) AS jumlah_event
        FROM (SELECT hour(ts_obj) AS jam, temperature FROM {view})
        GROUP BY jam
        HAVING count(jam) > 0
        ORDER BY jam
        """
    )


def hourly_trend_with_null(observations: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean temperature per hour, with a NULL hour for events of unknown time."""
    return (
        with_event_time(observations)
        .groupBy(hour_of_day(F.col("ts_obj")).alias("jam"))
        .agg(_mean(F.col("temperature"), digits).alias("suhu_avg"))
        .orderBy("jam")
    )


# Top-1 reports. An unknown mean never wins, and the key decides a tie.


def hottest_city(observations: DataFrame) -> DataFrame:
    stats = city_temperatures(observations)
    return (
        stats.filter(F.col("suhu_avg").isNotNull())
        .orderBy(F.col("suhu_avg").desc(), "kode_kota")
        .limit(1)
    )


def most_extreme_city(observations: DataFrame) -> DataFrame:
    return (
        extreme_by_city(observations)
        .orderBy(F.col("jumlah_event_ekstrem").desc(), "kode_kota")
        .limit(1)
    )


def coldest_hour(observations: DataFrame) -> DataFrame:
    return (
        hourly_trend(observations)
        .filter(F.col("suhu_avg").isNotNull())
        .orderBy(F.col("suhu_avg").asc(), "jam")
        .limit(1)
    )


def flush_batches(observations: DataFrame, seconds: int = S.FLUSH_SECONDS) -> DataFrame:
    """Events per flush interval; an interval without events has no row."""
    batch = F.floor(F.unix_seconds("ts_obj") / seconds)
    return (
        with_event_time(observations)
        .select(batch.alias("batch"))
        .groupBy("batch")
        .agg(F.count("batch").alias("timed"), F.count(F.lit(1)).alias("jumlah_event"))
        .filter(F.col("timed") > 0)
        .select(
            plain_text(F.timestamp_seconds(F.col("batch") * seconds)).alias("batch_start"),
            "jumlah_event",
        )
    )

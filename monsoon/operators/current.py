"""The dashboard table: current conditions per city, coloured and highlighted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monsoon.functions.clock import plain_text
from monsoon.functions.conditions import is_extreme, temperature_band
from monsoon.operators.analyses import with_event_time

_FIELDS = ["temperature", "humidity", "wind_speed", "weather_code"]
_CITY = ["kode_kota", "nama_kota"]

def current_conditions(observations: DataFrame, *ties: str) -> DataFrame:
    """The latest observation of each city; of equal times the greatest by ``ties``, by
    default the measured values in their order, NULL below all.

    One pass: each task reduces its rows to one per city before the shuffle. Events of
    unknown time have no part in it.
    """
    now = F.max_by(F.struct(*_FIELDS, "ts_obj"), F.struct("ts_obj", *(ties or _FIELDS)))
    return (
        with_event_time(observations)
        .groupBy(*_CITY)
        .agg(now.alias("now"))
        # Filtered after grouping, lest every time is parsed twice.
        .filter("now.ts_obj IS NOT NULL")
        .select(*_CITY, *(f"now.{name}" for name in _FIELDS), plain_text(F.col("now.ts_obj")).alias("waktu"))
        .withColumn("warna", temperature_band(F.col("temperature")))
        .withColumn("ekstrem", F.coalesce(is_extreme(), F.lit(False)))
    )

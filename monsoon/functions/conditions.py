"""Predicates and bands over one observation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monsoon import schemas as S


def is_extreme(
    wind: float = S.WIND_LIMIT,
    humidity: float = S.HUMIDITY_LIMIT,
    temperature: float = S.TEMPERATURE_LIMIT,
) -> Column:
    """Strictly above any limit. A NULL operand is unknown, another may still decide."""
    return (
        (F.col("wind_speed") > wind)
        | (F.col("humidity") > humidity)
        | (F.col("temperature") > temperature)
    )


# Upper bounds (exclusive) in °C and their colours; anything above is the last one.
BANDS = [(22.0, "biru"), (27.0, "hijau"), (32.0, "kuning")]
HOTTEST_BAND = "merah"
NO_BAND = "abu-abu"


def temperature_band(temperature: Column) -> Column:
    """Colour of a temperature for the dashboard table."""
    band = F.when(temperature.isNull(), NO_BAND)
    for bound, colour in BANDS:
        band = band.when(temperature < bound, colour)
    return band.otherwise(HOTTEST_BAND)

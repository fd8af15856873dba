"""The two constant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monsoon import schemas as S


def cities(spark: SparkSession) -> DataFrame:
    """The six cities. A literal relation: its size is known when planning."""
    rows = ", ".join(f"('{k}', '{n}', {lat}D, {lon}D)" for k, n, lat, lon in S.CITIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS city(kode, nama, lat, lon)")


def feeds(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({i}, '{url}')" for i, url in enumerate(S.FEEDS))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS feed(feed_ord, feed_url)")

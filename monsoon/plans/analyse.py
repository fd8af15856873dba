"""The analysis run: stored observations and articles in, stored results out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from monsoon import schemas as S
from monsoon.operators import report as R
from monsoon.operators.articles import latest_news
from monsoon.operators.current import current_conditions
from monsoon.session import settle
from monsoon.sinks.results import write_document, write_json

# Fixed names of the result directories.
CITIES = "suhu_per_kota"
EXTREMES = "kondisi_ekstrem"
HOURS = "tren_jam"
INSIGHTS = "narasi"
DOCUMENT = "spark_results"
CURRENT = "kondisi_terkini"
NEWS = "berita_terbaru"


def analyse(observations: DataFrame, path: str, articles: DataFrame | None = None) -> DataFrame:
    """Write every result below ``path``; returns the report rows they came from.

    The report rows are settled first, so each result is written from a few hundred rows
    instead of from another scan. Current conditions look at the events themselves, and the
    latest news at the articles, if there are any.
    """
    rows = settle(R.report_rows(observations))
    write_json(R.city_rows(rows), f"{path}/{CITIES}")
    write_json(R.extreme_rows(rows), f"{path}/{EXTREMES}")
    write_json(R.hour_rows(rows), f"{path}/{HOURS}")
    write_json(R.insights(rows), f"{path}/{INSIGHTS}")
    write_document(R.dashboard_document(rows), f"{path}/{DOCUMENT}")
    write_json(current_conditions(observations), f"{path}/{CURRENT}")
    if articles is not None:
        write_json(latest_news(articles, S.LATEST_NEWS), f"{path}/{NEWS}")
    return rows

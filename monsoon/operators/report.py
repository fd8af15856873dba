"""All analyses from one pass over the events.

The events are reduced once to one row per city and hour of day, at most a few hundred
rows whatever the volume. City totals, hourly totals, overall totals, the sentences and
the dashboard document are all derived from those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monsoon.functions.clock import hour_of_day
from monsoon.functions.conditions import is_extreme
from monsoon.functions.text import hour_label
from monsoon.functions.wire import KEEP_NULLS
from monsoon.operators.analyses import rounded, with_event_time

# --- Fixed sentences ----------------------------------------------------------

HOTTEST = (
    "%s memiliki rata-rata suhu tertinggi (%s C). Kota ini perlu diprioritaskan untuk "
    "monitoring pengiriman pada jam panas."
)
NO_TEMPERATURE = "Data suhu belum tersedia untuk dianalisis."
MOST_EXTREME = (
    "%s paling sering mengalami kondisi ekstrem (%s event). Rute melalui kota ini perlu "
    "dicek ulang sebelum pengiriman."
)
NO_EXTREME = (
    "Tidak ada event ekstrem berdasarkan ambang wind_speed > 40 km/h, humidity > 90%, "
    "atau temperature > 35 C. Kondisi relatif aman pada data yang terkumpul."
)
COLDEST = (
    "Jam %s memiliki rata-rata suhu terendah (%s C). Waktu ini dapat dipertimbangkan "
    "sebagai waktu pengiriman yang lebih nyaman."
)
NO_HOUR = "Data timestamp belum cukup untuk membaca tren suhu per jam."


def city_hours(observations: DataFrame) -> DataFrame:
    """Partial measures per city and hour of day: the one pass over the events."""
    t = F.col("temperature")
    return (
        with_event_time(observations)
        .groupBy("kode_kota", "nama_kota", hour_of_day(F.col("ts_obj")).alias("jam"))
        .agg(
            F.sum(t).alias("jumlah_suhu"),
            F.count(t).alias("n_suhu"),
            F.max(t).alias("suhu_tertinggi"),
            F.min(t).alias("suhu_terendah"),
            F.count(F.lit(1)).alias("jumlah_event"),
            F.count_if(is_extreme()).alias("jumlah_event_ekstrem"),
        )
    )


def report_rows(observations: DataFrame, digits: int = 2) -> DataFrame:
    """City rows and hour rows in one frame, told apart by ``jenis``."""
    per_city, per_hour = ["kode_kota", "nama_kota"], ["jam"]
    return (
        city_hours(observations)
        .groupingSets([per_city, per_hour], *per_city, *per_hour)
        .agg(
            F.when(F.grouping("jam") == 1, "kota").otherwise("jam").alias("jenis"),
            rounded(F.try_divide(F.sum("jumlah_suhu"), F.sum("n_suhu")), digits).alias("suhu_avg"),
            F.max("suhu_tertinggi").alias("suhu_tertinggi"),
            F.min("suhu_terendah").alias("suhu_terendah"),
            F.sum("jumlah_event").alias("jumlah_event"),
            F.sum("jumlah_event_ekstrem").alias("jumlah_event_ekstrem"),
        )
    )


def _city_row() -> Column:
    return F.col("jenis") == "kota"


def _extreme_row() -> Column:
    return _city_row() & (F.col("jumlah_event_ekstrem") > 0)


def _hour_row() -> Column:
    return (F.col("jenis") == "jam") & F.col("jam").isNotNull()


def _known_mean() -> Column:
    return F.col("suhu_avg").isNotNull()


def city_rows(rows: DataFrame) -> DataFrame:
    return (
        rows.filter(_city_row())
        .select(
            "kode_kota", "nama_kota", "suhu_avg", "suhu_tertinggi", "suhu_terendah", "jumlah_event"
        )
        .orderBy(F.col("suhu_avg").desc_nulls_last(), "kode_kota", "nama_kota")
    )


def extreme_rows(rows: DataFrame) -> DataFrame:
    return (
        rows.filter(_extreme_row())
        .select("kode_kota", "nama_kota", "jumlah_event_ekstrem")
        .orderBy(F.col("jumlah_event_ekstrem").desc(), "kode_kota", "nama_kota")
    )


def hour_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(_hour_row()).select("jam", "suhu_avg", "jumlah_event").orderBy("jam")


def totals(rows: DataFrame) -> DataFrame:
    return rows.filter(_city_row()).agg(
        F.coalesce(F.sum("jumlah_event"), F.lit(0)).alias("total_event"),
        F.coalesce(F.sum("jumlah_event_ekstrem"), F.lit(0)).alias("total_ekstrem"),
    )


def _best(fields: list[str], eligible: Column, *order: Column) -> Column:
    """The fields of the eligible row that is first in the order, NULL if there is none."""
    return F.min_by(F.struct(*fields), F.when(eligible, F.struct(*order)))


def insights(rows: DataFrame) -> DataFrame:
    """Three sentences, each with its own wording when there is no data for it.

    A global aggregate always gives one row, so no join is needed for the empty case.
    """
    best = rows.agg(
        _best(
            ["nama_kota", "suhu_avg"],
            _city_row() & _known_mean(),
            -F.col("suhu_avg"),
            F.col("kode_kota"),
        ).alias("panas"),
        _best(
            ["nama_kota", "jumlah_event_ekstrem"],
            _extreme_row(),
            -F.col("jumlah_event_ekstrem"),
            F.col("kode_kota"),
        ).alias("ekstrem"),
        _best(["jam", "suhu_avg"], _hour_row() & _known_mean(), F.col("suhu_avg"), F.col("jam")).alias(
            "dingin"
        ),
    )

    def sentence(topic: str, row: str, template: str, first: Column, second: str, fallback: str):
        told = F.format_string(template, first, F.col(f"{row}.{second}"))
        text = F.when(F.col(row).isNull(), F.lit(fallback)).otherwise(told)
        return F.struct(F.lit(topic).alias("topik"), text.alias("narasi"))

    return best.select(
        F.inline(
            F.array(
                sentence("suhu", "panas", HOTTEST, F.col("panas.nama_kota"), "suhu_avg", NO_TEMPERATURE),
                sentence(
                    "ekstrem",
                    "ekstrem",
                    MOST_EXTREME,
                    F.col("ekstrem.nama_kota"),
                    "jumlah_event_ekstrem",
                    NO_EXTREME,
                ),
                sentence("tren", "dingin", COLDEST, hour_label(F.col("dingin.jam")), "suhu_avg", NO_HOUR),
            )
        )
    )


# Most report rows in one document.
MOST_LISTED = 100_000


def _records(eligible: Column, order: list[Column], fields: list[str]) -> Column:
    """Rows as an ordered list of records."""
    keyed = F.struct(F.struct(*order).alias("k"), F.struct(*fields).alias("r"))
    return F.transform(
        F.sort_array(F.collect_list(F.when(eligible, keyed))), lambda entry: entry["r"]
    )


def dashboard_document(rows: DataFrame, pretty: bool = False) -> DataFrame:
    """The three results as one JSON document, one row.

    Only report rows are listed, one per city and one per hour. City codes are free text, so
    there may be any number: beyond MOST_LISTED rows the job fails, having brought no more
    than that together. For results of any size use the JSON directories, which are written
    by as many tasks as needed.
    """
    body = rows.limit(MOST_LISTED + 1).agg(
        F.count(F.lit(1)).alias("n"),
        _records(
            _city_row(),
            [F.col("suhu_avg").isNull(), -F.col("suhu_avg"), F.col("kode_kota")],
            ["kode_kota", "nama_kota", "suhu_avg", "suhu_tertinggi", "suhu_terendah", "jumlah_event"],
        ).alias("suhu_kota"),
        _records(
            _extreme_row(),
            [-F.col("jumlah_event_ekstrem"), F.col("kode_kota")],
            ["kode_kota", "nama_kota", "jumlah_event_ekstrem"],
        ).alias("ekstrem"),
        _records(_hour_row(), [F.col("jam")], ["jam", "suhu_avg", "jumlah_event"]).alias("tren_jam"),
    )
    options = {**KEEP_NULLS, "pretty": str(pretty).lower()}
    document = F.to_json(F.struct("suhu_kota", "ekstrem", "tren_jam"), options)
    refusal = F.raise_error(F.lit(f"the dashboard document lists at most {MOST_LISTED} rows; use the JSON directories"))
    return body.select(F.when(F.col("n") <= MOST_LISTED, document).otherwise(refusal).alias("dokumen"))

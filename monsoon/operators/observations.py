"""Service answers to observations: accept, shape, or reject with a reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon import schemas as S
from monsoon.functions.clock import iso_text
from monsoon.functions.wire import has_fields, json_object
from monsoon.sources.dimensions import cities

_REASON = "alasan"


def attach_city(raw: DataFrame, city_table: DataFrame | None = None) -> DataFrame:
    """City code and name for each answer, by its city code.

    The built-in table has six rows and is broadcast. A table passed in has an unknown
    size, so the join strategy is left to the optimizer's own size check.
    """
    if city_table is None:
        city_table = F.broadcast(cities(raw.sparkSession))
    names = city_table.select(F.col("kode"), F.col("nama").alias("nama_kota"))
    return raw.join(names, "kode", "left")


def _answer_schema() -> T.StructType:
    kinds = {f.name: f.dataType for f in S.OBSERVATION}
    return S.shape(current=S.shape(**{k: kinds[v] for k, v in S.RESPONSE_FIELDS.items()}))


def checked_responses(raw: DataFrame, city_table: DataFrame | None = None) -> DataFrame:
    """Answers with their parsed values and the reason for rejection, if any.

    A field that is there with null is accepted, an absent one is not. Typed parsing
    reads both as NULL, so the names of the fields are looked up where a value is NULL,
    and only there. The parsed values pass through a generator, below which no filter
    is pushed; otherwise each use of them in a filter would become a parse of its own.
    """
    current, fields = F.col("current"), list(S.RESPONSE_FIELDS)
    parsed = json_object(F.col("body"), _answer_schema())["current"]
    unknown = reduce(lambda a, b: a | b, (current[name].isNull() for name in fields))
    return (
        attach_city(raw, city_table)
        .select("*", F.inline(F.array(F.struct(parsed.alias("current")))))
        .withColumn(
            _REASON,
            F.when(F.col("body").isNull(), "no_answer")
            .when(current.isNull(), "no_current")
            .when(unknown & ~has_fields(F.col("body"), "$.current", fields), "missing_field")
            .when(F.col("nama_kota").isNull(), "unknown_city"),
        )
    )


def observation_columns() -> list[Column]:
    """The fields of an event, read from a checked answer."""
    return [
        F.col("kode").alias("kode_kota"),
        F.col("nama_kota"),
        *(F.col("current")[k].alias(v) for k, v in S.RESPONSE_FIELDS.items()),
        iso_text(F.col("fetched_at")).alias("timestamp"),
    ]


def rejected_columns() -> list[Column]:
    """A rejected answer, whole, with its reason."""
    return [
        F.col("kode"),
        F.col("body"),
        iso_text(F.col("fetched_at")).alias("fetched_at"),
        F.col(_REASON),
    ]


def is_accepted() -> Column:
    return F.col(_REASON).isNull()


def observations(checked: DataFrame, *keep: str) -> DataFrame:
    return checked.filter(is_accepted()).select(*keep, *observation_columns())


def rejected(checked: DataFrame, *keep: str) -> DataFrame:
    return checked.filter(~is_accepted()).select(*keep, *rejected_columns())

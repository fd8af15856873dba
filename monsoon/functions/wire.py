"""JSON on the wire."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.functions.text import from_bytes
from monsoon.schemas import CORRUPT

KEEP_NULLS = {"ignoreNullFields": "false"}

# White space that may stand around a JSON text.
BLANKS = " \t\r\n"


def json_text(*columns: Column | str) -> Column:
    """The columns as one JSON object, NULL fields written out."""
    return F.to_json(F.struct(*columns), KEEP_NULLS)


def decoded(value: Column, schema: T.StructType) -> Column:
    """The fields of a message, and CORRUPT: the text if it could not be parsed."""
    noted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(from_bytes(value), noted, {"columnNameOfCorruptRecord": CORRUPT})


def unreadable(record: Column, schema: T.StructType) -> Column:
    """Whether a record gave nothing: it could not be parsed and has no field at all.

    All declared fields are looked at, so the answer is the same whichever columns a query
    asks for; a record with one bad field keeps the others.
    """
    fields = [record.getField(name).cast("string") for name in schema.names]
    return record.isNull() | (
        record.getField(CORRUPT).isNotNull() & F.coalesce(*fields).isNull()
    )


def json_object(text: Column, schema: T.StructType) -> Column:
    """Typed fields of text that is one JSON object; all NULL for anything else."""
    bare = F.btrim(text, F.lit(BLANKS))
    whole = F.when(bare.endswith("}"), bare)
    return F.from_json(whole, schema, {"allowSingleQuotes": "false"})


def has_fields(text: Column, path: str, names: list[str]) -> Column:
    """Whether the JSON object at a path has all the fields, with null or not."""
    found = F.json_object_keys(F.get_json_object(text, path))
    wanted = F.array(*(F.lit(name) for name in names))
    return F.coalesce(F.size(F.array_except(wanted, found)) == 0, F.lit(False))

"""Times as text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column) -> Column:
    """Timestamp of an event, NULL for text in neither layout.

    The cast reads both the ISO and the blank-separated layout. It would also read
    a bare ``12:30`` as a time of today, hence the test for the dash after the year.
    """
    return F.when(F.substring(text, 5, 1) == "-", text).try_cast("timestamp")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def iso_text(ts: Column) -> Column:
    """ISO layout; a whole second carries no fraction."""
    return F.replace(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(".000000"), F.lit("")
    )


def plain_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def published_time(text: Column) -> Column:
    """Timestamp of a published text: the feed's own layout, else ISO.

    The weekday name is cut off because the parser takes no pattern letter for it;
    a zone given by name is written as its offset first.
    """
    dated = F.regexp_replace(
        F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", ""), r"\s(GMT|UTC|UT|Z)$", " +0000"
    )
    return F.coalesce(
        F.try_to_timestamp(dated, F.lit("d MMM yyyy HH:mm:ss Z")), event_time(text)
    )

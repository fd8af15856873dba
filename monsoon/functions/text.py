"""Text expressions: prefixes, keys, byte forms and display lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monsoon import schemas as S


def prefix(text: Column, n: int) -> Column:
    """First n characters (not bytes)."""
    return F.left(text, F.lit(n))


def link_key(link: Column) -> Column:
    """Routing key of an article. 32 bits only: never an identity."""
    return F.substring(F.md5(link), 1, 8)


def to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def from_bytes(raw: Column) -> Column:
    return raw.cast("string")


def key_text(raw: Column) -> Column:
    """Message key as text; an empty key reads as none."""
    return F.nullif(from_bytes(raw), F.lit(""))


def padded(text: Column, width: int) -> Column:
    """Left-aligned to a width; longer text is kept whole."""
    return F.format_string(f"%-{width}s", text)


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def _shown(value: Column) -> Column:
    """A value as display text, NULL shown the way the console shows it."""
    return F.coalesce(value.cast("string"), F.lit("None"))


# Fixed display formats.


def observation_line() -> Column:
    """One console line per observation, city name padded to ten."""
    return F.format_string(
        "  %s | %s | %s°C |  %s km/h |  %s%%",
        _shown(F.col("kode_kota")),
        padded(_shown(F.col("nama_kota")), 10),
        _shown(F.col("temperature")),
        _shown(F.col("wind_speed")),
        _shown(F.col("humidity")),
    )


def article_line() -> Column:
    return F.format_string("  → %s...", prefix(F.col("judul"), S.PREVIEW_TITLE_CHARS))


def message_line(place: str = "offset") -> Column:
    """``place`` names the column that tells where the message stands."""
    return F.format_string(
        f"  {place}=%s | key=%s | value=%s...", F.col(place), _shown(F.col("key")), F.col("value")
    )

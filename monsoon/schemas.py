"""Declared shapes and fixed values of the data model.

Everything is declared rather than inferred: an empty directory then reads as
zero rows, and a run of whole-number temperatures stays DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import types as T


def shape(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, WHOLE, REAL, INSTANT = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

OBSERVATION = shape(
    kode_kota=TEXT,
    nama_kota=TEXT,
    temperature=REAL,
    humidity=REAL,
    wind_speed=REAL,
    weather_code=WHOLE,
    timestamp=TEXT,
)

ARTICLE = shape(
    judul=TEXT, link=TEXT, ringkasan=TEXT, waktu_terbit=TEXT, sumber=TEXT, timestamp=TEXT
)

RAW_RESPONSE = shape(kode=TEXT, body=TEXT, fetched_at=INSTANT)

REJECTED = shape(kode=TEXT, body=TEXT, fetched_at=TEXT, alasan=TEXT)

RAW_FEED = shape(feed_ord=T.IntegerType(), feed_url=TEXT, xml=TEXT, fetched_at=INSTANT)

FEED_ITEM = shape(title=TEXT, link=TEXT, description=TEXT, pubDate=TEXT)
ATOM_ENTRY = shape(
    id=TEXT,
    title=TEXT,
    link=T.ArrayType(shape(_rel=TEXT, _type=TEXT, _href=TEXT)),
    summary=TEXT,
    content=TEXT,
    published=TEXT,
)

# RSS has a channel, Atom its namespace and entries; names with an underscore first are attributes.
FEED_DOCUMENT = shape(
    channel=shape(title=TEXT, item=T.ArrayType(FEED_ITEM)),
    _xmlns=TEXT,
    title=TEXT,
    entry=T.ArrayType(ATOM_ENTRY),
)

# The columns of Spark's own Kafka source that files can hold too. Partitions and offsets
# are the broker's own; files have none.
BUS = shape(topic=TEXT, timestamp=INSTANT, key=T.BinaryType(), value=T.BinaryType())
# As stored below a topic, with the id that a message keeps when it is sent again.
MESSAGE = T.StructType([*(f for f in BUS if f.name != "topic"), *shape(id=TEXT)])

CORRUPT = "_corrupt_record"

# --- Fixed values of the data model -----------------------------------------

# kode, nama, lat, lon
CITIES = [
    ("JKT", "Jakarta", -6.21, 106.85),
    ("SBY", "Surabaya", -7.25, 112.75),
    ("SMG", "Semarang", -6.99, 110.42),
    ("MDN", "Medan", -3.59, 98.67),
    ("MKS", "Makassar", -5.14, 119.41),
    ("DPS", "Denpasar", -8.67, 115.21),
]

FEEDS = [
    "https://www.antaranews.com/rss/warta-bumi.xml",
    "https://www.mongabay.co.id/feed/",
]

TOPIC_WEATHER = "weather-api"
TOPIC_NEWS = "weather-rss"
TOPIC_REJECTED = "weather-api-rejected"  # ours: answers that are no observation

POLL_WEATHER_SECONDS = 600
POLL_NEWS_SECONDS = 300
FLUSH_SECONDS = 120

# Service field -> event field
RESPONSE_FIELDS = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "wind_speed_10m": "wind_speed",
    "weather_code": "weather_code",
}

WIND_LIMIT = 40
HUMIDITY_LIMIT = 90
TEMPERATURE_LIMIT = 35

SUMMARY_CHARS = 300
PREVIEW_SUMMARY_CHARS = 200
PREVIEW_TITLE_CHARS = 70
PEEK_CHARS = 120
PREVIEW_ENTRIES = 3
PEEK_MESSAGES = 5
LATEST_NEWS = 10

ATOM = "http://www.w3.org/2005/Atom"
PAGE_TYPES = ["text/html", "application/xhtml+xml"]

NO_FEED_TITLE = "tidak ada judul"
ALIVE, DEAD = "🟢 berjalan", "🔴 mati"

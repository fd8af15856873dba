"""Reading topics: a Kafka broker, or files with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon import schemas as S
from monsoon.functions.clock import iso_text
from monsoon.functions.text import from_bytes, key_text, message_line, prefix
from monsoon.functions.wire import decoded, unreadable
from monsoon.session import matches

# For so long a message that comes again is known.
REMEMBERED = "1 day"


def read_topic(
    spark: SparkSession,
    topic: str,
    path: str | None = None,
    servers: str | None = None,
    stream: bool = False,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A topic from its earliest message.

    With ``servers`` the broker is read through Spark's Kafka source, which needs the
    connector on the class path; with ``path`` the file-backed bus. As a stream the
    checkpoint of the query keeps the position, in the role of a consumer group, and
    ``max_per_trigger`` (messages, or files) delays what is more to later batches.
    """
    reader = spark.readStream if stream else spark.read
    if servers:
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("includeHeaders", "true")
        )
        if stream and max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        own = F.get(F.filter("headers", lambda h: h["key"] == "id"), 0)["value"]
        place = F.concat("topic", F.lit("-"), "partition", F.lit("-"), "offset")
        return reader.load().withColumn("id", F.coalesce(from_bytes(own), place)).drop("headers")
    files = f"{path}/*/topic={topic}"
    if not stream and not matches(spark, files):
        return spark.createDataFrame([], T.StructType([S.BUS["topic"], *S.MESSAGE]))
    reader = reader.schema(S.MESSAGE)
    if stream and max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.parquet(files).select(F.lit(topic).alias("topic"), *S.MESSAGE.names)


def once(bus: DataFrame, within: str = REMEMBERED) -> DataFrame:
    """The messages of a stream, each once however often its writer sent it.

    Ids are remembered for ``within`` from the time a message was taken in, which is also
    what the watermark follows: no message is ever late, and the state is what arrived in
    that time. A message without an id, from another writer, is known by its content; on a
    broker by its place.
    """
    content = F.md5(F.to_json(F.struct("topic", "timestamp", "key", "value")))
    return (
        bus.withColumn("id", F.coalesce("id", content))
        .withColumn("_taken", F.current_timestamp())
        .withWatermark("_taken", within)
        .dropDuplicatesWithinWatermark(["id"])
        .drop("_taken")
    )


def _parsed(bus: DataFrame, schema: T.StructType) -> DataFrame:
    # Through a generator, below which no filter is pushed, each value is parsed once.
    return bus.select("*", F.inline(F.array(F.struct(decoded(F.col("value"), schema).alias("event")))))


def messages(bus: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Decoded events of a topic, with any bus columns asked for; see ``message_rejects``."""
    event = F.col("event")
    readable = _parsed(bus, schema).filter(~unreadable(event, schema))
    return readable.select(*keep, *(event.getField(f).alias(f) for f in schema.names))


def message_rejects(bus: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages ``messages`` leaves out: topic, key, text and the time they were sent."""
    return (
        _parsed(bus, schema)
        .filter(unreadable(F.col("event"), schema))
        .select(
            "topic",
            key_text(F.col("key")).alias("key"),
            from_bytes(F.col("value")).alias("isi"),
            iso_text(F.col("timestamp")).alias("dikirim"),
        )
    )


def _head() -> list[Column]:
    return [
        key_text(F.col("key")).alias("key"),
        prefix(from_bytes(F.col("value")), S.PEEK_CHARS).alias("value"),
    ]


def heads(bus: DataFrame) -> DataFrame:
    """Messages of a broker as a peek shows them: place, key and the head of the value."""
    return bus.select("partition", "offset", *_head())


def peek(bus: DataFrame, n: int = S.PEEK_MESSAGES) -> DataFrame:
    """The first n messages of a stored topic by time and key.

    Finding the last of them takes only the times. Values are then read up to it, and files
    or row groups beyond that are skipped.
    """
    last = bus.select("timestamp").orderBy("timestamp").limit(n).agg(F.max("timestamp")).scalar()
    return (
        bus.filter(F.col("timestamp") <= last)
        .orderBy("timestamp", "key", "value")
        .limit(n)
        .select(iso_text(F.col("timestamp")).alias("waktu"), *_head())
    )


def message_lines(shown: DataFrame) -> DataFrame:
    place = "offset" if "offset" in shown.columns else "waktu"
    return shown.select(message_line(place).alias("baris"))

"""Publishing keyed JSON messages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monsoon import schemas as S
from monsoon.functions.text import link_key, to_bytes
from monsoon.functions.wire import json_text
from monsoon.operators.observations import is_accepted, observation_columns, rejected_columns
from monsoon.session import matches

# The header that holds a message's id.
HEADER = "id"


def to_messages(
    events: DataFrame, topic: Column, key: Column, value: Column, sent_at: Column
) -> DataFrame:
    """Events as bus records. A broker numbers the messages itself and keeps those of one
    key in order."""
    return events.select(
        topic.alias("topic"),
        sent_at.cast("timestamp").alias("timestamp"),
        to_bytes(key).alias("key"),
        to_bytes(value).alias("value"),
    )


def weather_messages(events: DataFrame, sent_at: Column, extra: tuple = ()) -> DataFrame:
    """Weather events keyed by city, so one city stays in one partition of a broker."""
    value = json_text(*extra, *S.OBSERVATION.names)
    return to_messages(events, F.lit(S.TOPIC_WEATHER), F.col("kode_kota"), value, sent_at)


def answer_messages(checked: DataFrame, extra: tuple = ()) -> DataFrame:
    """Checked answers: observations to the weather topic, the others to a topic of
    their own. One parse of each answer and one stream serve both."""
    event = json_text(*extra, *observation_columns())
    refusal = json_text(*extra, *rejected_columns())
    return to_messages(
        checked,
        F.when(is_accepted(), S.TOPIC_WEATHER).otherwise(S.TOPIC_REJECTED),
        F.col("kode"),
        F.when(is_accepted(), event).otherwise(refusal),
        F.col("fetched_at"),
    )


def news_messages(articles: DataFrame, sent_at: Column, extra: tuple = ()) -> DataFrame:
    """Articles keyed by the short hash of their link."""
    value = json_text(*extra, *S.ARTICLE.names)
    return to_messages(articles, F.lit(S.TOPIC_NEWS), link_key(F.col("link")), value, sent_at)


def identified(messages: DataFrame, part: str) -> DataFrame:
    """Messages with an ``id`` that is the same whenever the part is sent again.

    It is made of the part's name and the message, so that neither the order of a repeated
    batch nor how it is split matters. Messages of one part that are alike in topic, time,
    key and value have one id.
    """
    content = F.to_json(F.struct(F.lit(part), "topic", "timestamp", "key", "value"))
    return messages.withColumn("id", F.md5(content))


def publish(
    messages: DataFrame,
    path: str | None = None,
    servers: str | None = None,
    part: str | None = None,
) -> None:
    """Write messages to the broker, or as one part of the file-backed bus.

    The bus is a directory of parts, each written once by one writer and divided by topic,
    and no log of files stands between writers and readers: whoever writes, every reader
    sees it. A part that is complete is left alone, so a repeated batch is stored once. A
    name is made up for a part without one. A broker may get a part again; its messages
    carry their ids as a header, by which ``once`` knows them.
    """
    part = part or f"part-{uuid.uuid4().hex}"
    if "id" not in messages.columns:
        messages = identified(messages, part)
    if servers:
        header = F.struct(F.lit(HEADER).alias("key"), to_bytes(F.col("id")).alias("value"))
        (
            messages.select("topic", "key", "value", F.array(header).alias("headers"))
            .write.format("kafka")
            .options(**broker_options(servers))
            .save()
        )
        return
    own = f"{path}/{part}"
    if not matches(messages.sparkSession, f"{own}/_SUCCESS"):
        messages.write.mode("overwrite").partitionBy("topic").parquet(own)


def broker_options(servers: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }

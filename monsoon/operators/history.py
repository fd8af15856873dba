"""Links sent before, kept in buckets, so that only what is new moves."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.operators.articles import first_seen, with_link
from monsoon.session import matches, put_text

BUCKETS = 512


class LinkHistory:
    """Every link ever sent, one row per link and part, in buckets by link.

    A part is a stored increment. Looking it up reads the history where it lies: each task
    takes one bucket and the increment's rows of that bucket, so the shuffle is as large as
    the increment whatever the history has grown to.

    The number of buckets is fixed when the history begins and is read from it afterwards;
    ``regroup`` writes the history anew with another one. A bucket should stay below some
    250 MB. Two jobs must not add to one history at the same time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path
        if not matches(spark, self._state):
            self._point_to(buckets)
        state = json.loads(spark.read.text(self._state).first().value)
        self.buckets, self.place = state["buckets"], state["links"]

    @property
    def _state(self) -> str:
        return f"{self.path}/state.json"

    def _point_to(self, buckets: int, place: str | None = None) -> None:
        place = place or f"{self.path}/links-{uuid.uuid4().hex}"
        self._table(place, buckets)
        put_text(self.spark, self._state, json.dumps({"buckets": buckets, "links": place}))

    def _table(self, place: str, buckets: int) -> str:
        """The files at a place as a table of the session, which alone can have buckets."""
        name = f"links_{hashlib.sha256(place.encode()).hexdigest()[:16]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (link STRING, part STRING) USING parquet "
            f"CLUSTERED BY (link) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return name

    def links(self) -> DataFrame:
        name = self._table(self.place, self.buckets)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def not_sent_before(self, articles: DataFrame, order: list, part: str | None = None) -> DataFrame:
        """The first article of each link that no part but ``part`` holds.

        Articles are reduced to one per link before they are dealt to the buckets, so a
        link with many of them sends one per task.
        """
        others = self.links().filter(F.col("part") != part) if part else self.links()
        dealt = first_seen(articles, order).repartition(self.buckets, "link")
        return dealt.join(others.select("link"), "link", "left_anti")

    def take(self, articles: DataFrame, order: list, part: str) -> DataFrame:
        """Store what is new as a part, remember its links, and give it back.

        A part that is taken again, after a failure or by mistake, replaces itself: its own
        links do not count as sent. Links remembered twice are harmless.
        """
        place = f"{self.path}/part={part}"
        self.not_sent_before(articles, order, part).write.mode("overwrite").parquet(place)
        new = self.spark.read.schema(articles.schema).parquet(place)
        self.remember(new, part)
        return new

    def remember(self, articles: DataFrame, part: str) -> None:
        """Add the links of a part; each bucket gets one file at most."""
        links = with_link(articles).select("link").distinct()
        self._add(links.select("link", F.lit(part).alias("part")), self._table(self.place, self.buckets), self.buckets)

    def _add(self, links: DataFrame, table: str, buckets: int) -> None:
        links.repartition(buckets, "link").write.insertInto(table)

    def regroup(self, buckets: int | None = None) -> None:
        """One file per bucket again, and as many buckets as asked for.

        The new files are whole before the history points to them; readers of the old
        ones go on, and the old ones are left to the storage's retention.
        """
        buckets = buckets or self.buckets
        place = f"{self.path}/links-{uuid.uuid4().hex}"
        self._add(self.links().distinct(), self._table(place, buckets), buckets)
        self._point_to(buckets, place)
        self.buckets, self.place = buckets, place

"""One document of each group of near-duplicates, by fingerprint and by whole sets.

Documents link when their SimHash fingerprints lie within the radius (ball hashing, see
``simhash``) or when the sets of their word shingles reach the bar (bands and confirmation,
see ``minhash``). Only ids and hashes are grouped; the texts of the documents that stay are
fetched once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monsoon.llm import minhash, simhash
from monsoon.llm.common import spread_join, written

ABOVE, BELOW = 4, 5


def _key() -> Column:
    """Orders as (doc_id, null last; hash of text) does."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))
    return F.unhex(
        F.concat(
            F.when(F.col("doc_id").isNull(), "01").otherwise("00"),
            F.lpad(F.hex(doc), 16, "0"),
            F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32),
        )
    )


def _hashed(width: int):
    sign = minhash._signer(width)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = minhash._bytes(batch.column(1))
            prints = pa.array([simhash.fingerprint(t.as_py()) for t in texts], pa.int64())
            for out in sign([batch]):
                yield pa.RecordBatch.from_arrays([*out.columns, prints], names=[*out.schema.names, "fp"])

    return run


def one_of_near(
    docs: DataFrame, width: int = minhash.SHINGLE, above: int = ABOVE, below: int = BELOW, radius: int = simhash.RADIUS
) -> DataFrame:
    """The rows of ``docs``, one for each group of linked documents, with all their columns.

    The row with the least (doc_id, null last; hash of text) stays; rows equal in both count
    as one. Texts without words, or null, have the fingerprint zero and link with each other,
    as copies do. An empty table gives no rows.
    """
    rows = docs.select(F.struct(_key().alias("key"), minhash.body().alias("body")).alias("row"), "text")
    schema = "row struct<key:binary,body:binary>, set_id binary, n long, bands array<long>, fp long"
    found = written(
        rows.mapInArrow(_hashed(width), schema).select("row.key", "row.body", "set_id", "n", "bands", "fp"), "hashed"
    )
    prints = simhash.groups(found.select(F.col("key").alias("row"), "fp"), radius)
    sets = minhash.set_groups(found, docs.select(minhash.body().alias("body"), "text"), width, above, below)
    both = written(found.filter("set_id IS NOT NULL").select("fp", "set_id").distinct(), "both")
    near = spread_join(both, prints, "fp", "n", F.xxhash64("set_id")).select("set_id", F.col("component_id").alias("group"))
    linked = written(
        spread_join(near, sets, "set_id", "times", F.xxhash64("group")).select("root", "group").distinct(), "linked"
    )
    # A group of fingerprints is named by the least row it has; groups that share a set, or
    # similar sets, become one, named by the least of these.
    least = written(
        linked.groupBy("root").agg(F.min("group").alias("a"), F.count(F.lit(1)).alias("times")).filter("times > 1"),
        "least",
    )
    pairs = spread_join(linked, least, "root", "times", F.xxhash64("group")).filter(F.col("group") != F.col("a"))
    gone = simhash.components(pairs.select("a", F.col("group").alias("b")).distinct())
    kept = prints.select(F.col("component_id").alias("key")).distinct()
    kept = written(kept.join(gone.select(F.col("node").alias("key")).hint("merge"), "key", "left_anti"), "kept")
    packed = docs.select(F.struct("*").alias("whole"), _key().alias("key"))
    stay = packed.join(kept.hint("merge"), "key", "left_semi")
    # Numbered where the join leaves the rows, so that the texts are shuffled once.
    copy = F.row_number().over(W.partitionBy("key").orderBy("key"))
    return stay.withColumn("copy", copy).filter("copy = 1").select("whole.*")

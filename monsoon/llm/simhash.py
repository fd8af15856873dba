"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints within the radius share a variant that is within half the radius of both.
Every distinct fingerprint emits all its variants within half the radius; after a shuffle
on the variant, neighbours under one variant are candidate pairs. Distinct fingerprints
under one variant number at most 65, however many documents are copies, and consecutive
ones connect them all, so no group emits all its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import spread_join, table, written

SHINGLE = 3
SEED = 42
RADIUS = 2
BITS = 64
STEP = 1 << 16


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of UTF-8 bytes.

    ASCII capitals are lowered and words end at ASCII white space. Fewer words than the
    width make one shingle of all; no words, or null, the fingerprint zero.
    """
    from itertools import repeat

    import numpy as np
    from xxhash import xxh64_digest

    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    hashes = np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(SEED))), dtype=np.uint8)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8 * STEP):
        part = hashes[at : at + 8 * STEP].reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * counts > len(shingles))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def _fingerprints(width: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1)
            if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type):
                texts = texts.cast(pa.large_binary())
            found = [fingerprint(t.as_py(), width) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["row", "fp"]
            )

    return run


def fingerprints(rows: DataFrame, row: str, text: str, width: int = SHINGLE) -> DataFrame:
    """The column ``row`` as it is, and ``fp``, the fingerprint of the column ``text``."""
    schema = T.StructType(
        [T.StructField("row", rows.schema[row].dataType), T.StructField("fp", T.LongType())]
    )
    return rows.select(row, text).mapInArrow(_fingerprints(width), schema)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, that connect all fingerprints ``fp`` within the radius.

    The radius is 0, 1, 2 or 3: half of it, one flipped bit at most, is what each side emits
    for 2; for 3 the sides meet at one and two bits, for which two are emitted.
    """
    half = (radius + 1) // 2
    flips = [F.lit(0).cast("long")]
    if half >= 1:
        flips += [F.lit(_signed(1 << i)) for i in range(BITS)]
    if half >= 2:
        flips += [F.lit(_signed(1 << i | 1 << j)) for i in range(BITS) for j in range(i)]
    variants = distinct.select("fp", F.explode(F.array(*flips)).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant")
    )
    order = W.partitionBy("variant").orderBy("fp")
    # All under one variant lie within 2 * half of each other; an odd radius is verified
    # against every earlier one, an even one needs the previous only.
    if radius % 2 == 0:
        found = variants.select(F.lag("fp").over(order).alias("a"), F.col("fp").alias("b"))
    else:
        earlier = order.rowsBetween(W.unboundedPreceding, -1)
        found = variants.select(F.collect_list("fp").over(earlier).alias("a"), "fp")
        found = found.select(F.explode("a").alias("a"), F.col("fp").alias("b"))
    return (
        found.filter(F.col("a").isNotNull())
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    )


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for the nodes of the pairs (a, b): root is its component's least node.
    A root has no row of its own.

    Alternates the two star contractions until nothing changes. Each round is written to
    the shared folder; the driver sees only a count and a checksum of the pairs.
    """
    stars = written(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")), "stars")
    before = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .filter(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        stars = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        stars = written(stars, "stars")
        after = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def groups(found: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per distinct fingerprint: fp, n rows, and component_id, the least ``row``
    that its component reaches (null if all of them are null)."""
    distinct = written(
        found.groupBy("fp").agg(F.min("row").alias("least"), F.count(F.lit(1)).alias("n")), "fingerprints"
    )
    roots = components(links(distinct, radius))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count(F.lit(1)).alias("weight")
    )
    joined = spread_join(rooted, ids, "root", "weight", F.xxhash64("fp"))
    return written(joined.select("fp", "n", "component_id"), "groups")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Rows link when their fingerprints differ in at most ``radius`` bits. Null and empty
    texts have the fingerprint zero and link like any other. A null doc_id never is a
    component's id unless all are null; repeated rows stay repeated. Other columns are
    ignored, an empty table gives no rows.
    """
    found = written(fingerprints(docs, "doc_id", "text", width), "fingerprints")
    return spread_join(
        found, groups(found, radius), "fp", "n", F.xxhash64("row")
    ).select(
        F.col("row").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, one for each group of near-duplicates, with all their columns.

    The row with the least (doc_id, text) stays, a null doc_id last. Rows equal in both
    count as one.
    """
    key = _row_key()
    packed = docs.select(F.struct("*").alias("whole"), key.alias("row"), F.col("text").alias("body"))
    found = written(fingerprints(packed, "row", "body", width), "fingerprints")
    first = groups(found, radius).select("component_id").distinct()
    kept = packed.join(first, packed.row == first.component_id, "left_semi")
    # Numbered in the partitions and the order that the join leaves, so that the texts are
    # shuffled once.
    copy = F.row_number().over(W.partitionBy("row").orderBy("row"))
    return kept.withColumn("copy", copy).filter("copy = 1").select("whole.*")


def _row_key() -> Column:
    """Orders as (doc_id, null last; text) does and tells apart rows that differ in them.

    Cast to the type it has once written, lest a join casts it and loses its partitioning.
    """
    return F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("digest"),
    ).cast("struct<none:boolean,id:bigint,digest:string>")


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

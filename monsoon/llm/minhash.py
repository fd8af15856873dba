"""Near-duplicates by circulant MinHash, confirmed on whole sets of word shingles.

Two permutations make every coordinate of a signature: the first scatters the shingles of a
text over the numbers of 32 bits, the second is shifted by one place from a coordinate to the
next, round the end of the range. Bands of a few coordinates are buckets. With 32 bands of
four, two sets at a similarity of 0.85 share no bucket once in 10^10 pairs, at 0.8 once in
2 * 10^7.

No bucket is expanded into its pairs. Copies of one set are one member. Every member of a
bucket is compared with the bucket's most central one, that with the smallest share of
shingles no other candidate has. A set cannot be similar to any other if too many of its
shingles are its own, so heavily edited copies are ruled out by a count, exactly. Only
members that are still in different components after that meet each other, and only if
the shingles that few of them have, listed for each, leave room for a link. So no link is
lost, and of a group of copies about as many pairs are confirmed as it has members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import spread_join, table, written
from monsoon.llm.simhash import components

SHINGLE = 5
# The bar as a fraction, so that it is compared in whole numbers.
ABOVE, BELOW = 85, 100
SEED = 42
BANDS, ROWS = 32, 4
# Hashes and coordinates that are held at once, per text.
STEP = 1 << 11
# Shingles of so many of the sets left at most are listed; any number gives the same links.
RARE = 64


def shingles(text: bytes | None, width: int = SHINGLE):
    """The distinct 64-bit hashes of a text's word shingles, in rising order.

    ASCII capitals are lowered and words end at ASCII white space. Fewer words than the
    width make one shingle of all; no words, or null, none.
    """
    from itertools import repeat

    import numpy as np
    from xxhash import xxh64_digest

    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.int64)
    if len(words) < width:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.frombuffer(b"".join(map(xxh64_digest, joined, repeat(SEED))), dtype=np.int64))


def _permuted(x):
    """A permutation of the numbers of 32 bits, in place."""
    import numpy as np

    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes, size: int = BANDS * ROWS):
    """``size`` coordinates of a set that is not empty: the least image of the scattered
    shingles under the second permutation, shifted by the coordinate's number."""
    import numpy as np

    # The upper halves of good hashes are the elements; the first permutation scatters them.
    first = _permuted((hashes.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
    first *= np.uint32(0x9E3779B1)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(first), STEP):
        least = np.minimum(least, _permuted(first[None, at : at + STEP] + shifts).min(axis=1))
    return least


def band_keys(coordinates, bands: int = BANDS):
    """A 64-bit key for each band, the band's number mixed in."""
    import numpy as np

    rows = coordinates.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for row in rows.T:
        key = (key ^ row) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _bytes(column):
    import pyarrow as pa

    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary())
    return column


def _signer(width: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            ids, sizes, keys = [], [], []
            for text in _bytes(batch.column(1)):
                found = shingles(text.as_py(), width)
                sizes.append(len(found))
                ids.append(xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(band_keys(signature(found)) if len(found) else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["row", "set_id", "n", "bands"],
            )

    return run


def signed(rows: DataFrame, row: str, text: str, width: int = SHINGLE) -> DataFrame:
    """``row`` as it is; set_id, a 128-bit hash of the text's set (null for an empty one);
    n, the set's size; and the keys of its bands."""
    schema = T.StructType(
        [
            T.StructField("row", rows.schema[row].dataType),
            T.StructField("set_id", T.BinaryType()),
            T.StructField("n", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    return rows.select(row, text).mapInArrow(_signer(width), schema)


def _sets(width: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [shingles(text.as_py(), width).tobytes() for text in _bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], names=["id", "hashes"]
            )

    return run


def _members(batches):
    """A row per shingle: its hash and the two halves of the set's id."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for name, hashes in zip(batch.column(0), batch.column(1), strict=True):
            found = np.frombuffer(hashes.as_py(), dtype=np.int64)
            high, low = np.frombuffer(name.as_py(), dtype=">i8")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found),
                    pa.array(np.full(len(found), high, np.int64)),
                    pa.array(np.full(len(found), low, np.int64)),
                ],
                names=["shingle", "high", "low"],
            )


def _exploded(batches):
    """A row per shingle: the set's id and the hash."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for name, hashes in zip(batch.column(0), batch.column(1), strict=True):
            found = pa.array(np.frombuffer(hashes.as_py(), dtype=np.int64))
            names = pa.array([name.as_py()], pa.binary()).take(pa.array(np.zeros(len(found), dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([names, found], names=["id", "shingle"])


def _rare(ids: DataFrame, sets: DataFrame) -> DataFrame:
    """For each of the ids: rare, its shingles that few other ones of them have, and n_few,
    how many shingles are rare or its own."""
    each = written(
        sets.join(ids.hint("merge"), "id", "left_semi").mapInArrow(_exploded, "id binary, shingle long"), "rest_shingles"
    )
    times = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") <= RARE)
    return (
        each.join(times.hint("merge"), "shingle")
        .groupBy("id")
        .agg(F.collect_list(F.when(F.col("times") > 1, F.col("shingle"))).alias("rare"), F.count(F.lit(1)).alias("n_few"))
    )


def _confirmed(above: int, below: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_py(), dtype=np.int64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(below * both >= above * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, above: int, below: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets reach the bar."""
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(_confirmed(above, below), "a binary, b binary")


def _common(n: str) -> Column:
    return F.col(n) - F.col(f"{n}_own")


def links(texts: DataFrame, nodes: DataFrame, width: int = SHINGLE, above: int = ABOVE, below: int = BELOW) -> DataFrame:
    """Pairs (a, b) of set ids that connect all sets whose similarity reaches the bar.

    ``nodes`` has a row per distinct set: id, n, bands, and ``body``, the md5 of one text
    that has the set; ``texts`` has body and text, and may repeat them.
    """
    members = nodes.select("id", "n", F.explode("bands").alias("bucket"))
    shared = written(
        members.groupBy("bucket").agg(F.count(F.lit(1)).alias("times")).filter("times > 1"), "buckets"
    )
    spread = F.xxhash64("id")
    members = written(spread_join(members, shared, "bucket", "times", spread), "members")
    asked = members.select("id").distinct().join(nodes.select("id", "body"), "id")
    # Copies become one text within each task, before they meet at their key.
    once = texts.groupBy("body").agg(F.min("text").alias("text"))
    found = once.join(asked.hint("merge"), "body").select("id", "text")
    sets = written(found.mapInArrow(_sets(width), "id binary, hashes binary"), "sets")

    # A shingle of one candidate only names it by the halves of its id.
    alone = (
        sets.mapInArrow(_members, "shingle long, high long, low long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("times"), F.bit_xor("high").alias("high"), F.bit_xor("low").alias("low"))
        .filter("times = 1")
        .groupBy("high", "low")
        .agg(F.count(F.lit(1)).alias("n_own"))
        .select(
            F.unhex(F.concat(F.lpad(F.hex("high"), 16, "0"), F.lpad(F.hex("low"), 16, "0"))).alias("id"), "n_own"
        )
    )
    # An overlap is no more than what is not a set's own, and no less than the bar asks for.
    counted = written(
        members.select("id", "n").distinct().join(alone.hint("merge"), "id", "left").select(
            "id", F.coalesce("n_own", F.lit(0)).alias("n_own")
        ),
        "own",
    )
    usable = members.join(counted.hint("merge"), "id").filter(
        _common("n") * below >= F.col("n") * above
    )
    usable = written(usable, "usable")
    centre = F.min(F.struct((F.col("n_own") / F.col("n")).alias("share"), "id", "n", "n_own"))
    centres = written(
        usable.groupBy("bucket")
        .agg(centre.alias("centre"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1"),
        "centres",
    )
    starred = spread_join(usable, centres, "bucket", "times", spread).select(
        "bucket",
        "id",
        "n",
        "n_own",
        F.col("centre.id").alias("c"),
        F.col("centre.n").alias("m"),
        F.col("centre.n_own").alias("m_own"),
    )
    # both * below >= above * (n + m - both), for the most that both can be.
    allowed = F.least(_common("n"), _common("m")) * (above + below) >= (F.col("n") + F.col("m")) * above
    star = (
        starred.filter((F.col("id") != F.col("c")) & allowed)
        .select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b"))
        .distinct()
    )
    first = written(_confirm(star, sets, above, below), "links")

    roots = components(first)
    rooted = usable.join(roots.select(F.col("node").alias("id"), "root").hint("merge"), "id", "left").withColumn(
        "root", F.coalesce("root", "id")
    )
    rooted = written(rooted.select("bucket", "id", "n", "n_own", "root"), "rooted")
    several = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    several = several.filter("low <> high").select("bucket")
    left = written(
        rooted.join(several.hint("merge"), "bucket", "left_semi")
        .join(centres.select("bucket", F.col("centre.id").alias("c")).hint("merge"), "bucket")
        .filter(F.col("id") != F.col("c"))
        .select("bucket", "id", "n", "root"),
        "rest",
    )
    few = _rare(left.select("id").distinct(), sets)
    none = F.array().cast("array<bigint>")
    known = written(
        left.join(nodes.select("id", "bands").hint("merge"), "id")
        .join(few.hint("merge"), "id", "left")
        .withColumns({"rare": F.coalesce("rare", none), "common": F.col("n") - F.coalesce("n_few", F.lit(0))}),
        "rest_known",
    )
    x = known.select("bucket", "bands", F.col("id").alias("a"), "n", "common", "rare", F.col("root").alias("ra"))
    y = known.select(
        "bucket",
        F.col("bands").alias("other_bands"),
        F.col("id").alias("b"),
        F.col("n").alias("m"),
        F.col("common").alias("other_common"),
        F.col("rare").alias("other_rare"),
        F.col("root").alias("rb"),
    )
    # What two sets share are rare shingles, which are listed, and others, of which the one
    # that has fewer sets the limit.
    both = F.least("common", "other_common") + F.size(F.array_intersect("rare", "other_rare"))
    # A pair with several buckets in common is made in that with the least key.
    here = F.array_min(F.array_intersect("bands", "other_bands")) == F.col("bucket")
    rest = (
        x.join(y.hint("merge"), "bucket")
        .filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")))
        .filter((both * (above + below) >= (F.col("n") + F.col("m")) * above) & here)
        .select("a", "b")
    )
    return first.union(_confirm(written(rest, "rest_pairs"), sets, above, below))


def set_groups(
    found: DataFrame, texts: DataFrame, width: int = SHINGLE, above: int = ABOVE, below: int = BELOW
) -> DataFrame:
    """set_id, times (rows that have it) and root, the least set id that its component
    reaches. ``found`` is ``signed`` with a column ``body``; ``texts`` as ``links`` has it."""
    nodes = written(
        found.filter("set_id IS NOT NULL")
        .groupBy(F.col("set_id").alias("id"))
        .agg(
            F.max("n").alias("n"),
            F.first("bands").alias("bands"),
            F.min("body").alias("body"),
            F.count(F.lit(1)).alias("times"),
        ),
        "nodes",
    )
    pairs = written(links(texts, nodes, width, above, below), "pairs")
    roots = components(pairs)
    joined = nodes.join(roots.hint("merge"), nodes.id == roots.node, "left")
    return written(
        joined.select(F.col("id").alias("set_id"), "times", F.coalesce("root", "id").alias("root")), "set_groups"
    )


def body(text: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, above: int = ABOVE, below: int = BELOW
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows link when below * (size of the intersection) >= above * (size of the union) of their
    sets. A null, empty or blank text has an empty set, links with nothing, and is kept. A
    null doc_id is never a component's id unless all are null; such rows are kept then.
    Repeated rows stay repeated. Columns other than doc_id and text are ignored. An empty
    table gives no rows. Sets are compared by 64-bit hashes of their shingles.
    """
    rows = docs.select(F.struct("doc_id", body().alias("body")).alias("row"), "text")
    found = written(
        signed(rows, "row", "text", width).select("row.doc_id", "row.body", "set_id", "n", "bands"), "signed"
    )
    groups = set_groups(found, docs.select(body().alias("body"), "text"), width, above, below)
    least = found.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    rooted = written(groups.join(least.hint("merge"), "set_id"), "rooted_sets")
    ids = written(
        rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("weight")),
        "component_ids",
    )
    per_set = written(
        spread_join(rooted, ids, "root", "weight", F.xxhash64("set_id")).select("set_id", "times", "component_id"),
        "per_set",
    )
    joined = spread_join(
        found.select("doc_id", "set_id", "n", "body"), per_set, "set_id", "times", F.xxhash64("doc_id", "body"), "left"
    )
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

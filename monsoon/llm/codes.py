"""Vector codes by Lloyd rounds whose members stay where they are.

Vectors of whole numbers are cut into parts, one per position. A part lives with the entry of
its position's codebook that is nearest to it: rows are placed by (position, entry, salt), the
salt dealing the parts of a crowded entry to several owners. A round sums the members that an
owner holds, without a shuffle, and makes new entries of the sums of all owners; then every
member looks for its nearest entry where it lies, and only those that change their entry move
in the next shuffle. Members are kept as bucketed tables, so that Spark knows where they are.

The codebooks, positions times entries, are all that the driver sees.
"""

from __future__ import annotations

import hashlib
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import discarded, spread_join, table, written
from monsoon.llm.topk import quantized
from monsoon.llm.vectors import EXACT, LONG, padded, whole
from monsoon.session import scratch, using

SCALE = 1024
POSITIONS = 4
ENTRIES = 256
ROUNDS = 4
OWNER_PARTS = 500_000
# A component beyond this counts as this.
MOST = 2.0**53

PLACE = ["position", "entry", "salt"]
MEMBER = "position int, entry int, salt int, part array<double>"

# The bucketed tables are scanned by bucket, wherever that is of use to later tasks only.
BY_BUCKET = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}

Codebooks = list[list[list[int]]]


def nearest(parts, entries: list[list[int]]):
    """The index of the nearest entry for each row of a matrix, ties to the lower, and the
    squared distance; exact at every size."""
    import numpy as np

    book = np.array(entries, dtype=np.float64).reshape(len(entries), -1)
    most = max(np.abs(parts).max(initial=0.0), max((abs(x) for e in entries for x in e), default=0))
    if 8 * most * most * max(1, book.shape[1]) < EXACT:
        found = (parts * parts).sum(axis=1)[:, None] - 2 * (parts @ book.T) + (book * book).sum(axis=1)
        best = found.argmin(axis=1)
        return best, found[np.arange(len(best)), best].astype(np.int64)
    exact = [
        min((sum((a - b) ** 2 for a, b in zip(row, entry, strict=True)), at) for at, entry in enumerate(entries))
        for row in whole(parts)
    ]
    return (
        np.array([at for _, at in exact], dtype=np.int64),
        np.array([min(d, LONG) for d, _ in exact], dtype=np.int64),
    )


def _lists(matrix):
    import numpy as np
    import pyarrow as pa

    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(matrix).ravel()))


def _cut(codebooks: Codebooks, salts: int):
    """Parts of the vectors, each with its nearest entry and a salt."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        size = len(codebooks[0][0])
        at = 0
        for batch in batches:
            vectors = padded(batch.column(0), size * len(codebooks))
            salt = (np.arange(at, at + len(vectors)) % salts).astype(np.int32)
            at += len(vectors)
            for position, entries in enumerate(codebooks):
                parts = vectors[:, position * size : (position + 1) * size]
                entry = nearest(parts, entries)[0].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(parts), position, np.int32)),
                        pa.array(entry),
                        pa.array(salt),
                        _lists(parts),
                    ],
                    names=[*PLACE, "part"],
                )

    return run


def _looked(codebooks: Codebooks):
    """Members as they are, and ``next``, the entry that is now nearest."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            position = batch.column(0).to_numpy()
            parts = padded(batch.column(3), len(codebooks[0][0]))
            new = np.zeros(len(position), dtype=np.int32)
            for at in np.unique(position):
                here = position == at
                new[here] = nearest(parts[here], codebooks[at])[0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(new)], names=[*PLACE, "part", "next"]
            )

    return run


def _coded(codebooks: Codebooks):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            code, error = np.full(n, "", dtype=object), np.zeros(n, dtype=np.float64)
            size = len(codebooks[0][0])
            vectors = padded(batch.column(2), size * len(codebooks))
            exact = [0] * n
            for position, entries in enumerate(codebooks):
                best, distance = nearest(vectors[:, position * size : (position + 1) * size], entries)
                code = code + np.array([f"{e:02x}" for e in best], dtype=object)
                error += distance
                exact = [a + int(b) for a, b in zip(exact, distance, strict=True)] if error.max() >= EXACT else exact
            errors = [min(e, LONG) for e in exact] if error.max(initial=0) >= EXACT else error.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(errors, pa.int64())],
                names=["row", "label", "code", "error"],
            )

    return run


class _Members:
    """Where the parts are: a bucketed table of members and what is nearest to them now."""

    def __init__(self, spark: SparkSession, owners: int):
        self.spark, self.owners = spark, owners
        self.name = self.path = None

    def put(self, rows: DataFrame) -> None:
        """Write the members in the buckets they are in; the table before is not needed any more."""
        name, path = f"members_{uuid.uuid4().hex}", scratch(self.spark, "members")
        rows.write.bucketBy(self.owners, *PLACE).option("path", path).saveAsTable(name)
        self.drop()
        self.name, self.path = name, path

    def drop(self) -> None:
        if self.name:
            self.spark.sql(f"DROP TABLE {self.name}")
            discarded(self.spark, self.path)
        self.name = self.path = None

    def rows(self) -> DataFrame:
        """All members at the entry nearest to them. Those that stay are read where they lie,
        only the others are shuffled."""
        found = self.spark.table(self.name)
        stay = found.filter("next = entry").drop("next")
        go = found.filter("next <> entry").withColumn("entry", F.col("next")).drop("next")
        return stay.union(go.repartition(self.owners, *PLACE))


def _updated(members: DataFrame, codebooks: Codebooks, kind: str) -> Codebooks:
    """Entries as the rounded-down means of their members; those without any stay."""
    size = len(codebooks[0][0])
    sums = [F.sum(F.col("part")[i].cast(kind).cast("decimal(38,0)" if kind != "long" else kind)).alias(f"s{i}") for i in range(size)]
    owned = members.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n"), *sums)
    totals = owned.groupBy("position", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(size))
    )
    out = [[list(e) for e in book] for book in codebooks]
    for row in totals.collect():  # positions times entries at most
        out[row.position][row.entry] = [int(row[f"s{i}"]) // row.n for i in range(size)]
    return out


def fitted(
    vectors: DataFrame,
    positions: int = POSITIONS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    owner_parts: int = OWNER_PARTS,
) -> Codebooks:
    """Codebooks for ``vectors`` (vec_id, and vector, an array of whole doubles).

    They start as the parts of the first ``entries`` vectors by (vec_id, null last; vector).
    Shorter vectors count as filled with zeros, up to the longest and a multiple of
    ``positions``. Fewer vectors than entries make shorter codebooks; none at all make
    codebooks of one entry of zeros, which nothing uses.
    """
    spark = vectors.sparkSession
    most = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    seen = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.max(most).alias("most")
    ).first()
    size = max(1, math.ceil((seen.width or 0) / positions))
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    start = [[int(x) for x in r.vector] + [0] * (size * positions - len(r.vector)) for r in first]
    start = start or [[0] * (size * positions)]
    codebooks = [[v[p * size : (p + 1) * size] for v in start] for p in range(positions)]
    if not seen.n:
        return codebooks
    parts = seen.n * positions
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(parts / owner_parts))
    salts = max(1, owners // positions)
    kind = "long" if (seen.most or 0) * seen.n < 2.0**62 else "decimal(38,0)"
    members = _Members(spark, owners)
    with using(spark, BY_BUCKET):
        placed = vectors.select("vector").mapInArrow(_cut(codebooks, salts), MEMBER).repartition(owners, *PLACE)
        members.put(placed.withColumn("next", F.col("entry")))
        for at in range(rounds):
            codebooks = _updated(members.rows(), codebooks, kind)
            if at < rounds - 1:
                members.put(members.rows().mapInArrow(_looked(codebooks), MEMBER + ", next int"))
        members.drop()
    return codebooks


def coded(rows: DataFrame, codebooks: Codebooks) -> DataFrame:
    """row and label as they are, ``code`` (two hex digits per position) and ``error``, the
    squared distances to the nearest entries, at most a long's limit."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("row", "label"))
    return rows.select("row", "label", "vector").mapInArrow(_coded(codebooks), f"{kinds}, code string, error long")


def digest(codebooks: Codebooks) -> str:
    """SHA-256 of all components by position, entry and place within it."""
    return hashlib.sha256(",".join(str(x) for book in codebooks for e in book for x in e).encode()).hexdigest()


def compressed(docs: DataFrame, vector: str = "embedding", scale: int = SCALE, **settings) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row with a usable vector.

    A vector that is null or has a null or non-finite component takes no part. Components are
    floor(scale * x), held within 2**53 either way; errors beyond a long are its limit. Null
    and repeated ids and repeated rows are coded like any other; null labels are one label.
    Other columns are ignored. An empty table gives no rows.
    """
    held = F.transform(quantized(F.col(vector), scale), lambda x: F.greatest(F.least(x, F.lit(MOST)), F.lit(-MOST)))
    kept = docs.select("vec_id", F.col("label").cast("string").alias("label"), held.alias("vector"))
    kept = written(kept.filter("vector IS NOT NULL"), "vectors")
    codebooks = fitted(kept, **settings)
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    rows = kept.select(F.col("vec_id").alias("row"), key.alias("label"), "vector")
    found = written(coded(rows, codebooks), "codes")
    sums = written(
        found.groupBy("label").agg(
            F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)"))
            .cast("long")
            .alias("label_error"),
            F.count(F.lit(1)).alias("times"),
        ),
        "label_errors",
    )
    return spread_join(found, sums, "label", "times", F.xxhash64("row", "code", "error")).select(
        F.col("row").alias("vec_id"),
        "code",
        "error",
        "label_error",
        F.lit(digest(codebooks)).alias("codebooks_sha256"),
    )


def codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))

"""Exact top-k search by tiled matrix products.

Queries are dealt to blocks and candidates to shards of bounded size. Every pair of a block
and a shard is a tile, a task's unit of work: one matrix product, and for each query the
best few of the tile. The lists of a query are merged in a tree with a fixed fan-in, so no
task sees more than a few lists at a time. All candidates are compared with all queries;
what is repeated for that are blocks and shards, not pairs of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import table, written

K = 5
SCALE = 256
EVERY = 50
SHARD_ROWS = 8192
BLOCK_ROWS = 2048
FAN_IN = 32

FOUND = "query_id long, vec_id long, score long, shard int"


def quantized(vectors: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as double; null unless all are finite numbers."""
    whole = F.transform(vectors, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    # floor() of a double is a long; beyond its range the double itself is whole already.
    large = F.transform(vectors, lambda x: x.cast("double") * scale)
    exact = F.zip_with(whole, large, lambda a, b: F.when(F.abs(b) < 2.0**62, a).otherwise(b))
    finite = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < math.inf))
    return F.when(finite, exact)


def _products(queries, candidates):
    """Exact integer products, as an array of longs; beyond a long, its limits."""
    import numpy as np

    most = np.abs(queries).max(initial=0.0) * np.abs(candidates).max(initial=0.0)
    if most * max(1, queries.shape[1]) < 2.0**53:
        return (queries @ candidates.T).astype(np.int64)
    left = [[int(x) for x in q] for q in queries]
    right = [[int(x) for x in c] for c in candidates]
    low, high = -(2**63), 2**63 - 1
    out = np.empty((len(left), len(right)), dtype=np.int64)
    for i, q in enumerate(left):
        for j, c in enumerate(right):
            out[i, j] = min(max(sum(a * b for a, b in zip(q, c, strict=True)), low), high)
    return out


def _tile(k: int):
    def run(key, queries, candidates):
        import numpy as np
        import pandas as pd

        names = ["query_id", "vec_id", "score", "shard"]
        if not len(queries) or not len(candidates):
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        width = max(queries["vector"].map(len).max(), candidates["vector"].map(len).max())

        def matrix(vectors):
            out = np.zeros((len(vectors), width))
            for i, v in enumerate(vectors):
                out[i, : len(v)] = v
            return out

        candidates = candidates.sort_values("vec_id", kind="stable")
        ids = candidates["vec_id"].to_numpy()
        right = matrix(candidates["vector"].to_numpy())
        out_q, out_v, out_s = [], [], []
        for at in range(0, len(queries), 256):
            part = queries.iloc[at : at + 256]
            scores = _products(matrix(part["vector"].to_numpy()), right)
            for query, row in zip(part["vec_id"].to_numpy(), scores, strict=True):
                others = ids != query
                row, names_of = row[others], ids[others]
                if len(row) > k:
                    bar = np.partition(row, len(row) - k)[len(row) - k]
                    above, level = np.flatnonzero(row > bar), np.flatnonzero(row == bar)
                    best = np.concatenate([above, level[: k - len(above)]])
                else:
                    best = np.arange(len(row))
                out_q.append(np.full(len(best), query))
                out_v.append(names_of[best])
                out_s.append(row[best])
        shard = int(key[1])
        out = pd.DataFrame({
            "query_id": np.concatenate(out_q),
            "vec_id": np.concatenate(out_v),
            "score": np.concatenate(out_s),
        })
        return out.assign(shard=shard)

    return run


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = K,
    block_rows: int = BLOCK_ROWS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every query.

    Both sides have vec_id and ``vector``, an array of whole doubles. A candidate with the
    query's own vec_id is not compared. Rows with null id or vector take no part; a shorter
    vector counts as filled with zeros. Of queries with one id the least vector asks;
    candidates with one id are ranked each. Ties go to the smaller vec_id. Empty tables
    give no rows.
    """
    usable = "vec_id IS NOT NULL AND vector IS NOT NULL"
    asked = written(
        queries.filter(usable).groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries"
    )
    given = written(candidates.filter(usable).select("vec_id", "vector"), "candidates")
    blocks = max(1, math.ceil(asked.count() / block_rows))
    shards = max(1, math.ceil(given.count() / shard_rows))
    spark = asked.sparkSession
    spot = F.xxhash64("vec_id", "vector")
    left = asked.select(
        F.pmod(spot, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        "vec_id",
        "vector",
    )
    right = given.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(spot, F.lit(shards)).cast("int").alias("shard"),
        "vec_id",
        "vector",
    )
    tiles = (
        left.groupBy("block", "shard")
        .cogroup(right.groupBy("block", "shard"))
        .applyInPandas(_tile(k), T.StructType.fromDDL(FOUND))
    )
    best, groups = tiles, shards
    while True:
        groups = math.ceil(groups / FAN_IN)
        best = best.withColumn("shard", F.expr(f"shard div {FAN_IN}").cast("int"))
        order = W.partitionBy("query_id", "shard").orderBy(F.desc("score"), "vec_id")
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if groups <= 1:
            break
        best = best.drop("rank")
    return best.select("query_id", "rank", "vec_id", "score")


def topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", quantized(F.col("embedding")).alias("vector")
    )
    return top_k(rows.filter(F.col("vec_id") % EVERY == 0), rows)

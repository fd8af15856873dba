"""Exact search against all products, with ties, odd vectors and small tiles."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from monsoon.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=5, every=50):
    vectors = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    asked = {}
    for i, v in vectors:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for query, q in asked.items():
        found = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in vectors if i != query)[:k]
        out += [(query, rank + 1, i, -s) for rank, (s, i) in enumerate(found)]
    return sorted(out)


def search(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", score string, shard int")
    vectors = df.select("vec_id", topk.quantized(F.col("embedding")).alias("vector"))
    found = topk.top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors, **settings)
    return sorted(map(tuple, found.collect()))


def numbers(n, dims=6, seed=1):
    random.seed(seed)
    return [(i, [random.choice([0.0, 0.25, -0.5, random.random()]) for _ in range(dims)]) for i in range(n)]


def test_small_tiles_and_a_deep_tree(spark):
    rows = numbers(1200)
    rows += [(2000 + i, [0.5] * 6) for i in range(300)]  # ties
    assert search(spark, rows, block_rows=7, shard_rows=30) == plain(rows)


def test_odd_vectors(spark):
    rows = numbers(60)
    rows += [(100, None), (150, [None] * 6), (200, [math.nan] * 6), (250, [math.inf] + [0.0] * 5), (None, [9.0] * 6), (300, [])]
    rows += [(0, rows[0][1]), (7, rows[7][1]), (50, [-1.0] * 6)]
    assert search(spark, rows) == plain(rows)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [1.0])]
    assert search(spark, rows) == plain(rows)
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(3, [1.0])]) == []
    df = spark.createDataFrame([], "vec_id long, vector array<double>")
    assert topk.top_k(df, df).collect() == []


def test_products_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**28, 1.0]), (1, [2.0**17, 1.0]), (2, [2.0**17, 2.0])]
    assert search(spark, rows) == [(0, 1, 2, 2**61 + 2**17), (0, 2, 1, 2**61 + 2**16)]


def test_products_beyond_longs_stop_at_their_limits(spark):
    rows = [(0, [1.0e30]), (1, [1.0e30]), (2, [-1.0e30]), (3, [0.0])]
    assert search(spark, rows) == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 0), (0, 3, 2, -(2**63))]

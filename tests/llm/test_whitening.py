"""Whitening against numpy, and each exact step on its own."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from monsoon.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def integers(rows):
    return np.array([[math.floor(64 * float(np.float32(x))) + 1_000_000 for x in v] for v in rows], dtype=object)


def checked(got, ids, rows, most=32):
    """Every column against plain arithmetic over the rows."""
    x = integers(rows)
    n = len(x)
    sums = x.sum(axis=0)
    apart = n * x - sums
    exact = (apart.T @ apart) // n  # n times the integer scatter, divided exactly
    v = exact.astype(float) / n / n
    values = np.linalg.eigvalsh(v)[::-1]
    many = min(most, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == n * many
    table = {(r.vec_id, r.component): r for r in got}
    assert {r.n for r in got} == {n}
    for i, row in zip(ids, apart):
        assert table[i, 1].deviation == sum(int(d) ** 2 for d in row)
    white = np.array([[table[i, c].whitened for c in range(1, many + 1)] for i in ids])
    cov = (white - white.mean(axis=0)).T @ (white - white.mean(axis=0)) / n
    error = np.abs(cov - np.eye(many)).max()
    assert error < 1e-9
    assert len({r.identity_error for r in got}) == 1
    assert abs(got[0].identity_error - error) < 1e-9
    for c in range(1, many + 1):
        assert table[ids[0], c].explained == pytest.approx(values[c - 1] / np.trace(v), rel=1e-6)
    # The components themselves: what whitened is a linear function of.
    axes = np.linalg.lstsq(apart.astype(float) / n, white, rcond=None)[0] * np.sqrt(values[:many])
    if many == len(values):
        assert np.allclose(v @ axes, axes * values[:many], atol=1e-9 * values[0])


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(300, 10)) @ rng.normal(size=(10, 10)) * 0.1).tolist()
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(rows)], SCHEMA)
    checked(whitening.whitened(df).collect(), list(range(300)), rows)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    checked(whitening.whitening_query(spark, sf_dir).collect(), [r.vec_id for r in table], [r.embedding for r in table])


def test_equal_and_missing_variances(spark):
    """Equal eigenvalues, equal columns and a constant one."""
    base = [[a, b, c] for a in (0.0, 1.0) for b in (0.0, 1.0) for c in (0.0, 1.0)]
    rows = [[*v, v[0], 0.5, 3 * v[1]] for v in base]
    df = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    checked(whitening.whitened(df).collect(), list(range(8)), rows)


def plain_polynomial(matrix):
    """Faddeev-LeVerrier in fractions."""
    d = len(matrix)
    a = np.array(matrix, dtype=object)
    m, out = np.zeros((d, d), dtype=object), [0] * d + [1]
    for k in range(1, d + 1):
        m = a @ m + out[d - k + 1] * np.eye(d, dtype=int).astype(object)
        out[d - k] = -sum((a @ m)[i, i] for i in range(d)) // k
    return out


def test_polynomial(spark):
    random.seed(2)
    for d in (1, 2, 3, 7, 12):
        half = [[random.randint(-(10**6), 10**6) for _ in range(d)] for _ in range(d)]
        matrix = (np.array(half, dtype=object) @ np.array(half, dtype=object).T).tolist()
        assert whitening.characteristic_polynomial(spark, matrix) == plain_polynomial(matrix)
    zeros = [[0, 0, 0], [0, 4, 0], [0, 0, 4]]
    assert whitening.characteristic_polynomial(spark, zeros) == plain_polynomial(zeros)


def test_roots():
    roots = [0, 0, 1, 5, 5, 10**12, 10**12 + 1, 10**20]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    got = whitening.largest_roots(poly, 99)
    assert [n for _, n in got] == [1, 1, 1, 2, 1]
    for (found, _), want in zip(got, [10**20, 10**12 + 1, 10**12, 5, 1]):
        assert abs(found - want) < Fraction(want, 2**50)
    assert [n for _, n in whitening.largest_roots(poly, 2)] == [1, 1]
    assert whitening.largest_roots([0, 0, 1], 5) == []


def test_edges(spark):
    rows = [
        (1, [0.5, -0.25], "a"), (1, [0.5, -0.25], "a"), (None, [1.0, 2.0], "b"), (4, None, "c"), (5, [None, 1.0], "d"),
        (6, [math.nan, 1.0], "e"), (7, [math.inf, 0.0], "f"), (8, [0.75], "g"), (9, [], "h"),
    ]
    df = spark.createDataFrame([(i, v, x, 3) for i, v, x in rows], SCHEMA + ", component string, n int")
    got = whitening.whitened(df).collect()
    assert sorted(((r.vec_id or -1), r.component) for r in got) == sorted((i, c) for i in (1, 1, -1, 8, 9) for c in (1, 2))
    assert got[0].n == 5 and got[0].identity_error < 1e-9
    assert whitening.whitened(df.limit(0)).collect() == []
    assert whitening.whitened(df.limit(2)).collect() == []
    huge = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])], SCHEMA)
    got = whitening.whitened(huge).collect()
    assert len(got) == 6 and max(r.deviation for r in got) == 2**63 - 1 and got[0].identity_error < 1e-4

"""Mixing: targets, quotas and words taken against plain loops."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from monsoon.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_targets(sizes: dict) -> dict:
    """Share out, stop at twice the size, reshare the excess, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, left = {}, set(sizes)
    want = Fraction(3, 2) * sum(sizes.values())
    while left:
        rest = want - sum(full.values())
        level = rest / sum(weight[s] for s in left)
        above = {s for s in left if level * weight[s] > 2 * sizes[s]}
        if not above:
            return full | {s: level * weight[s] for s in left}
        full |= {s: Fraction(2 * sizes[s]) for s in above}
        left -= above
    return full


def highest_quotients(claims: list[int], seats: int) -> list[int]:
    got = [0] * len(claims)
    for _ in range(seats):
        i = max(range(len(claims)), key=lambda i: (Fraction(claims[i], 2 * got[i] + 1), -i))
        got[i] += 1
    return got


@pytest.mark.parametrize("seed", range(4))
def test_apportionment_is_highest_quotients(spark, seed):
    random.seed(seed)
    rows = []
    for group in range(5):
        seats = random.choice([0, 1, 7, 60, 300])
        rows += [(group, i, random.choice([1, 1, 5, 40, 1000]), seats) for i in range(random.randint(1, 12))]
    df = spark.createDataFrame(rows, "g int, i int, claim long, seats long")
    got = defaultdict(dict)
    for r in mixing.apportioned(df, ["g"], ["i"], "claim", "seats", "won").collect():
        got[r.g][r.i] = r.won
    for group in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == group]
        want = highest_quotients([r[2] for r in own], own[0][3])
        assert [got[group][i] for i in range(len(own))] == want


def test_targets_and_words_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mixing_query(spark, sf_dir).collect()
    again = mixing.mixing_query(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(float(want[s]))
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK + 0.001 * target[s]


def test_many_shards(spark):
    text = F.expr("array_join(array_repeat('w', cast(1 + id % 97 as int)), ' ')")
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.expr("if(id % 3 = 0, null, concat('s', id % 7))").alias("source")
    )
    rows = mixing.mixed(docs, shard_words=2000).join(docs, "doc_id").collect()
    taken, target, sizes = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        sizes[r.source] += r["size"]
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    assert {s: pytest.approx(float(t)) for s, t in plain_targets(sizes).items()} == target
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s]


def test_edges(spark):
    rows = [
        (1, None, "en", "b", 0), (2, "", "en", "b", 0), (3, " \t\n", None, None, 3),
        (4, "one two", None, None, 7), (4, "one two", None, None, 7), (None, "x", "en", "a", 1),
        (None, None, None, None, None), (7, "word " * 50_000, "en", "a", 1),
    ]
    df = spark.createDataFrame([(*r, 5, "k") for r in rows], SCHEMA + ", size int, key string")
    got = mixing.mixed(df).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert sorted(r["size"] for r in got) == [0, 0, 0, 0, 1, 2, 2, 50_000]
    assert mixing.mixed(df.limit(0)).count() == 0
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    assert mixing.mixed_rows(df.limit(0)).count() == 0


def test_the_mix_holds_the_words_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixing.mixing_query(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = Counter()
    for r in mixing.mixed_rows(docs).collect():
        assert r.text in texts[r.doc_id]
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.encode().split())
    assert words == Counter({d: t for d, t in taken.items() if t})


def test_rows_alike_keep_their_own_columns(spark):
    rows = [(1, "a b c d", "s", 10), (1, "a b c d", "s", 20), (2, "e f g h i", "s", 30), (3, "j k", "t", 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, x int")
    got = mixing.mixed_rows(df, share=2.0, block=1).collect()
    assert sorted(map(tuple, got)) == sorted(rows + rows)

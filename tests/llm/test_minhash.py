"""Circulant MinHash: signatures, and components against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from monsoon.llm import minhash

SCHEMA = "doc_id long, text string"


def plain_set(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain(texts, above=85, below=100):
    """Component ids of {id: text} by all pairs."""
    sets = {i: plain_set(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for at, i in enumerate(ids):
        for j in ids[at + 1 :]:
            both = len(sets[i] & sets[j])
            if both and below * both >= above * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}, sets


def edited(words, rate):
    return [f"new{random.randrange(10**9)}" if random.random() < rate else w for w in words]


def corpus(seed, groups=12, copies=12):
    """Groups of copies edited lightly and heavily, chains, and texts with a common start."""
    random.seed(seed)
    out, common = [], [f"common{i}" for i in range(60)]
    for _ in range(groups):
        base = common[: random.randint(0, 60)] + [f"w{random.randrange(3000)}" for _ in range(random.randint(3, 250))]
        now = base
        for _ in range(copies):
            out.append(" ".join(edited(base, random.choice((0.002, 0.01, 0.02, 0.05)))))
            now = edited(now, 0.01)
            out.append(" ".join(now))
    random.shuffle(out)
    return out


def test_signature_is_two_permutations_and_a_shift():
    random.seed(1)
    hashes = np.unique(np.array([random.randrange(-(2**63), 2**63) for _ in range(5000)], dtype=np.int64))
    assert len({int(x) for x in minhash._permuted(np.arange(100_000, dtype=np.uint32))}) == 100_000
    scattered = [int(x) for x in minhash._permuted((hashes.view(np.uint64) >> np.uint64(32)).astype(np.uint32))]
    scattered = [x * 0x9E3779B1 % 2**32 for x in scattered]
    got = minhash.signature(hashes)
    for k in (0, 1, 77, 127):
        shifted = np.array([(x + k) % 2**32 for x in scattered], dtype=np.uint32)
        assert got[k] == minhash._permuted(shifted).min()


def test_share_of_equal_coordinates_is_the_similarity():
    rng = np.random.default_rng(1)
    equal = []
    for _ in range(200):
        pool = rng.integers(-(2**63), 2**63, 500, dtype=np.int64)
        x, y = np.unique(pool[:400]), np.unique(pool[100:])
        equal.append((minhash.signature(x) == minhash.signature(y)).mean())
    assert np.mean(equal) == pytest.approx(0.6, abs=0.01)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bar", [(85, 100), (4, 5)])
def test_against_all_pairs(spark, seed, bar):
    texts = dict(enumerate([*corpus(seed), "One two", "one TWO", "six", "a b c d e", "A\tb c d e f"]))
    want, sets = plain(texts, *bar)
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    got = {r.doc_id: r for r in minhash.near_duplicates(df, above=bar[0], below=bar[1]).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert 10 < len(set(want.values())) < len(want) - 10


def test_whole_table_against_all_pairs(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want, sets = plain(docs)
    got = minhash.minhash_query(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in docs}
    assert len(got) == len(docs)


def test_a_large_group_makes_pairs_in_proportion_to_its_rows(spark, monkeypatch):
    random.seed(4)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(edited(base, 0.03 * random.random())) for _ in range(400)]
    asked = []
    confirm = minhash._confirm
    monkeypatch.setattr(minhash, "_confirm", lambda p, *a: asked.append(p.count()) or confirm(p, *a))
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == plain(dict(enumerate(texts)))[0]
    assert sum(asked) < 20 * len(texts)


def test_edges(spark):
    long = "word " * 100_000 + " ".join(f"w{i}" for i in range(50_000))
    rows = [
        (5, None), (3, ""), (9, " \t\n"), (None, None), (2, "One two three four five"), (2, "One two three four five"),
        (7, "one TWO three\x0bfour five"), (None, "one two three four five"), (None, "some other words are here"),
        (11, "É é"), (12, "é é"), (13, long), (14, long.upper()),
    ]
    df = spark.createDataFrame(
        [(*r, b"x", 1, "y", "z") for r in rows],
        SCHEMA + ", set_id binary, n int, body string, component_id string",
    )
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    size = len(plain_set(long))
    assert got == sorted(
        [
            (5, 0, 5, True), (3, 0, 3, True), (9, 0, 9, True), (None, 0, None, True), (2, 1, 2, True), (2, 1, 2, True),
            (7, 1, 2, False), (None, 1, 2, False), (None, 1, None, True), (11, 1, 11, True), (12, 1, 12, True),
            (13, size, 13, True), (14, size, 13, False),
        ],
        key=str,
    )
    assert minhash.near_duplicates(df.limit(0)).count() == 0

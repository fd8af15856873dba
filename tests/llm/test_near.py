"""What the pipeline's stage keeps, against all pairs."""

from __future__ import annotations

import corpus_pipeline
import pytest

from monsoon.llm import near

from .test_minhash import corpus, plain_set
from .test_simhash import plain as fingerprint


def groups(texts, radius=2, above=4, below=5):
    """Least id that each id of {id: text} reaches, links by fingerprint or by sets."""
    root = {i: i for i in texts}
    sets, prints = {i: plain_set(t) for i, t in texts.items()}, {i: fingerprint(t) for i, t in texts.items()}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for at, i in enumerate(ids):
        for j in ids[at + 1 :]:
            both = len(sets[i] & sets[j])
            alike = both and below * both >= above * len(sets[i] | sets[j])
            if alike or (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("seed", [3, 5])
def test_one_of_each_group_stays(spark, seed):
    texts = dict(enumerate([*corpus(seed, groups=8), None, "", "One two", "one TWO", "six"]))
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, source string")
    got = corpus_pipeline.near_dedup(spark, df, "")
    assert got.columns == df.columns
    rows = {r.doc_id: r.text for r in got.collect()}
    assert sorted(rows) == sorted(set(groups(texts).values()))
    assert rows.items() <= texts.items() and len(rows) < len(texts) - 10


def test_least_row_stays(spark):
    words = [f"w{i}" for i in range(100)]
    text = lambda i: " ".join([*words[:-1], f"end{i}"])
    rows = [(None, text(0), 1), (-3, text(1), 2), (7, text(2), 3), (8, "other", 4), (8, "other", 4), (None, None, 5), (9, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    got = sorted(map(tuple, near.one_of_near(df).collect()), key=str)
    assert got == sorted([rows[1], rows[3], rows[6]], key=str)
    assert near.one_of_near(df.limit(0)).count() == 0

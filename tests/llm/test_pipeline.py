"""The pipeline's stages, each against a plain version of what it decides."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from monsoon.llm import rules

from .test_lines import plain_passages
from .test_near import groups


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows before each stage and after the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir)
        out.append(got.collect())
        if stage is not corpus_pipeline.pack:
            assert got.columns == docs.columns
            docs = spark.createDataFrame(out[-1], docs.schema)
    return out


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mix", "pack"]


def test_rules(stages):
    before, after = stages[0], stages[1]
    kept = {r.doc_id for r in after}
    for r in before:
        words, *_, repeated = rules.measure(r.text)
        if words < 20 or 100 * repeated > 30 * words:
            assert r.doc_id not in kept
        else:  # too few labels here for any cutoff
            assert r.doc_id in kept
    assert {r.doc_id: r for r in before if r.doc_id in kept} == {r.doc_id: r for r in after}


def test_line_dedup(stages):
    before, after = stages[1], stages[2]
    assert sorted((r.doc_id, r.text) for r in after) == sorted(plain_passages([(r.doc_id, r.text) for r in before]))
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_of_each_group_stays(stages):
    before, after = stages[2], stages[3]
    want = groups({r.doc_id: r.text for r in before})
    assert sorted(r.doc_id for r in after) == sorted(set(want.values()))
    assert set(after) <= set(before)


def test_mix(stages):
    before, after = stages[3], stages[4]
    sizes, taken = Counter(), Counter()
    texts = {r.doc_id: r for r in before}
    for r in before:
        sizes[r.source] += len(r.text.encode().split())
    for r in after:
        assert r.text in texts[r.doc_id].text and r.source == texts[r.doc_id].source
        taken[r.source] += len(r.text.encode().split())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.02)
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)


def test_pack(stages):
    before, after = stages[4], stages[5]
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter(tuple([*exact.encode(r.text, add_special_tokens=False).ids, 0]) for r in before)
    used = Counter()
    for p in after:
        assert p.length == len(np.frombuffer(p.ids, dtype="<u4"))
        used[p.sequence_id] += p.length
    assert max(used.values()) <= 1024
    assert sum(used.values()) == sum(len(ids) * n for ids, n in want.items())
    first = Counter(p.doc_tokens for p in after if p.start == 0)
    assert first == Counter(len(ids) for ids in want.elements())


def test_run_is_the_stages_one_after_the_other(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    whole = lambda rows: Counter((p.doc_id, p.doc_tokens) for p in rows if p.start == 0)
    rows = got.select("doc_id", "doc_tokens", "start", "length").collect()
    assert whole(rows) == whole(stages[-1])
    assert sum(p.length for p in rows) == sum(p.length for p in stages[-1])


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

"""Packing against the tokenizer itself, and the subset-sum against brute force."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from monsoon.llm import packing

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def expected(exact, text):
    return [*exact.encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, docs, exact, window):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == docs.keys()
    for doc, text in docs.items():
        want, at = expected(exact, text), 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            ids = np.frombuffer(p.ids, dtype="<u4").tolist()
            assert (p.start, p.length, p.doc_tokens) == (at, len(ids), len(want))
            assert ids == want[at : at + p.length]
            at += p.length
        assert at == len(want)
    padding = 0
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_pieces_hold_every_id_once(spark, exact):
    random.seed(3)
    words = ["alpha", "beta\n", "<|endoftext|>", "naïve", "日本", "x" * 50, "\t", " ", "🙂", "1234"]
    docs = {i: " ".join(random.choices(words, k=random.randint(0, 400))) for i in range(120)}
    docs |= {500: None, 501: "", 502: "word " * 9000, 503: "word " * 700, 504: "word " * 700}
    df = spark.createDataFrame(list(docs.items()), SCHEMA).repartition(3)
    pieces = packing.pack(df, window=256, block=5000).collect()
    assert check(pieces, docs, exact, 256) == 0


def test_equal_lengths_and_extra_columns(spark, exact):
    docs = {i: "word " * 139 for i in range(40)}
    df = spark.createDataFrame(
        [(i, t, "x", 1, 2) for i, t in docs.items()],
        SCHEMA + ", ids string, sequence_id int, `offset` int",
    )
    pieces = packing.pack(df.coalesce(1), window=200).collect()
    assert check(pieces, docs, exact, 200) == 0
    assert len({p.sequence_id for p in pieces}) < 32


def test_repeated_and_null_ids_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, None)]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((p.doc_id or -1, p.doc_tokens) for p in pieces if p.start == 0) == [
        (-1, 1), (-1, 2), (1, 3), (1, 3)]
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plain_characters_are_the_same_in_both_libraries(exact):
    ids = packing.tokenizer()
    signs = "\n" + "".join(map(chr, range(0x20, 0x7F))) + "".join(map(chr, range(0xA1, 0x180)))
    signs = signs.replace("\xad", "")
    for a, b in itertools.product(signs, "a9 .\n'é"):
        for text in (f"x{a}{b}y", f" {a}{b} {b}{a}", f"{b}{b}{a}{a}  {a}s"):
            assert ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("seed", range(20))
def test_one_window_is_as_full_as_brute_force_makes_it(seed):
    random.seed(seed)
    window = 60
    pieces = [random.randint(1, 40) for _ in range(10)]
    counts = {n: pieces.count(n) for n in set(pieces)}
    lengths = sorted(counts, reverse=True)
    used = packing.fill(counts, lengths, window)
    rest = sorted(pieces, reverse=True)[1:]
    best = max(
        lengths[0] + sum(c)
        for k in range(len(rest) + 1)
        for c in itertools.combinations(rest, k)
        if lengths[0] + sum(c) <= window
    )
    assert sum(k * n for k, n in used.items()) == best
    assert all(n <= counts[k] for k, n in used.items())


def test_patterns_use_every_piece():
    random.seed(1)
    counts = {n: random.randint(1, 9) for n in random.sample(range(1, 1024), 200)}
    left = dict(counts)
    for used, times in packing.patterns(counts, 1024):
        assert sum(k * n for k, n in used.items()) <= 1024
        for k, n in used.items():
            left[k] -= n * times
    assert set(left.values()) == {0}


def test_query_checksums(spark, sf_dir, exact):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for p in packing.pack_digest(spark, sf_dir).collect():
        ids = expected(exact, docs[p.doc_id])[p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())

"""Rules: counts against plain definitions, cutoffs against exact binomial tails."""

from __future__ import annotations

import math
import random
import re
from fractions import Fraction

import pytest

from monsoon.llm import rules

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string"


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {
        i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(8)
    }
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
    )


@pytest.mark.parametrize("seed", range(60))
def test_counts(seed):
    random.seed(seed)
    alphabet = random.choice([["a"], ["a", "b"], list("abcdefghijk"), ["é#", "日本|", "x y", "🙂"]])
    gaps = [" ", "  ", "\t", "\n", "\x0b", "\r\n"]
    text = "".join(random.choice(alphabet) + random.choice(gaps) for _ in range(random.randint(0, 120)))
    assert rules.measure(text) == plain(text)


def test_counts_of_edge_texts():
    for text in (None, "", " ", "\n\n", "a " * 8, "a " * 9, "  \x1c \x85", "x" * 100_000):
        assert rules.measure(text) == plain(text)
    assert rules.measure("a b c d e f g h " * 20_000)[5] == 160_000


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 50, 0.2), (7, 300, 0.05), (0, 2000, 0.005), (40, 1000, 0.02)])
def test_tail(k, n, p):
    exact = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
    assert rules.tail(k, n, p) == pytest.approx(float(exact), rel=1e-9)


def documents(spark):
    random.seed(2)
    rows, labels = [], []
    for i in range(3000):
        lang = random.choice(["xx", "yy", None]) if i < 2900 else "few"
        junk = i % 10 == 0
        words = [f"w{random.randrange(10**6)}" + ("***" if junk else "") for _ in range(30)]
        rows.append((i, " ".join(words), lang))
        labels.append((i, 0 if junk else 1))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int"), rows


def test_cutoffs_reject_junk_and_spare_what_is_good(spark):
    docs, labels, rows = documents(spark)
    got = {r.doc_id: r for r in rules.judged(docs, labels, risk=0.04).collect()}
    assert len(got) == len(rows)
    for i, _, lang in rows:
        assert not got[i].base_failed
        if lang == "few":  # too few labels: nothing is rejected
            assert got[i].kept
        else:
            assert got[i].kept == (i % 10 != 0), got[i]


def test_cutoffs_hold_the_bound(spark):
    """The chosen cutoff passes the exact test, every stricter one fails."""
    docs, labels, _ = documents(spark)
    measured = rules.judged(docs, labels, risk=0.04)
    rows = measured.collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    strata = {r.stratum for r in rows}
    n_tests = len(strata) * sum(len(grid) for *_, grid in rules.RULES.values())
    share = 0.04 / len(rules.RULES)
    for stratum in strata:
        own = [r for r in rows if r.stratum == stratum and r.doc_id in good]
        for rule, (a, b, grid) in rules.RULES.items():
            chosen = {r[f"cut_{rule}"] for r in rows if r.stratum == stratum}
            passed = [
                c for c in grid
                if (k := sum(r[a] / r[b] > c for r in own)) < share * len(own)
                and rules.tail(k, len(own), share) <= 0.05 / n_tests
            ]
            assert chosen == {min(passed, default=None)}


def test_edges(spark):
    rows = [(1, None, None), (2, "", "en"), (None, "a " * 50, "en"), (3, "word " * 200_000, None), (3, "x y", "en"), (3, "x y", "en")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA + ", n_words int, stratum string")
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0)], "doc_id long, quality int")
    got = rules.judged(df, labels).collect()
    assert len(got) == 6 and not any(r.kept for r in got)
    assert rules.judged(df, labels.limit(0)).count() == 6
    assert rules.judged(df.limit(0), labels).count() == 0
    good = spark.createDataFrame([(9, " ".join(f"w{i}" for i in range(40)), "en", 1, "s")], df.schema)
    kept = rules.kept_rows(df.union(good), labels)
    assert kept.columns == df.columns and kept.collect() == good.collect()


def strata_of_a_few_hundred(spark):
    """Four strata of 300 to 1,500 good documents and some bad ones, beside one of 40."""
    random.seed(7)
    rows, labels = [], []
    for lang, n in {"aa": 1500, "bb": 480, "cc": 450, "dd": 320, "few": 40}.items():
        for i in range(n + n // 10):
            bad = i >= n
            lines = [" ".join(f"w{random.randrange(10**6)}" + ("***" if bad else "") for _ in range(6)) for _ in range(5)]
            if lang == "bb" and i < 9:  # good documents that have some lines twice
                lines += lines[0:3:2]
            rows.append((len(rows), "\n".join(lines), lang))
            labels.append((len(labels), 0 if bad else 1))
    return rows, spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")


def test_strata_of_a_few_hundred_get_cutoffs(spark):
    """With the production values; divided among rules and grid, none but one got any."""
    rows, docs, labels = strata_of_a_few_hundred(spark)
    kept = {r.doc_id for r in rules.kept_rows(docs, labels).collect()}
    for i, text, lang in rows:
        assert (i in kept) == (lang == "few" or "***" not in text), (lang, text)


def test_joint_cutoffs_hold_the_bound(spark):
    """Every step up to the chosen one passes the exact test, the next one fails."""
    rows, docs, labels = strata_of_a_few_hundred(spark)
    got = rules.judged(docs, labels, joint=True).collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    for stratum in {r.stratum for r in got}:
        own = [r for r in got if r.stratum == stratum and r.doc_id in good]
        lengths = []
        for path in rules.paths():
            passed = 0
            for step in path:
                k = sum(any(r[rules.RULES[rule][0]] / r[rules.RULES[rule][1]] > c for rule, c in step.items()) for r in own)
                if k >= rules.RISK * len(own) or rules.tail(k, len(own), rules.RISK) > rules.ERROR / (5 * len(rules.RULES)):
                    break
                passed += 1
            lengths.append((passed, path[passed - 1] if passed else {}))
        want = max(lengths, key=lambda x: x[0])[1]
        assert {tuple(r[f"cut_{rule}"] for rule in rules.RULES) for r in got if r.stratum == stratum} == {
            tuple(want.get(rule) for rule in rules.RULES)}


def test_joint_error_is_kept():
    """Rules that reject more than the risk seldom pass, whichever path is taken."""
    import numpy as np
    import pandas as pd

    choose, wrong, n = rules._joint_chooser(rules.RISK, rules.ERROR / len(rules.RULES)), 0, 400
    steps = [len(path) for path in rules.paths()]
    draws = np.random.default_rng(1).binomial(n, rules.RISK * 1.01, size=(2000, len(steps)))
    for row in draws:  # the worst case: each path is a single chance of its own
        counts = [k for k, size in zip(row, steps, strict=True) for _ in range(size)]
        wrong += choose(pd.Series([n]), pd.Series([counts])).notna().any(axis=1).iloc[0]
    assert wrong <= rules.ERROR * len(draws)

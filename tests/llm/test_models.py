"""Language, quality and toxicity: held-out accuracy, and the parts against plain versions."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest

from monsoon.llm import language, quality, toxicity

SF = f"{os.environ.get('TESTDATA_DIR', '/root/testdata')}/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# --- Language -------------------------------------------------------------------


def test_language_of_held_out_documents(spark, documents):
    rows = language.language_query(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    right = n = 0
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 4) == 2)
        assert 0 <= r.score <= 1
        if r.held_out:
            n += 1
            right += r.lang_pred == documents[r.doc_id].lang
    assert n > 200 and right / n >= 0.97


def test_language_edges(spark):
    docs = [("en", "the quick brown fox " * 5), ("de", "der schnelle braune fuchs " * 5)]
    model = language.fitted(spark.createDataFrame(docs, "lang string, text string"))
    rows = [(1, None), (2, ""), (3, "123 *** \n"), (4, "quick fox"), (None, "der fuchs " * 100_000), (4, "quick fox"), (5, "日本語")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred) for r in language.predicted(df, model).collect()]
    assert got[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "de"), (4, "en")]
    assert got[6][1] in ("en", "de")
    signs = spark.createDataFrame([(i, t) for i, t in enumerate(["² ½ ①", "Ⅷ ٣ _", "ª", "ʰ"])], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in language.predicted(signs, model).collect()] == [True, True, False, False]
    assert language.predicted(df, model).collect()[6].rejected
    none = language.fitted(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in language.predicted(df, none).collect()} == {"und"}


def test_copies_do_not_fill_the_sample(spark):
    """The text whose hash comes first is there very often; the centroids are still of many."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(200)]
    texts = [" ".join(rng.choice(words, 20)) for _ in range(60)]
    df = spark.createDataFrame([("xx", t) for t in texts], "lang string, text string")
    first = df.orderBy(language.F.xxhash64("text")).first()
    _, langs, centres, _ = language.fitted(df.union(spark.createDataFrame([first] * 500, df.schema)), per_language=50)
    assert langs == ["xx"] * language.CENTROIDS
    assert len(np.unique(centres.round(4), axis=0)) == language.CENTROIDS


@pytest.mark.parametrize("parts", [(1,), (7, 3, 1)])
def test_the_sample_is_the_least_hashes(spark, monkeypatch, parts):
    """However a language is dealt, the same texts are taken of it."""
    texts = [(("aa", "bb")[i % 3 == 0], f"{'xyz'[i % 3]}{chr(97 + i % 26)} {chr(97 + i // 26)}q") for i in range(300)]
    df = spark.createDataFrame(texts, "lang string, text string")
    whole = language.fitted(df, per_language=20)
    monkeypatch.setattr(language, "PARTS", parts)
    again = language.fitted(df, per_language=20)
    assert whole[1] == again[1] and np.allclose(whole[2], again[2])


def test_document_frequencies(spark):
    texts = ["abc abc", "abc", "xyz"]
    idf = language.inverse_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert len(idf) == 1 << language.SLOTS_LOG2
    slot = language.grams("abc")[1]  # " ab", "abc", "bc "
    assert idf[slot] == pytest.approx(np.log(4 / 3))
    unit = language.vectors(texts, idf)
    assert np.linalg.norm(unit, axis=1) == pytest.approx([1, 1, 1])


def test_clusters_find_separate_groups():
    drawn = np.random.default_rng(0)
    axes = np.eye(8)[:3]
    points = np.repeat(axes, 20, axis=0) + drawn.normal(0, 0.05, (60, 8))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres, bars = language.clustered(points.astype(np.float32), 3)
    assert sorted(np.argmax(centres, axis=1).tolist()) == [0, 1, 2]
    assert min(bars) > 0.9


# --- Quality --------------------------------------------------------------------


def area_under_curve(scores, truth):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    truth = np.asarray(truth, bool)
    n = truth.sum()
    return (ranks[truth].sum() - n * (n + 1) / 2) / (n * (~truth).sum())


def test_quality_of_held_out_documents(spark, documents, labels):
    rows = quality.quality_query(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 3) == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    truth = [labels[r.doc_id].quality for r in held]
    assert len(held) > 100
    assert area_under_curve([r.score for r in held], truth) >= 0.75
    assert np.mean([r.predicted == t for r, t in zip(held, truth, strict=True)]) >= 0.85


def test_word_vectors_against_a_plain_loop(spark):
    texts = ["a b c a", "b c", "", None, "d", "a !! B"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    got = quality.word_vectors(df, slots=64, width=8, span=2)
    plus, minus = quality.index_vectors(64, 8)
    to_slots, want = quality.slotter(64), np.zeros((64, 8))
    for text in texts:
        found = to_slots(text)
        for i, a in enumerate(found):
            for j, b in enumerate(found):
                if 0 < abs(i - j) <= 2:
                    want[a, plus[b]] += 1
                    want[a, minus[b]] -= 1
    norms = np.linalg.norm(want, axis=1, keepdims=True)
    assert got == pytest.approx(want / np.where(norms > 0, norms, 1), abs=1e-6)


def test_quality_edges(spark):
    rows = [(1, None), (2, ""), (None, "word " * 200_000), (4, "x y"), (4, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    vectors = quality.word_vectors(df)
    none = quality.fitted(df, spark.createDataFrame([], "doc_id long, quality int"), vectors)
    assert none is None
    assert {r.score for r in quality.scored(df, vectors, none).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 0), (2, 0), (4, 1), (4, 1), (None, 1), (9, None)], "doc_id long, quality int")
    model = quality.fitted(df, labels, vectors)
    got = quality.scored(df, vectors, model).collect()
    assert len(got) == 5 and got[0].score == got[1].score and got[3].score == got[4].score


def test_temperature_calibrates():
    drawn = np.random.default_rng(1)
    x = drawn.normal(size=(4000, 4)).astype(np.float32)
    truth = (drawn.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    model = quality.trained(x, truth)
    p = 1 / (1 + np.exp(-quality._logits(x, model)))
    for low in np.arange(0, 1, 0.2):
        there = (p >= low) & (p < low + 0.2)
        assert abs(p[there].mean() - truth[there].mean()) < 0.08


# --- Toxicity -------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark, documents, labels):
    rows = toxicity.toxicity_query(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    flagged = [r for r in rows if r.toxic]
    known = [r for r in flagged if r.doc_id in labels]
    assert np.mean([labels[r.doc_id].toxic for r in known]) >= 0.95
    caught = {r.doc_id for r in flagged}
    assert np.mean([d in caught for d, r in labels.items() if r.toxic]) >= 0.6
    insults = {"idiot", "trash", "scum", "worthless", "stupid", "pathetic", "disgusting"}
    has = [d for d, r in documents.items() if len(toxicity.words_of(r.text) & insults) > 1]
    assert np.mean([d in caught for d in has]) >= 0.95
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 5) == 0)
        assert all(0 <= r[f"p_{c}"] <= 1 for c in toxicity.CATEGORIES)


def test_toxicity_categories_of_held_out_labels(spark):
    """Of the larger tables, since the small ones hold back six toxic documents only.

    ``toxic_junk`` has too few documents to be held to a figure; the README gives it.
    """
    large = os.path.join(os.path.dirname(SF), "sf0.1")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    held = [r for r in toxicity.toxicity_query(spark, large).collect() if r.held_out and r.doc_id in labels]
    for name, least in (("toxic", 0.9), ("toxic_junk", None), ("toxic_clean", 0.9)):
        quality = {"toxic": (0, 1), "toxic_junk": (0,), "toxic_clean": (1,)}[name]
        known = np.array([labels[r.doc_id].toxic == 1 and labels[r.doc_id].quality in quality for r in held])
        p = np.array([r[f"p_{name}"] for r in held])
        inside, outside = p[known][:, None], p[~known]
        area = np.mean((inside > outside) + 0.5 * (inside == outside))
        print(name, known.sum(), len(held), round(float(area), 4))
        assert least is None or (known.sum() > 50 and area >= least)


def test_documents_with_one_id_are_learned_from_alike(spark):
    """Ids are texts, several documents have one, and rows come in any order."""
    texts = ["you idiot out there", "you out there on a nice day"]
    rows = [(f"id-{i}", texts[i % 2]) for i in range(60)] + [(f"id-{i}", "quite another text there") for i in range(0, 60, 3)]
    labels = spark.createDataFrame([(f"id-{i}", 1, 1 - i % 2) for i in range(60)], "doc_id string, quality int, toxic int")
    found = []
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, "doc_id string, text string").repartition(3)
        words, models = toxicity.fitted(df, labels)
        assert "idiot" in words
        found.append((words, [m.tolist() for m in models]))
    assert found[0] == found[1]


def test_beginnings_of_words():
    text = "Achlichen, achlichte! ab"
    assert toxicity.features_of(text) >= {"achlichen", "ach*", "achlich*", "achlichte", "ab"}
    assert toxicity.features_of(None) == set()
    find = toxicity.finder({"achlich*": 0, "ab": 1, "abc*": 2, "x": 3})
    assert find(text) == [0, 1] and find("abcd") == [2] and find(None) == [] and find("abc") == []


def test_chain_uses_earlier_categories():
    """The second category is the first one's noise: only its probability can tell."""
    drawn = np.random.default_rng(3)
    x = (drawn.random((3000, 3)) < 0.4).astype(float)
    first = ((x[:, 0] + x[:, 1] + 0.2 * drawn.normal(size=3000)) > 0.5).astype(float)
    second = first * (x[:, 2] > 0)
    models = toxicity.chain(x, np.array([first, second]).T)
    assert [len(m) for m in models] == [4, 5]
    p1 = toxicity.probability(x, models[0])
    p2 = toxicity.probability(np.hstack([x, p1[:, None]]), models[1])
    assert ((p1 >= 0.5) == first).mean() > 0.95 and ((p2 >= 0.5) == second).mean() > 0.95
    assert models[1][3] > 0


def test_out_of_fold_probabilities_are_not_those_of_the_fit():
    """Labels without pattern: out of fold they cannot be learned, so nothing is gained from
    the earlier category, although the fit itself knows all its labels."""
    drawn = np.random.default_rng(4)
    x = np.eye(400)
    y = (drawn.random(400) < 0.5).astype(float)
    models = toxicity.chain(x, np.array([y, y]).T)
    inside = toxicity.probability(x, models[0])
    assert ((inside >= 0.5) == y).all()
    assert models[1][400] < 1


def test_toxicity_edges(spark):
    texts = ["you idiot out there", "you out there on a nice day"]
    rows = [(i, texts[i % 2]) for i in range(60)] + [(100, None), (101, ""), (None, "idiot"), (102, "x " * 200_000 + "IDIOT"), (0, texts[0])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, p_toxic double")
    labels = spark.createDataFrame([(i, 1, 1 - i % 2) for i in range(60)] + [(None, 1, 1), (100, None, None)], "doc_id long, quality int, toxic int")
    words, models = toxicity.fitted(df, labels)
    assert "idiot" in words
    got = toxicity.predicted(df.select("doc_id", "text"), words, models).collect()
    assert len(got) == len(rows)
    flags = {(r.doc_id, r.p_toxic >= 0.5) for r in got}
    assert {(0, True), (1, False), (100, False), (101, False), (None, True), (102, True)} <= flags
    words, models = toxicity.fitted(df, labels.limit(0))
    assert {r.p_toxic for r in toxicity.predicted(df.select("doc_id", "text"), words, models).collect()} == {0.0}

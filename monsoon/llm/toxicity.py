"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after the other. Each has a logistic model over the words of a
text and their beginnings, for languages that add endings to a stem, and over the
probabilities of the categories before it. For training, those earlier
probabilities are out-of-fold: a document's come from models that did not see it, so later
models learn how far earlier predictions can be trusted. For prediction, the models fitted
on all folds are chained.

The models are fitted on a bounded sample of labelled documents; every whole text is
predicted.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import table, written
from monsoon.llm.language import held_out

# Category: when a labelled document is in it, in the order of the chain.
CATEGORIES = {
    "toxic": "toxic = 1",
    "toxic_junk": "toxic = 1 AND quality = 0",
    "toxic_clean": "toxic = 1 AND quality = 1",
}
SAMPLE = 20_000
WORDS = 256
MARGIN = 4.0
MIN_DOCS = 3
FOLDS = 5
PENALTY = 1e-5

WORD = r"[^\W\d_]+"
STEMS = range(3, 9)


def words_of(text: str | None) -> set[str]:
    import re

    return set(re.findall(WORD, text.lower())) if text else set()


def features_of(text: str | None) -> set[str]:
    """The words of a text, and beginnings of them, which are marked with a star."""
    words = words_of(text)
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


def finder(known: dict[str, int]):
    """A function from text to the numbers of the known features that it has."""
    lengths = sorted({len(k) - 1 for k in known if k.endswith("*")})

    def run(text: str | None) -> list[int]:
        words = words_of(text)
        found = words & known.keys()
        for n in lengths:
            found |= {w[:n] + "*" for w in words if len(w) > n} & known.keys()
        return sorted(known[k] for k in found)

    return run


def _counted():
    """Of each partition: how many documents of each category have each word."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        counts = Counter()

        def table(found):
            word, label = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(word, pa.string()), pa.array(label, pa.int32()), pa.array([found[k] for k in found], pa.int64())],
                names=["word", "labels", "docs"],
            )

        for batch in batches:
            for labels, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts.update((w, labels) for w in features_of(text.as_py()))
                counts[("", labels)] += 1  # counts the documents
                if len(counts) > 500_000:
                    yield table(counts)
                    counts = Counter()
        if counts:
            yield table(counts)

    return run


def vocabulary(sample: DataFrame, categories: list[str], words: int = WORDS) -> list[str]:
    """The words that speak for a category: the ``words`` highest likelihood ratios.

    A word counts only beyond what chance gives the luckiest of all words, 2 log n, by
    MARGIN. ``sample`` has ``labels``, a bit per category, and ``text``. Counting and
    ranking are distributed; at most ``words`` words per category reach the driver.
    """
    counts = written(
        sample.select("labels", "text")
        .mapInArrow(_counted(), "word string, labels int, docs long")
        .groupBy("word")
        .agg(
            F.sum("docs").alias("all"),
            *(
                F.sum(F.when(F.col("labels").bitwiseAND(1 << i) != 0, F.col("docs")).otherwise(0)).alias(f"in{i}")
                for i in range(len(categories))
            ),
        ),
        "words",
    )
    totals = counts.filter("word = ''").first()
    candidates = counts.filter(F.col("all") >= MIN_DOCS).filter("word <> ''")
    bar = 2 * math.log(max(2, candidates.count())) + MARGIN
    found: set[str] = set()
    for i in range(len(categories)) if totals else ():
        share = totals[f"in{i}"] / totals["all"]
        inside, outside = F.col(f"in{i}"), F.col("all") - F.col(f"in{i}")

        def part(n, chance):
            return F.when(n > 0, n * F.log(n / (F.col("all") * max(chance, 1e-12)))).otherwise(0.0)

        ratio = 2 * (part(inside, share) + part(outside, 1 - share))
        top = (
            candidates.select("word", ratio.alias("ratio"), (inside > F.col("all") * share).alias("more"))
            .filter("more")
            .filter(F.col("ratio") >= bar)
            .orderBy(F.desc("ratio"), "word")
            .limit(words)
        )
        found.update(r.word for r in top.collect())
    return sorted(found)


def logistic(features, labels, counts, penalty: float = PENALTY):
    """Weights and bias (last) of an L2-penalised logistic model, by Newton steps.

    ``counts`` says how many documents each row stands for.
    """
    import numpy as np

    x = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], penalty * max(1.0, counts.sum()))
    pull[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (p - labels)) + pull * weights
        curve = (x * (counts * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-4:
            break
    return weights


def probability(features, weights):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))


def chain(features, labels, folds: int = FOLDS):
    """One model per column of ``labels``. Later ones see out-of-fold earlier probabilities.

    Documents alike in features, labels and fold are one row with a count: most have no
    feature at all.
    """
    import numpy as np

    n = features.shape[1]
    fold = (np.arange(len(features)) % folds)[:, None]
    rows, counts = np.unique(
        np.hstack([features, labels, fold]).astype(np.int8), axis=0, return_counts=True
    )
    x, fold, models = rows[:, :n].astype(np.float64), rows[:, -1], []
    for y in rows[:, n:-1].T.astype(np.float64):
        models.append(logistic(x, y, counts))
        outside = np.zeros(len(x))
        for f in range(folds):
            there = fold == f
            if there.any():
                rest = ~there
                fit = logistic(x[rest], y[rest], counts[rest]) if rest.any() else models[-1]
                outside[there] = probability(x[there], fit)
        x = np.hstack([x, outside[:, None]])
    return models


def _presence(texts, known: dict[str, int]):
    import numpy as np

    out = np.zeros((len(texts), len(known)))
    find = finder(known)
    for i, text in enumerate(texts):
        out[i, find(text)] = 1
    return out


def _features(words: list[str]):
    def run(batches):
        import pyarrow as pa

        find = finder({w: i for i, w in enumerate(words)})
        for batch in batches:
            found = [find(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "labels", "words"],
            )

    return run


def fitted(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, sample: int = SAMPLE
) -> tuple[list[str], list]:
    """Words and models from at most ``sample`` labelled documents, taken by a hash of the id.

    A document labelled more than once is in a category if any of its labels says so; a null
    label says nothing. Of documents with one id the one whose list of words comes first is
    learned from, so that reruns agree. Ids may be of any type.
    """
    import numpy as np

    names = list(categories)
    bits = sum(
        F.max(F.coalesce(F.expr(rule), F.lit(False)).cast("int")) * (1 << i)
        for i, rule in enumerate(categories.values())
    )
    chosen = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(bits.cast("int").alias("labels"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most ``sample`` ids and labels are broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    words = vocabulary(rows, names)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = (
        rows.select("doc_id", "labels", "text")
        .mapInArrow(_features(words), f"doc_id {kind}, labels int, words array<int>")
        .groupBy("doc_id")
        .agg(F.min("labels").alias("labels"), F.min("words").alias("words"))
        .toPandas()
        .sort_values("doc_id")
    )
    x = np.zeros((len(found), len(words)), dtype=np.int8)
    for i, places in enumerate(found["words"]):
        x[i, places] = 1
    bits = found["labels"].to_numpy(dtype=np.int64)
    y = np.array([(bits >> i) & 1 for i in range(len(names))], dtype=np.int8).T
    order = np.random.default_rng(5).permutation(len(found))
    return words, chain(x[order], y[order]) if len(found) else []


def _predictor(words: list[str], models: list, names: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = {w: i for i, w in enumerate(words)}
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            parts = []
            for at in range(0, len(texts), 1024):
                x = _presence([t.as_py() for t in texts[at : at + 1024]], known)
                n = x.shape[1]
                for weights in models:
                    x = np.hstack([x, probability(x, weights)[:, None]])
                parts.append(x[:, n:] if models else np.zeros((len(x), len(names))))
            found = np.vstack(parts) if parts else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(found[:, i]) for i in range(len(names)))],
                names=[*batch.schema.names[:-1], *names],
            )

    return run


def predicted(
    rows: DataFrame, words: list[str], models: list, categories: dict[str, str] = CATEGORIES
) -> DataFrame:
    """The columns before ``text``, the last, and ``p_<category>``, a probability each.

    Null and empty texts have no words and get each model's base rate. Without any label all
    are 0.
    """
    names = [f"p_{name}" for name in categories]
    schema = T.StructType([*rows.schema.fields[:-1], *(T.StructField(n, T.DoubleType()) for n in names)])
    return rows.mapInArrow(_predictor(words, models, names), schema)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, toxic (whether the first category is likelier than
    not), and the categories' probabilities.

    Labels of documents whose crc32(doc_id as text) mod 5 is 0 are held out. A row without
    doc_id has no label and is not held out. Empty tables give no rows; other columns are
    ignored; repeated rows are each predicted.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out(5, 0))
    words, models = fitted(docs, labels)
    rows = docs.select("doc_id", F.coalesce(held_out(5, 0), F.lit(False)).alias("held_out"), "text")
    found = predicted(rows, words, models)
    return found.withColumn("toxic", F.col("p_toxic") >= 0.5).select(
        "doc_id", "held_out", "toxic", *(f"p_{name}" for name in CATEGORIES)
    )

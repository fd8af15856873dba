"""Quality scores from random-indexing word vectors and a small network.

Every word slot (words hashed to a fixed number of slots) has a sparse random index vector.
The vector of a slot is the sum of the index vectors of its neighbours over all texts of
the corpus, scaled to length one. A document is the mean and the spread of the vectors of
its words, with the logarithm of their number and the share of different slots. A network
with one hidden layer, trained on a bounded sample of labelled documents, gives a logit,
and a temperature fitted on a part kept aside makes it a probability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import table
from monsoon.llm.language import held_out

SLOTS = 8192
WIDTH = 48
SPAN = 2
SEED = 7
SAMPLE = 20_000
HIDDEN = 32
EPOCHS = 40
KNOWN_WORDS = 200_000
FLUSH = 1 << 20

TOKEN = r"[^\W\d_]+|\d+|[^\w\s]+|_+"


def index_vectors(slots: int = SLOTS, width: int = WIDTH, seed: int = SEED):
    """For every slot the place of its +1 and of its -1."""
    import numpy as np

    drawn = np.random.default_rng(seed)
    plus = drawn.integers(0, width, slots)
    minus = (plus + drawn.integers(1, width, slots)) % width
    return plus, minus


def slotter(slots: int = SLOTS):
    """A function from text to the slots of its words, in order. Capitals count."""
    import re
    from zlib import crc32

    import numpy as np

    find = re.compile(TOKEN).findall
    known: dict[str, int] = {}

    def slot(word: str) -> int:
        if len(known) >= KNOWN_WORDS:
            known.clear()
        shape = "A" if word.isupper() and len(word) > 1 else "a"
        out = known[word] = crc32((shape + word).encode("utf-8", "replace")) % slots
        return out

    def run(text: str | None):
        words = find(text) if text else []
        return np.array([known[w] if w in known else slot(w) for w in words], dtype=np.int64)

    return run


def _contexts(slots: int, width: int, span: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        to_slots = slotter(slots)
        plus, minus = index_vectors(slots, width)
        sums = np.zeros(slots * width, dtype=np.int64)
        held: list = []
        n = 0

        def flush():
            # Texts are parted by gaps of -1, which neither gives nor takes.
            words = np.concatenate(held)
            for step in range(1, span + 1):
                for a, b in ((words[:-step], words[step:]), (words[step:], words[:-step])):
                    both = (a >= 0) & (b >= 0)
                    a, b = a[both] * width, b[both]
                    sums[:] += np.bincount(a + plus[b], minlength=len(sums))
                    sums[:] -= np.bincount(a + minus[b], minlength=len(sums))

        gap = np.full(span, -1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = to_slots(text.as_py())
                held += [found, gap]
                n += len(found)
                if n >= FLUSH:
                    flush()
                    held, n = [], 0
        if n:
            flush()
        rows = sums.reshape(slots, width)
        used = np.flatnonzero(rows.any(axis=1))
        for at in range(0, len(used), 2048):
            part = used[at : at + 2048]
            columns = [pa.array(part, pa.int32())]
            columns += [pa.array(rows[part, j], pa.int64()) for j in range(width)]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", *(f"c{j}" for j in range(width))])

    return run


def word_vectors(texts: DataFrame, slots: int = SLOTS, width: int = WIDTH, span: int = SPAN):
    """slots x width, rows of length one (zero for slots without neighbours), all texts."""
    import numpy as np

    names = [f"c{j}" for j in range(width)]
    sums = (
        texts.select("text")
        .mapInArrow(_contexts(slots, width, span), "slot int, " + ", ".join(f"{c} long" for c in names))
        .groupBy("slot")
        .agg(*(F.sum(c).alias(c) for c in names))
        .toPandas()
    )
    out = np.zeros((slots, width), dtype=np.float32)
    out[sums["slot"].to_numpy(dtype=np.int64)] = sums[names].to_numpy(dtype=np.float64)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1)


def pooled(found, vectors):
    """The features of one document from the slots of its words."""
    import numpy as np

    width = vectors.shape[1]
    out = np.zeros(2 * width + 2, dtype=np.float32)
    if len(found):
        slots, times = np.unique(found, return_counts=True)
        share = (times / len(found)).astype(np.float32)
        rows = vectors[slots]
        mean = share @ rows
        out[:width] = mean
        out[width : 2 * width] = np.sqrt(np.maximum(share @ (rows * rows) - mean * mean, 0))
        out[-2] = np.log1p(len(found)) / 10
        out[-1] = len(slots) / len(found)
    return out


def trained(features, labels, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = SEED):
    """A two-layer network: weights and the temperature fitted on every fifth row."""
    import numpy as np

    drawn = np.random.default_rng(seed)
    aside = np.arange(len(labels)) % 5 == 4
    if not (~aside).any():
        return None
    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x, y = (features - centre) / scale, labels.astype(np.float64)
    n_in = x.shape[1]
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    weights = [
        drawn.normal(0, np.sqrt(2 / n_in), (n_in, hidden)),
        np.zeros(hidden),
        drawn.normal(0, np.sqrt(1 / hidden), hidden),
        np.array(np.log(base / (1 - base))),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    rows, step = np.flatnonzero(~aside), 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs)
        for part in np.array_split(drawn.permutation(rows), max(1, len(rows) // 128)):
            a, b, c, d = weights
            inner = np.maximum(x[part] @ a + b, 0)
            error = (1 / (1 + np.exp(-(inner @ c + d))) - y[part]) / len(part)
            back = np.outer(error, c) * (inner > 0)
            grads = [x[part].T @ back + 1e-4 * a, back.sum(axis=0), inner.T @ error + 1e-4 * c, error.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                up = first[i] / (1 - 0.9**step)
                weights[i] = weights[i] - rate * up / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    model = (centre, scale, *weights, 1.0)
    kept = aside if aside.any() else ~aside
    logits = _logits(features[kept], model)
    heats = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    y = y[kept]
    losses = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in heats]
    return (*model[:-1], float(heats[int(np.argmin(losses))]))


def _logits(features, model):
    import numpy as np

    centre, scale, a, b, c, d, heat = model
    return (np.maximum((features - centre) / scale @ a + b, 0) @ c + d) / heat


def _features(vectors):
    def run(batches):
        import pyarrow as pa

        to_slots = slotter(len(vectors))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            rows = [pooled(to_slots(t.as_py()), vectors).tolist() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(rows, pa.list_(pa.float32()))],
                names=[*batch.schema.names[:-1], "features"],
            )

    return run


def _scorer(vectors, model):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        to_slots = slotter(len(vectors))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [pooled(to_slots(t.as_py()), vectors) for t in texts]
            scores = np.full(len(found), 0.5)
            if model is not None and found:
                scores = 1 / (1 + np.exp(-np.clip(_logits(np.array(found), model), -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"],
            )

    return run


def fitted(docs: DataFrame, labels: DataFrame, vectors, sample: int = SAMPLE):
    """The network from at most ``sample`` labelled documents, taken by a hash of their id.

    ``labels`` has doc_id and quality; a document labelled both ways counts as 0.
    """
    import numpy as np

    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most ``sample`` ids and labels are broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, quality int, features array<float>"
    found = (
        rows.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text")
        .mapInArrow(_features(vectors), schema)
        .dropDuplicates(["doc_id"])
        .toPandas()
        .sort_values("doc_id")
    )
    if not len(found):
        return None
    order = np.random.default_rng(SEED).permutation(len(found))
    features = np.array(found["features"].tolist(), dtype=np.float32)[order]
    return trained(features, found["quality"].to_numpy()[order])


def scored(rows: DataFrame, vectors, model) -> DataFrame:
    """The columns before ``text``, the last, and score and predicted (1 from 0.5 up).

    Null and empty texts have no words and get the score of the zero vector. Without any
    label every score is 0.5.
    """
    schema = T.StructType(
        [
            *rows.schema.fields[:-1],
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return rows.mapInArrow(_scorer(vectors, model), schema)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; labels learned from rows whose remainder is not 1.

    A row without doc_id has no label and is not held out. Empty tables give no rows; other
    columns are ignored; repeated rows are each scored.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out(3, 1))
    vectors = word_vectors(docs)
    model = fitted(docs, labels, vectors)
    rows = docs.select("doc_id", F.coalesce(held_out(3, 1), F.lit(False)).alias("held_out"), "text")
    return scored(rows, vectors, model)

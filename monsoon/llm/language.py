"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of its byte trigrams (lower case, everything in ASCII but
letters blank, hashed to a fixed number of slots), of length one. Every language has
several centroids, found by clustering a bounded sample of its documents; a text has the
language of the centroid with the highest cosine. A text further from that centroid than
nearly all the documents it was made of is marked as rejected.

Document frequencies cover every document that may be learned from; only the centroids use
a sample, of ``per_language`` different texts each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import table

SLOTS_LOG2 = 13
PER_LANGUAGE = 400
# Into how many parts a language is dealt while its sample is taken, step by step.
PARTS = (1024, 16, 1)
CENTROIDS = 4
ROUNDS = 12
REJECT_QUANTILE = 0.005
REJECT_MARGIN = 0.7
UNKNOWN = "und"
BATCH = 256

# Maps every ASCII byte that is no letter to a blank.
BLANKS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether any character is of one of Unicode's letter categories, as training asks."""
    return any(map(str.isalpha, text))


def grams(text: str, slots_log2: int = SLOTS_LOG2):
    """The slot of every trigram of the whole text, but for runs of blanks."""
    import numpy as np

    data = b" " + text.lower().encode("utf-8", "replace").translate(BLANKS) + b" "
    codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    codes = codes[:-2] | codes[1:-1] << np.uint32(8) | codes[2:] << np.uint32(16)
    codes = codes[codes != 0x202020]
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - slots_log2)


def vectors(texts: list[str], idf):
    """One row of length one (or zero) per text."""
    import numpy as np

    slots = len(idf)
    out = np.zeros((len(texts), slots), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i] = np.bincount(grams(text, slots.bit_length() - 1), minlength=slots)
    np.sqrt(out, out=out)
    out *= idf
    norms = np.sqrt(np.einsum("ij,ij->i", out, out))
    return out / np.where(norms > 0, norms, 1)[:, None]


def clustered(points, k: int, rounds: int = ROUNDS):
    """Spherical k-means from a farthest-first start: centroids of length one, and for each
    the cosine that nearly all its points reach."""
    import numpy as np

    mean = points.mean(axis=0)
    chosen = [points[int(np.argmax(points @ mean))]]
    while len(chosen) < min(k, len(points)):
        near = np.max(points @ np.array(chosen).T, axis=1)
        chosen.append(points[int(np.argmin(near))])
    centres = np.array(chosen)
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        for j in range(len(centres)):
            if (own == j).any():
                centre = points[own == j].sum(axis=0)
                centres[j] = centre / max(float(np.linalg.norm(centre)), 1e-12)
    cosines = points @ centres.T
    own, best = np.argmax(cosines, axis=1), cosines.max(axis=1)
    radius = [
        float(np.quantile(best[own == j], REJECT_QUANTILE)) if (own == j).any() else 0.0
        for j in range(len(centres))
    ]
    return centres, radius


def _frequencies(slots_log2: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        counts, n = np.zeros(1 << slots_log2, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found = grams(text.as_py(), slots_log2)
                counts += np.bincount(found, minlength=len(counts)) > 0
                n += 1
        if n:
            slots = np.flatnonzero(counts)
            slot = np.append(slots, -1)  # -1 counts the documents
            times = np.append(counts[slots], n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot, pa.int32()), pa.array(times, pa.int64())], names=["slot", "times"]
            )

    return run


def inverse_frequencies(texts: DataFrame, slots_log2: int = SLOTS_LOG2):
    """log((1 + n) / (1 + documents with the slot)) of every slot, over all texts."""
    import numpy as np

    counts = (
        texts.mapInArrow(_frequencies(slots_log2), "slot int, times long")
        .groupBy("slot")
        .agg(F.sum("times").alias("times"))
        .toPandas()
    )
    slots = np.zeros(1 << slots_log2)
    known = counts[counts["slot"] >= 0]
    slots[known["slot"].to_numpy()] = known["times"].to_numpy()
    n = int(counts.loc[counts["slot"] < 0, "times"].sum())
    return np.log((1 + n) / (1 + slots)).astype(np.float32)


def fitted(
    labelled: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS
) -> tuple:
    """The model from text and ``lang`` (neither null): (idf, languages, centres, bars)."""
    import numpy as np

    idf = inverse_frequencies(labelled.select("text"))
    # One row per text: copies lie side by side in the order and would fill the sample. Only
    # hashes are shuffled, and of the texts those of the sample.
    hashed = labelled.select("lang", "text", F.xxhash64("text").alias("hash"))
    few = hashed.select("lang", "hash").distinct()
    # The least hashes of a language are among the least of each of its parts.
    for parts in PARTS:
        least = W.partitionBy("lang", F.pmod("hash", F.lit(parts))).orderBy("hash")
        few = few.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= per_language).drop("n")
    chosen = hashed.join(F.broadcast(few), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text"))

    def cluster(pdf):
        import pandas as pd

        centres, radius = clustered(vectors(pdf["text"].tolist(), idf), centroids)
        return pd.DataFrame(
            {"lang": pdf["lang"].iloc[0], "centre": list(centres), "bar": [r * REJECT_MARGIN for r in radius]}
        )

    found = (
        chosen.groupBy("lang")
        .applyInPandas(cluster, "lang string, centre array<float>, bar double")
        .orderBy("lang", "bar")
        .toPandas()
    )
    centres = np.array(found["centre"].tolist(), dtype=np.float32).reshape(len(found), len(idf))
    return idf, found["lang"].tolist(), centres, found["bar"].to_numpy()


def _predictor(model: tuple):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        idf, languages, centres, bars = model
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            n = len(texts)
            langs = [UNKNOWN] * n
            scores, rejected = np.zeros(n), np.zeros(n, dtype=bool)
            for at in range(0, n, BATCH):
                part = {
                    i: text
                    for i in range(at, min(at + BATCH, n))
                    if languages and (text := texts[i].as_py()) and has_letter(text)
                }
                if part:
                    cosines = vectors(list(part.values()), idf) @ centres.T
                    best = cosines.argmax(axis=1)
                    for i, j, cosine in zip(part, best, cosines.max(axis=1), strict=True):
                        langs[i] = languages[j]
                        scores[i] = min(max(float(cosine), 0.0), 1.0)
                        rejected[i] = cosine < bars[j]
            keep = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"],
            )

    return run


def predicted(rows: DataFrame, model: tuple) -> DataFrame:
    """The columns before ``text``, the last, and lang_pred, score (the cosine), rejected.

    A null text and one without letters are ``und`` with score 0; so is every text if the
    model knows no language.
    """
    schema = T.StructType(
        [
            *rows.schema.fields[:-1],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    return rows.mapInArrow(_predictor(model), schema)


def held_out(every: int, which: int) -> Column:
    """Whether crc32 of doc_id as text leaves that remainder; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % every == which


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; learned from those with a language whose remainder is not 2.

    A document without doc_id is not learned from and not held out. Empty tables give no
    rows; other columns are ignored; repeated rows are each predicted.
    """
    docs = table(spark, sf_dir, "documents")
    usable = ~held_out(4, 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    model = fitted(docs.filter(usable).select("lang", "text"))
    rows = docs.select("doc_id", F.coalesce(held_out(4, 2), F.lit(False)).alias("held_out"), "text")
    return predicted(rows, model)

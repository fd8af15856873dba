"""Quality rules with risk-controlled cutoffs.

Each rule is a measure of a text and a fixed grid of cutoffs; a text above the cutoff is
rejected. Which cutoff holds is decided per stratum on documents labelled as good: of the
cutoffs whose exact binomial (Clopper-Pearson) upper bound on the share of good documents
that the rule rejects stays below the rule's part of the allowed risk, the lowest is taken.
The bounds hold for all strata, rules and cutoffs at once (Bonferroni), and the allowed
risk is divided among the rules, so that with the stated confidence no stratum loses more
than the allowed share of its good documents. A stratum with too few labels gets no cutoff
and loses nothing.

Settled jointly, the cutoffs keep the same promise with fewer labels. What is tested is the
share of good documents that all rules together reject, so the allowed risk is not divided.
A path sets one rule after the other, each from lax to strict, and ends before the first test
that fails, so the allowed error is not divided among its steps (fixed sequence), only among
strata and paths. There is a path for each rule to come first; the longest one counts.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import spread_join, table, written

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPAN = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

RISK = 0.02
ERROR = 0.05

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

# Rule: (numerator, denominator, cutoffs from strict to lax).
RULES = {
    "symbols": ("n_symbols", "word_chars", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.2, 0.25, 0.3, 0.4, 0.5, 0.6)),
    "repeats": ("n_repeat_words", "n_words", (0.1, 0.15, 0.2, 0.25)),
    "word_length": ("word_chars", "n_words", (12.0, 15.0, 20.0, 30.0)),
}


def measure(text: str | None, span: int = SPAN) -> tuple[int, ...]:
    """The counts of MEASURES for one text; null has none.

    Words end at ASCII white space only. Windows are compared by a rolling hash first and
    word by word where two hashes agree.
    """
    from collections import Counter

    import numpy as np

    if not text:
        return (0, 0, 0, 0, 0, 0)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blanks = sum(data.count(c) for c in b" \t\n\r\x0b\x0c")
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    n = len(words) - span + 1
    if n > 1:
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.uint64)
        mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        rolling = np.zeros(n, dtype=np.uint64)
        for at in range(span):
            rolling = rolling * np.uint64(0xBF58476D1CE4E5B9) + mixed[at : at + n]
        order = np.sort(rolling)
        if (order[1:] == order[:-1]).any():
            known_windows = list(zip(*(ids[at : at + n].tolist() for at in range(span)), strict=True))
            times = Counter(known_windows)
            covered = np.zeros(len(words) + 1, dtype=np.int64)
            for at, window in enumerate(known_windows):
                if times[window] > 1:
                    covered[at] += 1
                    covered[at + span] -= 1
            repeated = int((np.cumsum(covered) > 0).sum())
    return (
        len(words),
        len(text) - blanks,
        sum(text.count(c) for c in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
    )


def _measures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=MEASURES, dtype="int64")


measures = F.pandas_udf(
    _measures, T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])
)


def base_failed() -> Column:
    too_many = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | too_many


def _value(rule: str) -> Column:
    above, below, _ = RULES[rule]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0)


def tail(k: int, n: int, share: float) -> float:
    """P(X <= k) for X binomial with n trials of the given share, summed from the largest
    term down until what follows no longer counts."""
    from math import exp, lgamma, log

    if k >= n:
        return 1.0
    total, i = 0.0, k
    while i >= 0:
        term = exp(
            lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(share) + (n - i) * log(1 - share)
        )
        total += term
        if i < share * n and term <= total * 1e-17:
            break
        i -= 1
    return min(total, 1.0)


def _chooser(risk: float, error: float):
    def choose(n: pd.Series, rejected: pd.Series) -> pd.DataFrame:
        share, out = risk / len(RULES), []
        for good, counts in zip(n, rejected, strict=True):
            row, at = [], 0
            for _, _, cutoffs in RULES.values():
                passed = [
                    c
                    for c, k in zip(cutoffs, counts[at : at + len(cutoffs)], strict=True)
                    if k < share * good and tail(int(k), int(good), share) <= error
                ]
                row.append(min(passed, default=None))
                at += len(cutoffs)
            out.append(row)
        return pd.DataFrame(out, columns=list(RULES), dtype="object")

    return choose


def paths() -> list[list[dict[str, float]]]:
    """For each rule a path that begins with it; every step is the cutoffs set by then."""
    names, out = list(RULES), []
    for at in range(len(names)):
        held, path = {}, []
        for rule in names[at:] + names[:at]:
            for cutoff in reversed(RULES[rule][2]):
                held = held | {rule: cutoff}
                path.append(held)
        out.append(path)
    return out


def _joint_chooser(risk: float, error: float):
    def choose(n: pd.Series, rejected: pd.Series) -> pd.DataFrame:
        out = []
        for good, counts in zip(n, rejected, strict=True):
            best, length, at = {}, 0, 0
            for path in paths():
                passed = 0
                for k in counts[at : at + len(path)]:
                    if not (k < risk * good and tail(int(k), int(good), risk) <= error):
                        break
                    passed += 1
                if passed > length:
                    best, length = path[passed - 1], passed
                at += len(path)
            out.append([best.get(rule) for rule in RULES])
        return pd.DataFrame(out, columns=list(RULES), dtype="object")

    return choose


def cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, joint: bool = False
) -> DataFrame:
    """One row per stratum that has labels: stratum and the cutoff of each rule or null.

    ``labels`` has doc_id and quality; a document labelled both ways counts as not good.
    """
    good = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .select("doc_id")
    )
    if joint:
        # The number of a rule's cutoffs that a document exceeds tells those that reject it.
        above = {
            rule: sum((_value(rule) > c).cast("int") for c in grid) for rule, (_, _, grid) in RULES.items()
        }
        measured = measured.select("*", *(n.alias(f"above_{rule}") for rule, n in above.items()))
        counts = [
            F.sum(
                reduce(
                    Column.__or__,
                    (F.col(f"above_{rule}") > RULES[rule][2].index(c) for rule, c in step.items()),
                ).cast("long")
            )
            for path in paths()
            for step in path
        ]
    else:
        counts = [
            F.sum((_value(rule) > c).cast("long"))
            for rule, (_, _, grid) in RULES.items()
            for c in grid
        ]
    per_stratum = written(
        measured.filter(~base_failed())
        .join(good, "doc_id", "left_semi")
        .groupBy("stratum")
        .agg(F.count(F.lit(1)).alias("good"), F.array(*counts).alias("rejected")),
        "strata",
    )
    tests = max(1, per_stratum.count()) * (len(paths()) if joint else len(counts))
    schema = T.StructType([T.StructField(rule, T.DoubleType()) for rule in RULES])
    choose = F.pandas_udf((_joint_chooser if joint else _chooser)(risk, error / tests), schema)
    return per_stratum.select("stratum", choose("good", "rejected").alias("cut")).select("stratum", "cut.*")


def judged(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR, carry: bool = False,
    joint: bool = False,
) -> DataFrame:
    """doc_id, the measures, base_failed, the cutoffs of the stratum and ``kept``.

    ``carry`` adds ``whole``, the row of ``docs`` as a struct, ``joint`` settles the cutoffs of all
    rules together. Null and empty texts have no
    words and fail the base rules. A null stratum is one of its own, a null doc_id has no
    label. Repeated rows are judged alike. Empty tables give no rows.
    """
    columns = [F.col("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("stratum")]

    def rows(*more: Column) -> DataFrame:
        return docs.select(*columns, *more, measures("text").alias("m")).select("*", "m.*").drop("m")

    measured = written(rows(), "measures")
    found = cutoffs(measured, labels, risk, error, joint)
    sizes = measured.groupBy("stratum").agg(F.count(F.lit(1)).alias("weight"))
    limits = written(sizes.join(found, "stratum", "left"), "cutoffs")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(_value(rule) > F.col(rule), F.lit(False))
    if carry:
        # Texts are measured once more rather than written once more.
        measured = rows(F.struct("*").alias("whole"))
    return spread_join(measured, limits, "stratum", "weight", F.xxhash64("doc_id", "n_words")).select(
        *(["whole"] if carry else []),
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
        "n_lines",
        "stratum",
        *(F.col(rule).alias(f"cut_{rule}") for rule in RULES),
    )


def rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("stratum", "n_lines")


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return judged(docs, labels, carry=True, joint=True).filter("kept").select("whole.*")

"""Removal of repeated passages by content-defined line chunks.

The lines of a text are hashed, and a rolling hash over the last few line hashes ends a
chunk where it is divisible by a small number, but not before the chunk has its least number
of lines, nor with fewer than that many left. Boundaries depend on nearby lines, so a passage
put somewhere else is soon cut in the same places. Chunks that occur more than once in the
corpus keep their first place and go everywhere else.

Places of chunks are short rows with a hash. That equal hashes mean equal bytes is checked by
grouping on the chunk itself, of which copies become one within each task. The places of a
chunk that is in very many are dealt to several tasks.

Chunks are made by string functions in time linear in the text: every line gets the prefix
MARK and the last of a chunk one more line feed, so that two line feeds in a row are found
between chunks and nowhere else. Chunks keep the prefixes until a text is put together.

The edges of a chunk depend on the lines beside it, so a short passage put somewhere else may
be no chunk of its own. With ``passages`` every two lines with words that follow each other,
blank lines between them aside, are a passage too: both go, with what is between, wherever
another place has the two before. The first place of any line keeps it in either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import BLANK, spread_join, table, written

WINDOW = 2
DIVISOR = 2
MIN_LINES = 2
# Fixed by the SQL form: base and modulus of the rolling hash.
BASE, MODULUS = 31, 1 << 31
MARK = "."


def chunks(
    text: Column, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES
) -> Column:
    """The chunks of a text in order; null for null. Lines end at the line feed only.

    Only a text of fewer lines than ``min_lines`` has a chunk that is as short.
    """
    lines = F.split(text, "\n", -1)
    hashes = F.transform(
        lines, lambda line: F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")
    )
    rolled = hashes
    for back in range(1, window):
        earlier = F.concat(
            F.array_repeat(F.lit(0).cast("long"), back), F.slice(hashes, 1, F.size(lines))
        )
        # The shifted array is longer by the lines before the first; they match no line.
        rolled = F.zip_with(rolled, earlier, _plus(BASE**back))
    # A character per line that a chunk may end with. Every match is a chunk, right after the
    # one before, so the search is linear in any text.
    flags = F.array_join(
        F.transform(
            F.slice(rolled, 1, F.greatest(F.size(lines) - min_lines, F.lit(0))),
            lambda h: F.when(h % MODULUS % divisor == 0, "1").otherwise("0"),
        ),
        "",
    )
    ends = F.regexp_replace(flags, rf"\G(.{{{min_lines - 1}}}0*+)1", "$1e")
    marked = F.zip_with(
        lines,
        F.split(ends, ""),
        lambda line, end: F.concat(F.lit(MARK), line, F.when(end == "e", "\n").otherwise("")),
    )
    # A chunk that ends with the text leaves a line feed of its own there.
    return F.split(F.regexp_replace(F.array_join(marked, "\n"), r"\n\z", ""), "\n\n", -1)


def _plus(factor: int):
    return lambda h, earlier: h + earlier * factor


def _row() -> Column:
    """One value for rows alike in id and text."""
    doc, text = F.col("doc_id").cast("string"), F.col("text")
    return F.md5(F.concat(F.coalesce(doc, F.lit("~")), F.lit(":"), F.coalesce(text, F.lit("~"))))


def removed_chunks(
    docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES
) -> DataFrame:
    """row, at (the chunk's number from 0) and n (its lines) of every chunk that goes.

    The first place, by (doc_id with null last, row, chunk), keeps a chunk. ``row`` is the
    md5 of id and text: rows alike in both are one place, so they lose the same chunks.
    Chunks without a word stay.
    """
    # The key comes first: beside the generator it would be made again for every chunk.
    keyed = docs.select("doc_id", "text", F.unhex(_row()).alias("row"))
    split = (
        keyed.select(
            "doc_id", "row", F.posexplode(chunks(F.col("text"), window, divisor, min_lines)).alias("at", "body")
        )
        .withColumn("n", F.regexp_count("body", F.lit("\n")) + 1)
        .filter(F.col("n") >= min_lines)
        .filter(F.col("body").rlike(rf"(?:\A|\n)\{MARK}[^\n]*[^{BLANK}]"))
        .withColumn("hash", F.unhex(F.md5("body")))
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "at").alias("place")
    found = written(split.select(place, "n", "hash"), "chunks")
    # Bytes are compared by grouping on them. Copies become one within each task; a hash that
    # two different chunks share, if there ever is one, takes nothing away.
    shared = (
        split.select("hash", "body").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("bodies"))
        .filter("bodies > 1").select("hash")
    )
    first = (
        found.groupBy("hash")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
    )
    first = written(first.join(written(shared, "shared").hint("merge"), "hash", "left_anti"), "first_chunks")
    # Rows alike in id and text are one place.
    return (
        spread_join(found, first, "hash", "times", F.xxhash64("place"))
        .filter(F.col("place") != F.col("first"))
        .select(F.lower(F.hex("place.row")).alias("row"), "place.at", "n")
        .distinct()
    )


def removed_passages(docs: DataFrame) -> DataFrame:
    """row, start and stop (numbers of lines from 0) of every two lines with words in a row
    that another place has first, by (doc_id with null last, row, start)."""
    keyed = docs.select("doc_id", "text", F.unhex(_row()).alias("row"))
    full = F.filter(
        F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("i"), line.alias("line"))),
        lambda x: x["line"].rlike(rf"[^{BLANK}]"),
    )
    length = F.greatest(F.size("full") - 1, F.lit(0))
    # Half of a SHA-256 stands for the bytes.
    pairs = F.zip_with(
        F.slice("full", F.lit(1), length),
        F.slice("full", F.lit(2), length),
        lambda a, b: F.struct(
            a["i"].alias("start"),
            b["i"].alias("stop"),
            F.unhex(F.substring(F.sha2(F.concat(a["line"], F.lit("\n"), b["line"]), 256), 1, 32)).alias("hash"),
        ),
    )
    split = keyed.select("doc_id", "row", full.alias("full")).select("doc_id", "row", F.explode(pairs).alias("p"))
    found = written(
        split.select(
            F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "p.start").alias("place"),
            "p.stop",
            "p.hash",
        ),
        "pairs",
    )
    first = written(
        found.groupBy("hash")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1"),
        "first_pairs",
    )
    return (
        spread_join(found, first, "hash", "times", F.xxhash64("place"))
        .filter(F.col("place") != F.col("first"))
        .select(F.lower(F.hex("place.row")).alias("row"), "place.start", "stop")
    )


def _flags(numbers: Column) -> Column:
    """A character per number up to the last of the sorted list: g for those in it, else k."""
    before = F.concat(
        F.array(F.lit(-1)), F.slice(numbers, F.lit(1), F.greatest(F.size(numbers) - 1, F.lit(0)))
    )
    gaps = F.zip_with(
        numbers, before, lambda at, last: F.concat(F.repeat(F.lit("k"), at - last - 1), F.lit("g"))
    )
    return F.split(F.array_join(gaps, ""), "")


def without_passages(
    docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES
) -> DataFrame:
    """``whole`` and ``text`` as ``deduplicated`` has them, without repeated passages too."""
    gone = (
        removed_chunks(docs, window, divisor, min_lines)
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("at")).alias("gone"))
    )
    spans = (
        removed_passages(docs)
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )
    lists = gone.join(spans.hint("merge"), "row", "full")
    packed = docs.select(F.struct("*").alias("whole"), "text", _row().alias("row"))
    none = F.array().cast("array<int>")
    numbers = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["stop"])))
    of_chunks = F.flatten(
        F.zip_with(
            chunks(F.col("text"), window, divisor, min_lines),
            _flags(F.coalesce("gone", none)),
            lambda body, flag: F.array_repeat(
                F.coalesce(flag == "g", F.lit(False)),
                F.when(body.isNull(), 0).otherwise(F.regexp_count(body, F.lit("\n")) + 1),
            ),
        )
    )
    of_lines = _flags(F.coalesce(F.array_sort(F.array_distinct(numbers)), none))
    dropped = F.zip_with(
        of_chunks, of_lines, lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b == "g", F.lit(False))
    )
    kept = F.array_compact(
        F.zip_with(
            F.split("text", "\n", -1),
            dropped,
            lambda line, drop: F.when(~F.coalesce(drop, F.lit(False)), line),
        )
    )
    same = F.col("gone").isNull() & F.col("spans").isNull()
    return packed.join(lists.hint("merge"), "row", "left").select(
        "whole", F.when(same, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
    )


def deduplicated(
    docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES
) -> DataFrame:
    """``whole`` (the row as a struct), ``text`` without the chunks that go, ``chunks`` and
    ``lines`` that went.

    Every row stays; a text all of whose chunks went is empty, a null text stays null. An
    empty table gives no rows.
    """
    gone = (
        removed_chunks(docs, window, divisor, min_lines)
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("at")).alias("gone"), F.sum("n").alias("lines"))
    )
    packed = docs.select(F.struct("*").alias("whole"), "text", _row().alias("row"))
    joined = packed.join(gone.hint("merge"), "row", "left")
    # A character per chunk up to the last that goes, made of the gaps between those, as a
    # search of the list for every chunk would take the square of a text's chunks.
    gaps = F.zip_with(
        "gone",
        F.concat(F.array(F.lit(-1)), F.slice("gone", 1, F.array_size("gone") - 1)),
        lambda at, before: F.concat(F.repeat(F.lit("k"), at - before - 1), F.lit("g")),
    )
    kept = F.array_compact(
        F.zip_with(
            chunks(F.col("text"), window, divisor, min_lines),
            F.split(F.array_join(gaps, ""), ""),
            lambda body, flag: F.when(F.coalesce(flag != "g", F.lit(True)), body),
        )
    )
    # Every line begins with the mark; no line holds a line feed.
    text = F.replace(F.concat(F.lit("\n"), F.array_join(kept, "\n")), F.lit(f"\n{MARK}"), F.lit("\n"))
    shortened = F.when(F.size(kept) == 0, "").otherwise(F.substr(text, F.lit(2)))
    return joined.select(
        "whole",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(shortened).alias("text"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("chunks"),
        F.coalesce("lines", F.lit(0)).alias("lines"),
    )


def deduplicated_rows(docs: DataFrame, passages: bool = False, **settings) -> DataFrame:
    """The rows of ``docs`` with the shortened text, and n_chars, if there, made to match.

    ``passages`` takes out repeated passages that are no chunk as well.
    """
    shortened = without_passages if passages else deduplicated
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return shortened(docs, **settings).select(
        *(new.get(c, F.col("whole").getField(c)).alias(c) for c in docs.columns)
    )


def lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select(
        "whole.doc_id",
        "text",
        F.col("chunks").alias("n_chunks_removed"),
        F.col("lines").alias("n_lines_removed"),
    )

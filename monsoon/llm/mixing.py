"""Mixing sources to target weights by Sainte-Lague apportionment.

The words of the mix are dealt in equal blocks. Sources get blocks by highest quotients
target / (2k + 1); the blocks of a source go to its shards in the same way, in proportion
to the blocks each has. A shard is a seeded share of a source's documents, laid end to end
in a seeded order and cut into its blocks, and its quota is met by whole rounds of all its
blocks and a run of blocks from a seeded start, round its end. What a document gives is
then plain arithmetic on positions; blocks are never rows.

Highest quotients need no sorted list of all quotients: two divisors that surely give too
few and too many blocks leave about two quotients per party between them, and only those
are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monsoon.llm.common import BLANK, WORD, spread_join, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 16
SHARD_WORDS = 250_000
ROW_WORDS = 64
MAX_SHARDS = 65_536
SEED = "mix-1"


def _key(seed: str) -> Column:
    """Seeded, and the same for rows alike in id and text only."""
    doc, text = F.col("doc_id").cast("string"), F.col("text")
    parts = F.lit(seed + ":"), F.coalesce(doc, F.lit("~")), F.lit(":"), F.coalesce(text, F.lit("~"))
    return F.md5(F.concat(*parts))


def _party() -> Column:
    """The source, null made a value."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    """Slim rows: party, size, and a seeded key."""
    return docs.select(
        "doc_id",
        _party().alias("party"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _key(seed).alias("key"),
    )


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target``: ``share`` of all words by weight, ``most`` times its size at most.

    Sources by code point, null last, take the weights in turn. Sources at their most are
    found from the least size per weight on, each time against what is left. One row per
    source passes one window.
    """
    order = W.orderBy(F.col("party") == "", "party")
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    weighed = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    ).withColumn("cap", F.col("source_size") * float(most))
    rising = W.orderBy(F.col("cap") / F.col("weight"), "party")
    everything = W.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(share)
        - F.sum("cap").over(rising.rowsBetween(W.unboundedPreceding, W.currentRow))
        + F.col("cap")
    ) / F.sum("weight").over(rising.rowsBetween(W.currentRow, W.unboundedFollowing))
    levelled = weighed.withColumn("level", level).withColumn(
        "open", F.col("cap") / F.col("weight") > F.col("level")
    )
    final = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    return levelled.withColumn(
        "target", F.when(F.col("open"), final * F.col("weight")).otherwise(F.col("cap"))
    ).drop("weight", "cap", "level", "open")


def apportioned(parties: DataFrame, group: list[str], order: list[str], claim: str, seats: str, out: str) -> DataFrame:
    """Adds ``out``: how many of the ``seats`` (a column, one value per group) each party
    gets by highest quotients claim / (2k + 1), ties to the first by ``order``."""
    whole = W.partitionBy(*group)
    bounded = parties.withColumns(
        {"__all": F.sum(claim).over(whole), "__n": F.count(F.lit(1)).over(whole)}
    ).withColumns(
        {
            "__low": _seats(claim, F.col(seats) - F.col("__n") / 2 - 1),
            "__high": _seats(claim, F.col(seats) + F.col("__n") / 2 + 1),
        }
    )
    bounded = bounded.withColumn("__open", F.col(seats) - F.sum("__low").over(whole))
    between = bounded.filter(F.col("__high") > F.col("__low")).select(
        "*", F.explode(F.sequence("__low", F.col("__high") - 1)).alias("__k")
    )
    ranked = between.withColumn(
        "__rank",
        F.row_number().over(
            whole.orderBy((F.col(claim) / (2 * F.col("__k") + 1)).desc(), *order, "__k")
        ),
    )
    won = ranked.filter(F.col("__rank") <= F.col("__open")).groupBy(*group, *order).agg(
        F.count(F.lit(1)).alias("__won")
    )
    return (
        bounded.join(won, [*group, *order], "left")
        .withColumn(out, F.col("__low") + F.coalesce("__won", F.lit(0)))
        .drop("__all", "__n", "__low", "__high", "__open", "__won")
    )


def _seats(claim: str, of) -> Column:
    """Seats at the divisor that shares out ``of`` in all."""
    exact = F.col(claim) * F.greatest(of, F.lit(0)) / F.col("__all")
    return F.coalesce(F.floor(exact + 0.5), F.lit(0)).cast("long")


def mixed(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken; and rounds, first, second of each document.

    ``rounds`` copies of the whole document and of its words those in the spans ``first``
    and ``second`` ([from, to), 0-based) make up ``taken``, ``most`` times the size at most.
    Null and empty texts have size 0 and give nothing; a null source is a source; rows with
    null or repeated ids count each for itself (rows alike in id and text lie side by side
    and may differ in what they give). An empty table gives no rows. A source's words differ
    from its target by less than two blocks and a thousandth.
    """
    sized = written(_sized(docs, seed), "sizes")
    sources = sized.groupBy("party").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    aimed = targets(sources, weights, share, most).withColumns(
        {
            "all_blocks": F.round(F.sum("target").over(W.partitionBy()) / block).cast("long"),
            "one": F.lit(1),
            "shards": F.least(
                F.lit(MAX_SHARDS),
                F.ceil((F.col("source_size") + F.col("rows") * ROW_WORDS) / shard_words),
            ).cast("int"),
        }
    )
    aimed = written(apportioned(aimed, ["one"], ["party"], "target", "all_blocks", "blocks"), "sources")
    start = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    dealt = spread_join(
        sized,
        aimed.select("party", "source_size", "target", "blocks", "shards", "rows"),
        "party",
        "rows",
        F.xxhash64("key"),
    ).withColumn("shard", F.pmod(start, F.col("shards").cast("long")))
    dealt = written(dealt.drop("shards"), "dealt")
    shards = dealt.groupBy("party", "shard").agg(
        F.sum("size").alias("words"), F.max("blocks").alias("source_blocks")
    )
    shards = shards.withColumn(
        "has", F.greatest(F.lit(1), F.round(F.col("words") / block)).cast("long")
    ).filter("words > 0")
    shards = shards.withColumn(
        "due", F.least("source_blocks", most * F.sum("has").over(W.partitionBy("party")))
    )
    quotas = apportioned(shards, ["party"], ["shard"], "has", "due", "quota")
    seeded = F.md5(F.concat(F.lit(seed + ":"), "party", F.lit(":"), F.col("shard").cast("string")))
    quotas = quotas.select(
        "party",
        "shard",
        "words",
        "has",
        F.least("quota", F.col("has") * most).alias("quota"),
        F.pmod(F.conv(F.substring(seeded, 1, 8), 16, 10).cast("long"), F.col("has")).alias("run"),
    ).select(
        "party",
        "shard",
        "words",
        F.expr("quota div has").alias("rounds"),
        F.expr("run * words div has").alias("run_from"),
        F.expr("least(run + quota % has, has) * words div has").alias("run_to"),
        F.expr("greatest(run + quota % has - has, 0) * words div has").alias("wrap_to"),
    )
    laid = W.partitionBy("party", "shard").orderBy("key", "doc_id", "size")
    placed = dealt.join(quotas, ["party", "shard"], "left").withColumn(
        "end", F.sum("size").over(laid.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    begin = F.col("end") - F.col("size")

    def span(a, b):
        low = F.least(F.greatest(F.coalesce(a, F.lit(0)) - begin, F.lit(0)), F.col("size"))
        high = F.least(F.greatest(F.coalesce(b, F.lit(0)) - begin, F.lit(0)), F.col("size"))
        return F.struct(low.alias("from"), high.alias("to"))

    spans = placed.withColumns(
        {
            "rounds": F.coalesce("rounds", F.lit(0)).cast("long"),
            "first": span(F.col("run_from"), F.col("run_to")),
            "second": span(F.lit(0), F.col("wrap_to")),
        }
    )
    taken = (
        F.col("rounds") * F.col("size")
        + F.col("first.to") - F.col("first.from")
        + F.col("second.to") - F.col("second.from")
    )
    return spans.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        "rounds",
        "first",
        "second",
        "key",
        "party",
    )


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, as often as they are taken, with all columns.

    Whole rounds repeat the row; a row of which a part is taken holds those words, with the
    white space before each but the first, as ``text``; ``n_chars``, if there is such a
    column, is the length of the text. Documents without words are not in the mix. Rows alike
    in id, text and source share out what all of them give, in the order of a hash of the rows.
    """
    key = _key(settings.get("seed", SEED))
    alike = W.partitionBy("key", "party")
    found = mixed(docs, **settings).filter("taken > 0")
    found = found.withColumn("copy", F.row_number().over(alike.orderBy("rounds", "first", "second")))
    all_words = F.struct(F.lit(0).cast("long").alias("from"), F.col("size").alias("to"))
    parts = F.filter(F.array("first", "second"), lambda s: s["to"] > s["from"])
    spans = found.select(
        "key",
        "party",
        "copy",
        "size",
        F.explode(
            F.concat(F.array_repeat(all_words, F.col("rounds").cast("int")), parts)
        ).alias("span"),
    )
    # The join finds the texts in the partitions where they were numbered.
    texts = docs.select(F.struct("*").alias("whole"), key.alias("key"), _party().alias("party"))
    texts = texts.withColumn("copy", F.row_number().over(alike.orderBy(F.xxhash64("whole"))))
    rows = texts.join(spans, ["key", "party", "copy"]).select("whole", "size", "span")
    first, n = F.col("span.from").cast("int"), (F.col("span.to") - F.col("span.from")).cast("int")
    words = F.regexp_extract_all("whole.text", F.lit(f"([{BLANK}]*{WORD})"), F.lit(1))
    cut = F.regexp_replace(F.array_join(F.slice(words, first + 1, n), ""), f"^[{BLANK}]+", "")
    text = F.when(n < F.col("size"), cut).otherwise(F.col("whole.text"))
    rows = rows.withColumn("cut", text)
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return rows.select(*(new.get(c, F.col("whole").getField(c)).alias(c) for c in docs.columns))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")

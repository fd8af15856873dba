"""What several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.session import scratch

# A word is a run of anything but ASCII white space.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"

# A key is hot when it holds more than this share of all rows, so there are fewer than
# 1 / HOT_SHARE hot keys whatever the data.
HOT_SHARE = 1 / 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read from there."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discarded(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread_join(
    big: DataFrame, small: DataFrame, key: str, weight: str, spread: Column, how: str = "inner"
) -> DataFrame:
    """Join ``big`` with ``small`` (one row per key), spreading hot keys over tasks.

    ``small[weight]`` says how many rows of ``big`` have the key; ``spread`` is any evenly
    distributed integer of ``big``'s rows. A key with more than HOT_SHARE of all rows is
    dealt to several tasks, and its row of ``small`` is repeated for each. Only the hot
    keys, fewer than 1 / HOT_SHARE, are broadcast. Null keys match nothing.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    share = max(1, math.ceil(total * HOT_SHARE))
    parts = F.ceil(F.col(weight) / F.lit(share)).cast("int")
    hot = small.filter(F.col(weight) > share).select(key, parts.alias("__parts"))
    left = big.join(F.broadcast(hot), key, "left").withColumn(
        "__part",
        F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(spread, F.col("__parts"))).cast("int"),
    )
    right = small.withColumn(
        "__part",
        F.explode(F.sequence(F.lit(0), F.when(F.col(weight) > share, parts - 1).otherwise(0))),
    ).drop(weight)
    return left.join(right, [key, "__part"], how).drop("__part", "__parts")

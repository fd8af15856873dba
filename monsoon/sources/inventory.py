"""What is stored: files, and rows per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monsoon import schemas as S
from monsoon.session import settle
from monsoon.sources.weather import documents, indented_of, lines_per_file, readable
from monsoon.streaming.triggers import DRAIN

COUNTED = S.shape(path=S.TEXT, jumlah_event=S.WHOLE)


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of every file. The content column is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def inventory(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Every file with size, time and rows; a file without rows has 0."""
    return with_counts(files, rows_per_file(rows))


def with_counts(files: DataFrame, counted: DataFrame) -> DataFrame:
    """As ``inventory``, from rows counted before. Files no longer there are left out."""
    return files.join(counted, "path", "left").na.fill(0, ["jumlah_event"])


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows each file contributes to a file-based frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("jumlah_event")
    )


def count_stream(records: DataFrame, path: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Count the rows of files not counted before, and add them to the counts below the path.

    ``records`` is ``weather_records_stream``, which gives a file to one batch whole. The
    batch is read once; only documents over several lines are read again, whole. A repeated
    batch replaces its own counts. A file is known by its name: one that is written anew
    under the same name keeps its count.
    """

    def keep(batch: DataFrame, number: int) -> None:
        lines = settle(lines_per_file(batch))
        counted = lines.select("path", F.col("records").alias("jumlah_event"))
        indented = indented_of(lines)
        if indented:
            whole = readable_per_file(documents(batch.sparkSession, indented))
            counted = counted.filter(~F.col("path").isin(indented)).unionByName(whole)
        counted.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        records.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{path}/_checkpoint")
        .trigger(**trigger)
        .start()
    )


def readable_per_file(records: DataFrame) -> DataFrame:
    """Readable records of each file, of a frame that has the file's path."""
    own = records.withColumn("file", F.col("path"))
    return readable(own).groupBy(F.col("file").alias("path")).agg(F.count(F.lit(1)).alias("jumlah_event"))


def counted_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows per file as ``count_stream`` stored them; files without a readable row may lack."""
    return spark.read.schema(COUNTED).option("basePath", path).parquet(path).drop("batch")

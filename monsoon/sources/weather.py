"""Stored weather files and landed service answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon import schemas as S
from monsoon.functions.wire import BLANKS


def _scan(spark: SparkSession, path: str | list[str], multi_line: bool, extra: T.StructType) -> DataFrame:
    corrupt = T.StructField(S.CORRUPT, T.StringType())
    schema = T.StructType([*extra.fields, *S.OBSERVATION.fields, corrupt])
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", S.CORRUPT)
        .json(path)
    )


def _unreadable() -> Column:
    """A record that gave no field but its own text.

    Every field is looked at, so all are parsed for any query: which records count must not
    depend on the columns a query asks for. Analyses that repeat read curated files, where
    columns are pruned.
    """
    fields = F.coalesce(*(F.col(name).cast("string") for name in S.OBSERVATION.names))
    return fields.isNull() & F.col(S.CORRUPT).isNotNull()


def weather_files(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    extra: T.StructType = T.StructType(),
) -> DataFrame:
    """Every observation of every batch file under ``path``, a directory or glob.

    Each line is a record or a whole array of records, as batch files and the files of
    ``store_stream`` have them, and large files are split over tasks. Arrays indented
    over several lines need ``multi_line``, which reads a file as one document and
    therefore must not be used on files with a record per line: only the first would
    be read. ``extra`` declares fields beyond those of an observation.
    """
    return _scan(spark, path, multi_line, extra).filter(~_unreadable()).drop(S.CORRUPT)


def weather_rejects(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The records ``weather_files`` leaves out, with file and text."""
    return (
        _scan(spark, path, multi_line, T.StructType())
        .select("*", F.col("_metadata.file_path").alias("path"))
        .filter(_unreadable())
        .select("path", F.col(S.CORRUPT).alias("isi"))
    )


def with_path(records: DataFrame) -> DataFrame:
    return records.select("*", F.col("_metadata.file_path").alias("path"))


def readable(records: DataFrame) -> DataFrame:
    return records.filter(~_unreadable()).drop(S.CORRUPT, "path")


def refused(records: DataFrame) -> DataFrame:
    return records.filter(_unreadable()).select("path", F.col(S.CORRUPT).alias("isi"))


def count_refused() -> Column:
    return F.count_if(_unreadable())


def lines_per_file(records: DataFrame) -> DataFrame:
    """Records, beginnings of documents and other lines of each file read by line.

    Rows are counted within each task first, so a large file sends a row per task.
    """
    begins = F.col(S.CORRUPT).rlike(r"^[\[{]")
    more = F.btrim(F.col(S.CORRUPT), F.lit(BLANKS)) != ""
    return records.groupBy("path").agg(
        F.count_if(~_unreadable()).alias("records"),
        F.count_if(_unreadable() & begins).alias("documents"),
        F.count_if(_unreadable() & ~begins & more).alias("inner"),
    )


def indented_of(counts: DataFrame) -> list[str]:
    """Files that are one document over several lines: such a file begins one document, goes
    on for several lines and has no line that is a record.

    Names of the files found come to the driver, which has every file's name from listing
    the folder.
    """
    found = counts.filter("records = 0 AND documents = 1 AND inner > 1")
    return [row.path for row in found.select("path").collect()]


def indented_files(records: DataFrame) -> list[str]:
    """Files, read by line, that are one document over several lines."""
    return indented_of(lines_per_file(records))


def weather_of_any_layout(
    spark: SparkSession, path: str, extra: T.StructType = T.StructType()
) -> tuple[DataFrame, DataFrame]:
    """Observations and unreadable records of files of both layouts below one path.

    Each file is read its own way. The names decide while files are listed, so no file is
    opened by the reader of the other layout.
    """
    records = with_path(_scan(spark, path, False, extra))
    indented = indented_files(records)
    if indented:
        listed = F.col("path").isin(indented)
        whole = with_path(_scan(spark, path, True, extra)).filter(listed)
        records = records.filter(~listed).unionByName(whole)
    return readable(records), refused(records)


def documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The records of files of one document each."""
    return with_path(_scan(spark, paths, True, T.StructType()))


def curated_weather(spark: SparkSession, path: str) -> DataFrame:
    """Observations stored by ``curate_stream``; a filter on the day prunes directories."""
    added = S.shape(ts_obj=S.INSTANT, event_date=T.DateType(), batch=S.WHOLE)
    return spark.read.schema(T.StructType([*S.OBSERVATION.fields, *added])).parquet(path).drop("batch")


def wrong_layout(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Files that would lose records if read in this layout, with the reason.

    Read as one document, a file with several would give its first only; read by line, a
    document over several lines would give none.
    """
    line = F.btrim(F.col("value"), F.lit(BLANKS))
    begins = F.col("value").rlike(r"^[\[{]")
    counts = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("path"), "value")
        .groupBy("path")
        .agg(
            F.count_if(begins).alias("documents"),
            F.count_if((line != "") & ~begins).alias("inner"),
        )
    )
    if multi_line:
        return counts.filter("documents > 1").select("path", F.lit("several documents").alias("alasan"))
    indented = counts.filter("documents = 1 AND inner > 1")
    return indented.select("path", F.lit("one document over several lines").alias("alasan"))


def weather_records_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Records of batch files as they appear, read by line, those that cannot be read too."""
    corrupt = T.StructField(S.CORRUPT, T.StringType())
    reader = spark.readStream.schema(T.StructType([*S.OBSERVATION.fields, corrupt]))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_path(reader.option("columnNameOfCorruptRecord", S.CORRUPT).json(path))


def landed_responses_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Landed answers of the weather service, one row per city and poll."""
    reader = spark.readStream.schema(S.RAW_RESPONSE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)

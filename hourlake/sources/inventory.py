"""File inventories of the landing area and of the published table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.hours import (
    PARTITION_COLUMNS, HourRange, HourSpec, below_root, hour_columns_from_path, hour_glob, in_hour_folder,
)
from hourlake.sources.landing import path_missing, root_path

INVENTORY_SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
     T.StructField("modificationTime", T.TimestampType())]
    + [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS]
)


def _listing(spark: SparkSession, paths: str, file_glob: str | None) -> DataFrame:
    # binaryFile lists through Spark's file index (in parallel for many
    # folders); selecting only path/length/modificationTime prunes the
    # content column, so no file is opened.
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.load(paths)


def _one_form(uri: Column) -> Column:
    """file:///x and file:/x are the same file."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def file_names(df: DataFrame):
    """The URIs of a frame's files, as a list that stays in the JVM, which holds the listing anyway.

    Py4J passes a String[] only where one is declared, not where Java takes any array, so a class with such a
    constructor makes the list of it; nothing is run."""
    return df.sparkSession._jvm.java.lang.ProcessBuilder(df._jdf.inputFiles()).command()


def same_files(a: DataFrame, b: DataFrame) -> bool:
    names = a.sparkSession._jvm.java.util.HashSet
    return names(file_names(a)).equals(names(file_names(b)))


def _with_empty_files(files: DataFrame) -> DataFrame:
    """path, length, modificationTime of a listing, 0-byte files included: Spark plans no
    split for those, so they are the names of its index (held on the driver
    anyway) that make no row. Their modification time is not known."""
    rows = files.select("path", "length", "modificationTime", _one_form(F.col("_metadata.file_path")).alias("_uri"))
    spark = files.sparkSession
    names = spark._jsparkSession.createDataset(file_names(files), spark._jvm.org.apache.spark.sql.Encoders.STRING()).toDF()
    every = DataFrame(names, spark).select(_one_form(F.col("value")).alias("_uri"))
    empty = every.join(rows.select("_uri"), "_uri", "left_anti").select(
        F.url_decode(F.replace("_uri", F.lit("+"), F.lit("%2B"))).alias("path"), F.lit(0).cast("bigint").alias("length"),
        F.lit(None).cast("timestamp").alias("modificationTime"))
    return rows.drop("_uri").unionByName(empty)


def _with_hour(files: DataFrame, base: str, layout: str) -> DataFrame:
    placed = files.select("*", below_root(F.col("path"), base).alias("_below"))
    return placed.where(in_hour_folder(F.col("_below"), layout)).select(
        "path", "length", "modificationTime", *hour_columns_from_path(F.col("_below"), layout))


def list_files(spark: SparkSession, root: str, hours: HourSpec = "all", layout: str = "plain",
               file_glob: str | None = None) -> DataFrame:
    """One row per landing file in ``hours``: path, bytes, modification time
    and the hour folder it sits in, or under. Hidden files are not listed. The
    listing is taken now, actions on the frame reuse it. A missing root raises
    FileNotFoundError."""
    root, hr = root.rstrip("/"), HourRange.parse(hours)
    base = root_path(spark, root, encoded=False)
    try:
        files = _listing(spark, root if hr.everything else hour_glob(root, hr, layout), file_glob)
    except AnalysisException as err:
        if not path_missing(err):
            raise
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    return _with_hour(_with_empty_files(files), base, layout)


def list_published_files(spark: SparkSession, dest: str) -> DataFrame:
    """One row per Parquet file of the published table."""
    dest = dest.rstrip("/")
    try:
        files = _listing(spark, dest, "*.parquet")
    except AnalysisException as err:
        if not path_missing(err):
            raise
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    return _with_hour(files, root_path(spark, dest, encoded=False), "hive")


def modified_since(files: DataFrame, since: datetime | str) -> DataFrame:
    """Files modified at or after ``since`` (inclusive, unlike the reader's
    strict ``modifiedAfter`` option). A naive ``since`` is read as UTC,
    whatever the session time zone."""
    if isinstance(since, datetime):
        if since.tzinfo is not None:
            since = since.astimezone(timezone.utc).replace(tzinfo=None)
        since = since.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return files.where(F.col("modificationTime") >= F.lit(since).cast("timestamp"))

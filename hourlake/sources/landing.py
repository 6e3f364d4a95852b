"""Scans of the landing area: hourly folders of JSON text files."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.hours import (
    PARTITION_COLUMNS, HourRange, HourSpec, are_hour_keys, below_root, hour_columns_from_path, hour_glob, in_hour_folder,
)
from hourlake.functions.json_text import line_documents, strip_json

SOURCE_FILE = "_source_file"

LINES_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS]
    + [T.StructField(SOURCE_FILE, T.StringType())]
)


#: Whether ``doc`` is exactly one JSON value.
WHOLE = "_one_value"


def path_missing(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    return (cond() if cond else None) == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(err)


def path_exists(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def root_path(spark: SparkSession, root: str, must_exist: bool = True, encoded: bool = True) -> str:
    """The path of ``root`` on whatever file system it is, without scheme, host and closing slash; ``encoded`` as
    in the URIs of ``_metadata.file_path``.

    A root that does not exist is an error, not an area without files: a mistyped
    name must not look like hours that went empty.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if must_exist and not fs.exists(path):
        raise FileNotFoundError(f"no such landing root: {root}")
    uri = fs.makeQualified(path).toUri()
    return (uri.getRawPath() if encoded else uri.getPath()).rstrip("/")


def _by_partition(spark: SparkSession, root: str, paths: str, file_glob: str | None) -> DataFrame | None:
    """Lines with the hour keys as Spark's own partition columns, which are constants of a file. None if the
    folders below ``root`` are not all named alike, so that Spark finds no partitioning in them."""
    reader = spark.read.schema(T.StructType(LINES_SCHEMA.fields[:-1])).option("basePath", root)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    try:
        raw = reader.text(paths)
    except (AnalysisException, Py4JJavaError, SparkRuntimeException) as err:
        if "CONFLICTING" not in str(err) and "onflicting" not in str(err):
            raise
        return None
    return raw.select("value", *PARTITION_COLUMNS, F.col("_metadata.file_path").alias(SOURCE_FILE)).where(are_hour_keys())


def read_lines(spark: SparkSession, root: str, hours: HourSpec = "all", layout: str = "plain",
               file_glob: str | None = None) -> DataFrame:
    """Text lines of every landing file in ``hours``, with the hour they were
    landed under and the file they came from.

    The hour is the folder's, not a field of the record: a record stamped
    01:59 that landed in the 02 folder belongs to hour 02. Files in folders below
    an hour folder belong to that hour. Hidden files (``_x``, ``.x``) are skipped
    by Spark's listing. Hours without any file yield no rows; if no hour has a
    file the frame is empty; a missing ``root`` raises FileNotFoundError.
    """
    root = root.rstrip("/")
    hr = HourRange.parse(hours)
    base = root_path(spark, root)
    # A closed range is one glob of hour folders (Spark then lists the matched
    # folders with a parallel job). For every hour the root itself is read: its
    # tree is listed level by level in parallel, rather than the driver expanding
    # a glob over every year, month and day folder one call at a time.
    paths = root if hr.everything else hour_glob(root, hr, layout)
    try:
        if layout == "hive" and (lines := _by_partition(spark, root, paths, file_glob)) is not None:
            return lines
        reader = spark.read.option("recursiveFileLookup", "true")
        if file_glob:
            reader = reader.option("pathGlobFilter", file_glob)
        raw = reader.text(paths)
    except AnalysisException as err:
        if not path_missing(err):
            raise
        return spark.createDataFrame([], LINES_SCHEMA)
    return with_hour(raw, base, layout, checked=not hr.everything)


def with_hour(raw: DataFrame, base: str, layout: str, checked: bool = False) -> DataFrame:
    """``raw`` text with the hour keys cut from the file's path at fixed places; files outside hour folders are left
    out, unless the caller has ``checked`` that there are none."""
    path = F.col("_metadata.file_path")
    lines = raw.select("value", path.alias(SOURCE_FILE), below_root(path, base).alias("_below"))
    if not checked:
        lines = lines.where(in_hour_folder(F.col("_below"), layout))
    return lines.select("value", *hour_columns_from_path(F.col("_below"), layout), SOURCE_FILE)


def documents(lines: DataFrame) -> DataFrame:
    """One row per JSON document: lines are split where values were
    written back to back or with commas, and top-level arrays give one row per
    element. Blank fragments are dropped, as Spark's JSON reader drops blank lines.
    Columns: ``doc``, whether it is one JSON value, and the hour keys and source
    file of ``lines``."""
    keep = [c for c in lines.columns if c != "value"]
    # Trimmed once, below the generator: its branches do not do so again.
    trimmed = lines.select(strip_json(F.col("value")).alias("value"), *keep).where(F.col("value") != "")
    values = trimmed.select(F.explode(line_documents(F.col("value"))).alias("_v"), *keep)
    return values.select(F.col("_v.doc").alias("doc"), F.col("_v.whole").alias(WHOLE), *keep)


def read_documents(spark: SparkSession, root: str, hours: HourSpec = "all",
                   layout: str = "plain", file_glob: str | None = None) -> DataFrame:
    return documents(read_lines(spark, root, hours, layout, file_glob))

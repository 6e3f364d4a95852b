"""Reading the published hourly Parquet table back."""

from __future__ import annotations

import calendar
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.hours import PARTITION_COLUMNS, HourRange, HourSpec, hour_glob, hour_predicate
from hourlake.operators.schema import quoted
from hourlake.sources.landing import path_missing, root_path
from hourlake.sources.schema_log import logged_schema


def published_schema(spark: SparkSession, dest: str, data_schema: T.StructType | None = None,
                     paths: str | None = None) -> T.StructType:
    """Data columns plus the hour keys typed as strings ("06", not 6).

    Without ``data_schema`` they are those of the lake's schema log; a lake without one (not written by
    this package) shows those of the footers under ``paths``, merged by name.
    """
    if data_schema is None:
        data_schema = logged_schema(spark, dest)
    if data_schema is None:
        data_schema = spark.read.option("mergeSchema", "true").option("basePath", dest).parquet(paths or dest).schema
    fields = [f for f in data_schema.fields if f.name not in PARTITION_COLUMNS]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS])


def read_published(spark: SparkSession, dest: str, hours: HourSpec = "all",
                   schema: T.StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """The published table. A closed range lists and reads its own hour folders
    only, however many the lake holds; within them the predicate on the hour
    keys is a ``PartitionFilter``. Hours that were never published give no rows.

    Without a ``schema`` every column that any run published is there, NULL in
    the hours that lack it. With ``merge_schema`` those of the read files' footers are added to what the log or ``schema`` names.
    """
    dest, hr = dest.rstrip("/"), HourRange.parse(hours)
    paths = dest if hr.everything else hour_glob(dest, hr, "hive")
    try:
        full = published_schema(spark, dest, schema, paths)
        if merge_schema:
            found = published_schema(spark, dest, spark.read.option("mergeSchema", "true").option("basePath", dest).parquet(paths).schema)
            have = {f.name.lower() for f in full.fields}
            full = published_schema(spark, dest, T.StructType(full.fields + [f for f in found.fields if f.name.lower() not in have]))
        out = spark.read.schema(full).option("basePath", dest).parquet(paths)
        if len(out.columns) > len(full):  # folders below an hour (a stream's batches) are no columns of the table
            out = out.select(*[quoted(n) for n in full.names])
    except AnalysisException as err:
        if not path_missing(err):
            raise
        root_path(spark, dest)
        return spark.createDataFrame([], published_schema(spark, dest, schema or logged_schema(spark, dest) or T.StructType([])))
    return out if hr.everything else out.where(hour_predicate(hr))


def table_schema(spark: SparkSession, table: str) -> T.StructType:
    """The data columns of a registered table."""
    return T.StructType([f for f in spark.table(table).schema.fields if f.name not in PARTITION_COLUMNS])


def register_table(spark: SparkSession, name: str, dest: str, schema: T.StructType | None = None,
                   recover: bool = True) -> None:
    """Expose the published table in the session catalog as an external,
    partitioned Parquet table (``year/month/day/hour`` as string partition
    columns) and register the hour folders as catalog partitions. Columns that
    ``schema`` has and an existing table lacks are added to it.

    Queries on the table then prune hours in the catalog before any listing:
    a one-hour query lists one folder, however many hours the lake holds.
    Call again (or ``ALTER TABLE .. RECOVER PARTITIONS``) after new hours are
    published; the recovery scans the folders with a parallel Spark job.
    """
    full = published_schema(spark, dest.rstrip("/"), schema)
    keys = ", ".join(PARTITION_COLUMNS)
    location = dest.rstrip("/").replace("'", "\\'")
    if not spark.catalog.tableExists(name):
        # Static overwrite for SQL inserts into the table (clear_hours relies on
        # it); the publish itself writes by path with dynamic overwrite.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({full.toDDL()}) USING parquet "
                  f"OPTIONS (partitionOverwriteMode 'static') "
                  f"PARTITIONED BY ({keys}) LOCATION '{location}'")
    else:
        have = {f.name.lower() for f in spark.table(name).schema.fields}
        new = T.StructType([f for f in full.fields if f.name.lower() not in have])
        if new.fields:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({new.toDDL()})")
    if recover:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def add_hours(spark: SparkSession, table: str, hours: list[tuple[str, str, str, str]],
              batch: int = 500) -> None:
    """Register (year, month, day, hour) keys as catalog partitions of
    ``table``, ``batch`` to a statement, without scanning any folder."""
    for at in range(0, len(hours), batch):
        specs = " ".join("PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in zip(PARTITION_COLUMNS, key)) + ")"
                         for key in hours[at: at + batch])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def _collapse(hours: list[tuple[str, str, str, str]]) -> list[tuple[str, ...]]:
    """Partition specs covering exactly ``hours``: a whole day becomes one
    (year, month, day) spec, a whole month one (year, month) spec."""
    days: dict[tuple[str, str, str], set[str]] = {}
    for y, m, d, h in hours:
        days.setdefault((y, m, d), set()).add(h)
    months: dict[tuple[str, str], list[tuple[str, ...]]] = {}
    for (y, m, d), hs in sorted(days.items()):
        specs = [(y, m, d)] if len(hs) == 24 else [(y, m, d, h) for h in sorted(hs)]
        months.setdefault((y, m), []).extend(specs)
    out: list[tuple[str, ...]] = []
    for (y, m), specs in months.items():
        whole = [s for s in specs if len(s) == 3]
        if len(whole) == calendar.monthrange(int(y), int(m))[1]:
            out.append((y, m))
        else:
            out.extend(specs)
    return out


def clear_hours(spark: SparkSession, table: str, hours: list[tuple[str, str, str, str]]) -> None:
    """Delete the published data of the given (year, month, day, hour) keys.

    A static-partition ``INSERT OVERWRITE`` of an empty result removes the
    matching folders (an external table's ``DROP PARTITION`` alone keeps the
    files); the catalog entries are dropped after it. Whole days and months
    are one statement each.
    """
    data = [f for f in spark.table(table).schema.fields if f.name not in PARTITION_COLUMNS]
    # Only the columns matter: nothing is inserted.
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in data]
    empty = spark.range(0)
    for key in _collapse(hours):
        spec = ", ".join(f"{c} = '{v}'" for c, v in zip(PARTITION_COLUMNS, key))
        dynamic = PARTITION_COLUMNS[len(key):]
        rest = [F.lit(None).cast("string").alias(c) for c in dynamic]
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join([spec, *dynamic])}) SELECT * FROM {{nothing}}",
                  nothing=empty.select(*nulls, *rest))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def rows_per_file(spark: SparkSession, root: str, hours: HourSpec = "all") -> DataFrame:
    """Hour keys, ``file`` (its name) and ``rows`` of the files under ``root``, from their footers: no column is read."""
    hr = HourRange.parse(hours)
    keys = T.StructType([T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS])
    try:
        found = spark.read.schema(keys).option("basePath", root).parquet(root if hr.everything else hour_glob(root, hr, "hive"))
    except AnalysisException as err:
        if not path_missing(err):
            raise
        return spark.createDataFrame([], T.StructType([*keys.fields, T.StructField("file", T.StringType()), T.StructField("rows", T.LongType())]))
    return found.groupBy(*PARTITION_COLUMNS, F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def _spec(key) -> str:
    return ", ".join(f"{c} = '{v}'" for c, v in zip(PARTITION_COLUMNS, key))


def run_folder(dest: str, run_id: str) -> str:
    """Where a run that is swapped in keeps its hours; scans of ``dest`` by path do not see it."""
    return f"{dest.rstrip('/')}/_runs/{run_id}"


def swap_hours(spark: SparkSession, table: str, folder: str, hours: list[tuple[str, str, str, str]], batch: int = 500) -> None:
    """Point the catalog partitions of ``hours`` at a run's ``folder``.

    The files are complete before this and no file of an earlier run is touched, so a reader of the
    table sees all of an hour's old files or all of its new ones, never some of both. A failure before leaves every hour
    old; one in between leaves whole hours, and doing it again finishes them.
    """
    at = lambda key: f"{folder}/" + "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLUMNS, key))
    quote = lambda text: text.replace("'", "\\'")
    for begin in range(0, len(hours), batch):
        some = hours[begin: begin + batch]
        specs = " ".join(f"PARTITION ({_spec(key)}) LOCATION '{quote(at(key))}'" for key in some)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
        for key in some:
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(key)}) SET LOCATION '{quote(at(key))}'")


def drop_old_runs(spark: SparkSession, table: str, dest: str, older_than: datetime) -> list[str]:
    """Delete the run folders under ``dest`` that no hour of ``table`` points at and that were made before ``older_than``
    (UTC), which must lie before every run and query that may still be going on. Returns their run ids."""
    used = {r[0] for r in spark.table(table).select(
        F.regexp_extract("_metadata.file_path", "/_runs/([^/]+)/", 1)).distinct().collect()}  # a row per run in use
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(dest, "").rstrip("/"))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = older_than.replace(tzinfo=older_than.tzinfo or timezone.utc).timestamp() * 1000
    gone = []
    for status in fs.listStatus(path) if fs.exists(path) else []:
        name = status.getPath().getName()
        if name not in used and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return gone

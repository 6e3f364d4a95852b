"""Writing rows as JSON into the landing layout (for exports and fixtures)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions.hours import PARTITION_COLUMNS, hour_columns_from_ts
from hourlake.operators.parse import json_options
from hourlake.operators.schema import quoted

STYLES = ("lines", "concat", "array")
# Fixed value: timestamps are written with microseconds.
WRITE_TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_documents(df: DataFrame, columns: list[str] | None = None) -> Column:
    cols = columns or [c for c in df.columns if c not in PARTITION_COLUMNS]
    return F.to_json(F.struct(*[F.col(quoted(c)) for c in cols]),
                     json_options({"timestampNTZFormat": WRITE_TIMESTAMP_NTZ_FORMAT}))


def write_landing(df: DataFrame, root: str, hour_from: Column | str | None = None,
                  style: str = "lines", docs_per_line: int = 1000, rows_per_file: int = 1_000_000,
                  num_partitions: int | None = None, columns: list[str] | None = None,
                  mode: str = "append") -> None:
    """Land ``df`` as JSON text under ``root``/year=YYYY/month=MM/day=DD/hour=HH.

    The hour comes from the timestamp ``hour_from`` or, when None, from
    existing year/month/day/hour columns. ``style``: ``lines`` writes one
    document per line; ``concat`` writes up to ``docs_per_line`` documents
    back to back ("}{") on one line; ``array`` writes them as one JSON array
    per line.

    Every hour is cut into chunks of at most ``rows_per_file`` consecutive
    rows of one scan task (ids taken before the shuffle, so a retried task
    rebuilds the same chunks). Chunks are hashed into ``num_partitions``
    tasks (default ``spark.sql.shuffle.partitions``, an explicit count that
    AQE does not merge), so a hot hour is spread over many tasks and files;
    ``maxRecordsPerFile`` keeps every file at ``rows_per_file`` lines or
    fewer. Lines are cut the same way inside a chunk; grouping them reuses
    the chunk partitioning (no second shuffle, unless the hour keys are
    constants) and no line gathers more than ``docs_per_line`` documents.
    """
    if style not in STYLES:
        raise ValueError(f"style must be one of {STYLES}")
    if hour_from is not None:
        ts = F.col(hour_from) if isinstance(hour_from, str) else hour_from
        df = df.select("*", *hour_columns_from_ts(ts))
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    doc = to_documents(df, columns)
    keys = [F.col(c) for c in PARTITION_COLUMNS]
    row = F.monotonically_increasing_id()
    spread = (df.select(doc.alias("doc"), *keys, row.alias("_row"))
              .select("doc", *keys,
                      F.floor(F.col("_row") / F.lit(int(rows_per_file))).alias("_file"),
                      F.floor(F.col("_row") / F.lit(int(docs_per_line))).alias("_line"))
              .repartition(n, *keys, F.col("_file")))
    if style == "lines":
        out = spread.select(F.col("doc").alias("value"), *keys)
    else:
        grouped = (spread.groupBy(*PARTITION_COLUMNS, "_file", "_line")
                   .agg(F.collect_list("doc").alias("docs")))
        if style == "concat":
            line = F.array_join("docs", "")
        else:
            line = F.concat(F.lit("["), F.array_join("docs", ","), F.lit("]"))
        out = grouped.select(line.alias("value"), *keys)
    (out.write.mode(mode).option("maxRecordsPerFile", int(rows_per_file))
     .partitionBy(*PARTITION_COLUMNS).text(root.rstrip("/")))


def to_plain_layout(spark: SparkSession, root: str) -> None:
    """Rename the folders year=YYYY/month=MM/day=DD/hour=HH under ``root`` to YYYY/MM/DD/HH.

    Spark's partitioned writers only make named folders; this turns a landing written
    by :func:`write_landing` into the layout without names, one rename per folder.
    """
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def rename(folder, level: int) -> None:
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(PARTITION_COLUMNS[level] + "="):
                target = make(folder, name.split("=", 1)[1])
                if level < len(PARTITION_COLUMNS) - 1:
                    rename(status.getPath(), level + 1)
                if not fs.rename(status.getPath(), target):
                    raise OSError(f"could not rename {status.getPath()} to {target}")

    rename(make(root), 0)

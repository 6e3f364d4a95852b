"""The run ledger: an append-only table of ingest runs, per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.hours import PARTITION_COLUMNS

LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("dest", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS],
    T.StructField("files", T.LongType()),
    T.StructField("total_bytes", T.LongType()),
    T.StructField("bytes_processed", T.LongType()),
    T.StructField("run_documents", T.LongType()),
    T.StructField("run_published", T.LongType()),
    T.StructField("run_quarantined", T.LongType()),
    T.StructField("hour_rows", T.LongType()),
    T.StructField("hour_bad", T.LongType()),
    T.StructField("signature", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
])


def run_entries(per_hour: DataFrame, run: dict) -> DataFrame:
    """Ledger rows for one run: the per-hour columns of ``per_hour`` (files, bytes, and, once
    it has ended, the rows it published and the bad documents) with the run-wide values of ``run`` attached."""
    cols = []
    for f in LEDGER_SCHEMA.fields:
        if f.name in per_hour.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(run.get(f.name)).cast(f.dataType).alias(f.name))
    return per_hour.select(*cols)


def append_ledger(entries: DataFrame, ledger: str) -> None:
    # Two small appends per run; the hours of a run decide their size.
    entries.write.mode("append").parquet(ledger.rstrip("/"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger.rstrip("/"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple for every ``keys`` value.

    An aggregate, not a window: max over a struct led by the ordering
    columns runs partially on the map side, so a key holding a third of all
    rows reaches the shuffle as one row per task. With strings among the
    columns Spark sorts each task's rows by key first. Ties on ``order`` are
    broken by the remaining columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest])


def latest_runs(ledger: DataFrame) -> DataFrame:
    """The most recent run of every (source, hour); a run that ended comes before its
    own row from the start, which stays the latest of a run whose driver died."""
    return latest_per_key(ledger, ["source", *PARTITION_COLUMNS], ["start_time", "run_id", "end_time"])


def unchanged_hours(ledger: DataFrame, source: str, dest: str) -> DataFrame:
    """year/month/day/hour/signature of the hours of ``source`` whose latest run into ``dest`` succeeded."""
    mine = ledger.where((F.col("source") == source) & (F.col("dest") == dest))
    return latest_runs(mine).where("status = 'succeeded'").select(*PARTITION_COLUMNS, "signature")

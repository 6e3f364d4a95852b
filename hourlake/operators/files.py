"""Relational operators over file inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.functions.hours import PARTITION_COLUMNS


def new_files(after: DataFrame, before: DataFrame) -> DataFrame:
    """Files listed in ``after`` that ``before`` did not have (left anti join
    on the path; both sides are distributed, nothing is collected)."""
    return after.join(before.select("path"), on="path", how="left_anti")


def bytes_per_hour(files: DataFrame, *more: Column) -> DataFrame:
    """File count and total bytes per hour folder, and ``more`` aggregates (map-side partial
    aggregation, so a hot hour costs one row per task before the shuffle)."""
    return (files.groupBy(*PARTITION_COLUMNS)
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_bytes"), *more))


def total_bytes(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.coalesce(F.sum("length"), F.lit(0).cast("bigint")).alias("total_bytes"))


def signature() -> Column:
    """Aggregate over inventory rows that stays the same as long as the files keep their names, lengths and
    modification times: their number and the sum of their hashes, whatever order they are listed in."""
    name = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(name).cast("string")).alias("signature")


def hour_signatures(files: DataFrame) -> DataFrame:
    return files.groupBy(*PARTITION_COLUMNS).agg(signature())

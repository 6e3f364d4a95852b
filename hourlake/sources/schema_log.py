"""The schema log of a lake: the data columns that its runs published, kept beside the hours.

A run whose columns the log does not hold yet appends one line to ``<dest>/_schema_log`` before it writes
an hour, so every published hour's columns are in the log by the time a reader can see them. (A run that fails
after that leaves columns that no file has; they read as NULL.) The log grows with changes of the
schema, not with runs, and a reader needs no file footer to know all columns of the lake.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.hours import PARTITION_COLUMNS
from hourlake.operators.schema import common_schema
from hourlake.sources.landing import path_exists

LOG_SCHEMA = "run_id string, logged_at string, fields string"


def schema_log_path(dest: str) -> str:
    return f"{dest.rstrip('/')}/_schema_log"  # hidden from scans of the lake


def logged_schema(spark: SparkSession, dest: str) -> T.StructType | None:
    """All data columns that runs published under ``dest``, merged by name in the order they were logged; None without a log."""
    if not path_exists(spark, schema_log_path(dest)):
        return None
    lines = spark.read.schema(LOG_SCHEMA).json(schema_log_path(dest)).collect()  # a line per change of the schema
    known = sorted(lines, key=lambda r: (r.logged_at, r.run_id))
    return common_schema([T.StructType.fromJson(json.loads(r.fields)) for r in known]) if known else None


def log_schema(spark: SparkSession, dest: str, run_id: str, schema: T.StructType) -> None:
    """Add the data columns of ``schema`` to the log unless it has them all, with their types."""
    data = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in PARTITION_COLUMNS])
    known = logged_schema(spark, dest)
    if known is not None and common_schema([known, data]) == known:
        return
    line = (("run_id", run_id), ("logged_at", datetime.now(timezone.utc).isoformat()), ("fields", json.dumps(data.jsonValue())))
    spark.range(1).select(*[F.lit(v).alias(n) for n, v in line]).coalesce(1).write.mode("append").json(schema_log_path(dest))

"""Benchmark: headline hourlake queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints one JSON line. ``ingest`` / ``rerun`` time the publish step alone
``ingest_few_large_hours`` times it where bytes count rather than files, against
``yardstick_few_large_hours``, Spark's own JSON reader and Parquet writer; every other entry times a registered query end to end, landing included,
forced with a no-op write of its whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hourlake.catalog import QUERIES  # noqa: E402
from hourlake.functions.hours import PARTITION_COLUMNS  # noqa: E402
from hourlake.operators.parse import TIMESTAMP_NTZ_FORMAT  # noqa: E402
from hourlake.plans.ingest import ingest  # noqa: E402
from hourlake.session import build_session, scratch_dir  # noqa: E402
from hourlake.sources.json_writer import write_landing  # noqa: E402

HEADLINE = [
    "events_hour_ingest", "events_jsonl_scan", "events_inferred_scan", "array_line_scan",
    "text_with_braces_roundtrip", "nested_struct_roundtrip", "union_by_name_drift",
    "rerun_is_idempotent", "quarantine_bad_lines", "published_rows_reconcile",
    "stream_ingest_available_now", "ledger_latest_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", "hourlake-bench", conf={
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(2 * int(cpus)),
        "spark.driver.memory": "16g",
    })
    timings: dict[str, float] = {}

    # Warm-up (not timed): JVM start, class loading and JIT on a one-hour slice.
    warm = scratch_dir(spark, "bench-warmup")
    sample = spark.read.parquet(f"{sf_dir}/events.parquet").where("ts < timestamp_ntz'2024-01-01 01:00:00'")
    write_landing(sample, f"{warm}/landing", "ts", style="concat")
    ingest(spark, f"{warm}/landing", f"{warm}/published", "all", schema=sample.schema, layout="hive")

    # Publish step alone, as in the yardstick: concatenated JSON, one hour per folder.
    ws = scratch_dir(spark, "bench")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    t0 = time.time()
    write_landing(events, f"{ws}/landing", "ts", style="concat")
    timings["land"] = time.time() - t0
    for step in ("ingest", "rerun"):
        t0 = time.time()
        ingest(spark, f"{ws}/landing", f"{ws}/published", "all", schema=events.schema, layout="hive")
        timings[step] = time.time() - t0

    # Throughput: one row of lineitem per document, a few large hours, read with a declared schema; and
    # the plain reader and writer over the same files at the same cores, as a yardstick.
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    write_landing(items, f"{ws}/large", F.date_trunc("year", "l_shipdate"), style="lines", rows_per_file=100_000)
    t0 = time.time()
    ingest(spark, f"{ws}/large", f"{ws}/large_published", "all", schema=items.schema, layout="hive")
    timings["ingest_few_large_hours"] = time.time() - t0
    t0 = time.time()
    (spark.read.schema(items.schema).option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT).json(f"{ws}/large")
     .write.partitionBy(*PARTITION_COLUMNS).parquet(f"{ws}/yardstick"))
    timings["yardstick_few_large_hours"] = time.time() - t0

    failed = []
    for name in names:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as err:  # noqa: BLE001 - report the failure, keep the JSON line
            failed.append(f"{name}: {type(err).__name__}")
            continue
        timings[name] = time.time() - t0

    total = sum(v for k, v in timings.items() if k in names)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

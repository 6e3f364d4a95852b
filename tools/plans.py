"""Write PLANS.md: formatted physical plans of hourlake's main operators.

python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourlake.functions.hours import PARTITION_COLUMNS  # noqa: E402
from hourlake.operators.files import bytes_per_hour, new_files  # noqa: E402
from hourlake.operators.ledger import latest_per_key  # noqa: E402
from hourlake.operators.parse import CORRUPT, bad_records, good_records  # noqa: E402
from hourlake.catalog import Span  # noqa: E402
from hourlake.functions.hours import hour_predicate  # noqa: E402
from hourlake.sources.landing import SOURCE_FILE, read_documents, read_lines  # noqa: E402
from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from hourlake.operators.reconcile import reconcile  # noqa: E402
from hourlake.plans.ingest import parsed_landing  # noqa: E402
from hourlake.plans.publish import layout_for_write  # noqa: E402
from hourlake.session import build_session, scratch_dir  # noqa: E402
from hourlake.sources.inventory import list_files, list_published_files  # noqa: E402
from hourlake.sources.json_writer import write_landing  # noqa: E402
from hourlake.sources.published import read_published, register_table  # noqa: E402
from hourlake.plans.ingest import ingest  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    ws = scratch_dir(spark, "plans")
    events = spark.read.parquet(f"{sf}/events.parquet")
    write_landing(events, f"{ws}/landing", "ts", style="concat")
    ingest(spark, f"{ws}/landing", f"{ws}/published", "all", schema=events.schema, layout="hive")
    span = Span.of(events)
    parsed, _ = parsed_landing(spark, f"{ws}/landing", (span.day(1)[0], span.day(2)[1]), events.schema, "hive")
    table = "plans_" + ws.rsplit("-", 1)[-1]
    register_table(spark, table, f"{ws}/published", events.schema)
    published = read_published(spark, f"{ws}/published", schema=events.schema)
    counted = layout_for_write(parsed.drop(SOURCE_FILE), "rebalance").observe(
        Observation("plans"), F.count(F.lit(1)).alias("documents"), F.count(F.col(CORRUPT)).alias("bad"))
    sections = [
        ("Publish input, direct strategy (no exchange; one from_json per document)",
         layout_for_write(good_records(parsed), "direct")),
        ("Ingest write input with rebalance: counts (CollectMetrics) after the shuffle, bad rows dropped after",
         good_records(counted)),
        ("Publish input, rebalance strategy", layout_for_write(good_records(parsed), "rebalance")),
        ("Publish input, files_per_hour=2 over 48 hours: one task per hour and salt", layout_for_write(good_records(parsed), files_per_hour=2, tasks=2 * 48)),
        ("Quarantine pass", bad_records(parsed)),
        ("Pruned read of one day (the day's folders are the location; PartitionFilters, ReadSchema of two columns)",
         read_published(spark, f"{ws}/published", span.day(2), schema=events.schema).select("event_id", "value")),
        ("Published hours of a closed range, as clearing looks for them (the range is in PartitionFilters)",
         spark.table(table).where(hour_predicate(span.day(2))).select(*PARTITION_COLUMNS).distinct()),
        ("Landing of every hour (the root is listed, no glob)", read_lines(spark, f"{ws}/landing", "all", "hive")),
        ("Reconcile (all sides aggregated per hour before the joins)",
         reconcile(read_documents(spark, f"{ws}/landing", "all", "hive"), bad_records(parsed), published)),
        ("Bytes per hour (binaryFile, content pruned)",
         bytes_per_hour(list_files(spark, f"{ws}/landing", "all", "hive"))),
        ("New files (anti join on path)",
         new_files(list_published_files(spark, f"{ws}/published"), list_files(spark, f"{ws}/landing", "all", "hive"))),
        ("Latest entry per key (partial aggregate, no window)",
         latest_per_key(spark.read.parquet(f"{sf}/orders.parquet"), ["o_orderstatus", "o_orderpriority"],
                        ["o_orderdate", "o_orderkey"])),
    ]
    out = ["# PLANS", "",
           f"Physical plans (`explain(\"formatted\")`, Spark {spark.version}, local[8], {os.path.basename(sf)}),",
           "generated by `python tools/plans.py`. Paths are scratch folders of that run.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan(df).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Ingest with the first attempt of one write task failing (run by test_retry.py)."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F  # noqa: E402

import hourlake.plans.ingest as ingest_module  # noqa: E402
from hourlake.session import build_session  # noqa: E402
from hourlake.sources.published import read_published  # noqa: E402

src, dest, strategy = sys.argv[1], sys.argv[2], sys.argv[3]
spark = build_session("local[4,3]", conf={"spark.sql.shuffle.partitions": "4"})
original = ingest_module.layout_for_write


def flaky_layout(df, *args, **kwargs):
    @F.udf("boolean")
    def survive(_):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task loss")
        return True
    return original(df, *args, **kwargs).where(survive(F.lit(1)))


ingest_module.layout_for_write = flaky_layout
report = ingest_module.ingest(spark, src, dest, "all", schema="id bigint", strategy=strategy)
rows = read_published(spark, dest).select("id").collect()
print(json.dumps({"documents": report.documents, "published": report.published,
                  "ids": sorted(r.id for r in rows)}))
spark.stop()

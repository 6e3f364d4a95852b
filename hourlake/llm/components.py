"""Connected components of a link table by alternating star contractions, all in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hourlake.llm.chunks import save


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node long, component long) for every node of ``links`` (a long, b long); component is the least node reachable.

    Nulls and self-links are left out; a table without links gives no rows. A node with very many links is a
    sum like any other: least neighbours are partial aggregates, and the join back is one that adaptive
    execution can split. Every round is written to the shared folder, so lost executors repeat one round at most.
    """
    edges = save(links.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v"))
                 .where("u <> v").distinct(), "links")
    mark = None
    while True:
        seen = Observation()
        edges = save(_small_star(_large_star(edges)).observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "links")
        now = (seen.get["n"], seen.get["sum"])
        if now == mark or not now[0]:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)

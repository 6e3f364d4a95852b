"""Places of rows in a global order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.chunks import few, save


def numbered(df: DataFrame, by: list, within: list[str] | None = None, name: str = "numbered") -> DataFrame:
    """``df`` with ``place`` long, from 0, in the order ``by`` among rows equal in the columns ``within``, and
    ``size`` long, how many those are.

    ``by`` begins with ``within``, whose values are not null. One range shuffle sorts the rows; a task's rows then
    count from the sum of the tasks before it, and only a row per task (and value of ``within``) goes through a
    window. Rows equal in ``by`` are dealt over tasks by where they were read, so none of them need share one.
    """
    within = within or []
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    table = save(tied.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
                 .withColumn("_row", F.monotonically_increasing_id()), name)
    table = table.withColumn("_part", F.shiftright("_row", 33))
    counts = table.groupBy(*within, "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("_first"))
    every = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    begins = counts.select(*within, "_part", "_first",
                           (F.sum("n").over(every.orderBy("_part")) - F.col("n")).alias("_before"),
                           F.sum("n").over(every).alias("size"))
    return table.join(few(begins), [*within, "_part"]).select(
        *df.columns, (F.col("_row") - F.col("_first") + F.col("_before")).alias("place"), "size")

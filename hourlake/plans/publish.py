"""Publishing parsed records as Snappy Parquet, one folder per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.functions.hours import PARTITION_COLUMNS
from hourlake.operators.schema import quoted

STRATEGIES = ("direct", "rebalance")
#: Hours (ten years of them) whose sizes a task may hold.
MOST_BROADCAST_HOURS = 100_000


def layout_for_write(df: DataFrame, strategy: str = "direct",
                     files_per_hour: int | None = None,
                     keys: tuple[str, ...] = PARTITION_COLUMNS, tasks: int | None = None) -> DataFrame:
    """Arrange rows so each writer task holds whole hours.

    * ``direct`` (default): no shuffle. Every scan task writes one file per
      hour it read (after a local, spillable sort on the hour keys). A
      landing file belongs to one hour, so no hour gets more output files
      than it has landing files or input splits, a hot hour is written by
      as many tasks as it has splits, and no byte crosses the network.
    * ``rebalance``: compaction for many tiny landing files per hour. One
      shuffle on the hour keys through the REBALANCE hint; AQE coalesces
      small hours into shared tasks and splits a hot hour over several tasks
      by the advisory partition size, so an hour holding a third of all rows
      is never written by one task.
    * ``files_per_hour=n``: at most n files per hour: rows are dealt to n
      salts by a hash of their text form (deterministic under task retries) and
      shuffled on (hour, salt) into ``tasks`` tasks, by default
      ``spark.sql.shuffle.partitions``; a caller who knows the hours asks for
      one task per hour and salt.
    """
    if files_per_hour:
        data_cols = [c for c in df.columns if c not in keys]
        # Through JSON, since maps have no hash.
        text = F.to_json(F.struct(*[F.col(quoted(c)) for c in data_cols]))
        salt = F.pmod(F.xxhash64(text), F.lit(int(files_per_hour)))
        # An explicit count: AQE must not coalesce the (hour, salt) groups into
        # a few tasks, since the cost of this write is per file, not per byte.
        n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(n, *[F.col(k) for k in keys], salt)
    if strategy == "rebalance":
        return df.hint("rebalance", *keys)
    if strategy == "direct":
        return df
    raise ValueError(f"strategy must be one of {STRATEGIES}")


def pack_by_bytes(df: DataFrame, sizes: DataFrame, goal: int, keys: tuple[str, ...] = PARTITION_COLUMNS) -> DataFrame:
    """Deal rows to as many tasks as ``goal`` landed bytes each need.

    ``sizes`` has the landed ``total_bytes`` of every hour. Laid end to end in the order of the hours, the
    bytes are cut every ``goal``: an hour that is larger is spread over the tasks it covers, small neighbours share
    one, and an hour is never written in more than ``total_bytes / goal + 2`` files. A row's place within its
    hour is drawn from where it was read, so equal rows are spread too. Hours that ``sizes`` lacks go to the first task.
    """
    at = Window.orderBy(*keys)  # a row per hour
    spans = sizes.select(*keys, "total_bytes", (F.sum("total_bytes").over(at) - F.col("total_bytes")).alias("_begin"))
    total = sizes.agg(F.sum("total_bytes")).first()[0] or 0
    tasks = max(1, -(-total // int(goal)))
    hours = F.broadcast(spans) if spans.limit(MOST_BROADCAST_HOURS + 1).count() <= MOST_BROADCAST_HOURS else spans
    share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) / F.lit(float(1 << 30))
    task = F.floor((F.col("_begin") + share * F.col("total_bytes")) / F.lit(int(goal)))
    task = F.least(F.coalesce(task, F.lit(0)), F.lit(tasks - 1)).cast("int")
    return df.join(hours, list(keys), "left").withColumn("_task", task).repartitionById(tasks, "_task") \
        .select(*[F.col(quoted(c)) for c in df.columns])


def write_hours(df: DataFrame, dest: str, strategy: str = "direct",
                files_per_hour: int | None = None, row_group_bytes: int | None = None,
                max_records_per_file: int | None = None, compression: str = "snappy",
                keys: tuple[str, ...] = PARTITION_COLUMNS, arrange: bool = True) -> None:
    """Replace exactly the hours present in ``df`` under ``dest``.

    Dynamic partition overwrite stages the new files and swaps each written
    hour folder in at job commit; hours not in ``df`` are untouched, and a
    failed job leaves every old hour as it was. An empty ``df`` changes
    nothing. Re-running an hour therefore never duplicates it.
    ``arrange=False`` writes ``df`` as it is (already arranged by
    :func:`layout_for_write`).
    """
    out = layout_for_write(df, strategy, files_per_hour, keys) if arrange else df
    writer = (out.write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic")
              .option("compression", compression)
              .partitionBy(*keys))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", int(row_group_bytes))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.parquet(dest.rstrip("/"))

"""Incremental ingest of new landing files with Structured Streaming."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hourlake.functions.hours import PARTITION_COLUMNS
from hourlake.operators.files import total_bytes
from hourlake.operators.parse import bad_records, good_records, output_struct, parse_documents
from hourlake.sources.inventory import list_files
from hourlake.sources.landing import documents, path_exists, root_path, with_hour
from hourlake.sources.schema_log import log_schema

MAX_FILE_AGE = "36500d"
BATCH = "batch_id"


def landing_stream(spark: SparkSession, root: str, layout: str = "plain",
                   max_bytes_per_trigger: int | None = None,
                   max_files_per_trigger: int | None = None,
                   source_options: dict | None = None) -> DataFrame:
    """Streaming lines of every landing file not seen before, with the hour
    cut from each file's folder. ``source_options`` go to the file source
    as they are (``maxFileAge``, ``latestFirst``, ``pathGlobFilter`` ...).

    Files are taken whatever their modification time (``maxFileAge`` is a
    hundred years unless given): with Spark's own week, a backfilled file that
    kept an older time would never be read. The price is that the checkpoint's
    log of seen files never forgets a name, about a hundred bytes each; give a
    ``maxFileAge`` where all files are known to land in time.
    """
    root = root.rstrip("/")
    base = root_path(spark, root)
    options = {"maxFileAge": MAX_FILE_AGE, "recursiveFileLookup": "true", **(source_options or {})}
    reader = spark.readStream.format("text").options(**options)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return with_hour(reader.load(root), base, layout)


def ingest_stream(spark: SparkSession, source: str, dest: str, checkpoint: str,
                  schema: T.StructType | str, layout: str = "plain",
                  max_bytes_per_trigger: int | None = None,
                  max_files_per_trigger: int | None = None,
                  available_now: bool = True, json_options: dict | None = None,
                  quarantine: str | None = None,
                  source_options: dict | None = None, max_batches: int | None = None) -> list[StreamingQuery]:
    """Append newly landed documents to ``dest`` (its own root).

    The checkpoint remembers which files were taken, so a later run only
    reads files that landed since. ``max_bytes_per_trigger`` caps each
    micro-batch (a byte cap per flush, as the batch job once had); ``available_now``
    drains everything present in such batches and stops. No shuffle: each
    task writes the hours it read, and batches stay bounded by the cap.

    A micro-batch costs a second or more whatever it holds, so with a fixed cap a large backlog takes as many of these as it
    has caps. ``max_batches`` raises the cap to that share of the landed bytes where it is larger (see :func:`batch_bytes`).

    Without ``quarantine`` the good documents go to a file-sink table, whose ``_spark_metadata`` log makes every
    batch exactly-once. With it, one query parses each batch once (:func:`publish_batch`) and writes
    good documents to ``dest`` and bad ones to ``quarantine``, in folders of the batch. Returns the started queries.
    """
    checkpoint, dest = checkpoint.rstrip("/"), dest.rstrip("/")
    if max_bytes_per_trigger and max_batches:
        max_bytes_per_trigger = batch_bytes(spark, source, layout, max_bytes_per_trigger, max_batches)
    parsed = parse_documents(documents(landing_stream(
        spark, source, layout, max_bytes_per_trigger, max_files_per_trigger, source_options)),
        schema, "PERMISSIVE", json_options)
    log_schema(spark, dest, "stream", output_struct(schema))
    if quarantine:
        if path_exists(spark, f"{dest}/_spark_metadata"):
            raise ValueError(f"{dest} was written by a stream without quarantine, whose log would hide other files")
        writer = parsed.writeStream.foreachBatch(
            lambda batch, batch_id: publish_batch(batch, batch_id, dest, quarantine.rstrip("/"))) \
            .option("checkpointLocation", f"{checkpoint}/batches")
    else:
        writer = (good_records(parsed).writeStream.format("parquet").partitionBy(*PARTITION_COLUMNS)
                  .option("path", dest).option("checkpointLocation", f"{checkpoint}/published"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime="1 minute"))
    return [writer.start()]


def batch_bytes(spark: SparkSession, source: str, layout: str, least: int, batches: int) -> int:
    """Bytes of a micro-batch, ``least`` or more, of which ``batches`` hold everything landed. Batches are filled with whole
    files, so there are a few more of them, twice as many at most."""
    landed = total_bytes(list_files(spark, source, "all", layout)).first()["total_bytes"]
    return max(int(least), -(-landed // int(batches)))


def publish_batch(batch: DataFrame, batch_id: int, dest: str, quarantine: str) -> None:
    """Write a micro-batch's good documents under ``dest`` and its bad ones under ``quarantine``.

    The batch is parsed once: the parsed rows are kept on the executors' disks while both outputs are
    written (what an executor loses is parsed again), and a batch is bounded by the stream's cap. Each output has its
    folders per batch and replaces them, so a batch that is run again after a failure leaves one copy.
    """
    parsed = batch.withColumn(BATCH, F.lit(batch_id)).persist(StorageLevel.DISK_ONLY)
    try:
        outputs = ((good_records(parsed), dest, [*PARTITION_COLUMNS, BATCH]),
                   (bad_records(parsed).withColumn(BATCH, F.lit(batch_id)), quarantine, [BATCH]))
        for frame, path, keys in outputs:
            (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", "snappy").partitionBy(*keys).parquet(path))
    finally:
        parsed.unpersist()

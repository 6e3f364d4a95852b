"""The hourly ingest job: landing JSON -> published Parquet hours."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.hours import PARTITION_COLUMNS, HourRange, HourSpec, hour_columns_from_ts, hour_predicate
from hourlake.operators.files import bytes_per_hour, hour_signatures, signature
from hourlake.operators.ledger import append_ledger, read_ledger, run_entries, unchanged_hours
from hourlake.operators.parse import (
    CORRUPT, MODES, bad_records, good_records, infer_schema, output_struct, parse_documents,
)
from hourlake.plans.publish import layout_for_write, pack_by_bytes, write_hours
from hourlake.sources.inventory import list_files, same_files
from hourlake.sources.landing import SOURCE_FILE, documents, path_exists, read_documents, read_lines
from hourlake.sources.published import (
    add_hours, clear_hours, register_table, rows_per_file, run_folder, swap_hours, table_schema,
)
from hourlake.sources.schema_log import log_schema, logged_schema


@dataclass
class IngestReport:
    """What a run did. ``status``: ``running``, ``failed``, ``succeeded``, or ``incomplete`` if some
    hours landed nothing but bad documents (``all_bad_hours``) and so keep what
    an earlier run published, or if bad documents were left out with nowhere to go (PERMISSIVE without a quarantine)."""

    run_id: str
    source: str
    dest: str
    hours: HourRange
    schema: T.StructType | None
    documents: int = 0
    published: int = 0
    quarantined: int = 0
    status: str = "running"
    all_bad_hours: list[tuple[str, str, str, str]] = field(default_factory=list)
    start_time: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    end_time: datetime | None = None


def parse_landing(docs: DataFrame, schema: T.StructType | str | None = None, mode: str = "PERMISSIVE",
                  json_options: dict | None = None, sampling_ratio: float = 1.0, clash_suffix: str | None = None,
                  known: T.StructType | None = None) -> tuple[DataFrame, T.StructType | None]:
    """Documents parsed with ``schema``, and the published fields. Without a schema it is
    inferred over the same documents; fields that ``known`` has keep the types they have there."""
    if schema is None:
        schema = infer_schema(docs, sampling_ratio, json_options)
        if known is not None:
            types = {f.name: f.dataType for f in known.fields}
            names = output_struct(schema, clash_suffix).names
            fields = [T.StructField(f.name, types.get(n, f.dataType)) for f, n in zip(schema.fields, names)]
            gone = [f for f in known.fields if f.name not in names]
            schema = T.StructType(fields + gone)
        if not schema.fields:
            return docs, None
    return parse_documents(docs, schema, mode, json_options, clash_suffix), output_struct(schema, clash_suffix)


def parsed_landing(spark: SparkSession, source: str, hours: HourSpec = "all",
                   schema: T.StructType | str | None = None, layout: str = "plain",
                   mode: str = "PERMISSIVE", json_options: dict | None = None,
                   sampling_ratio: float = 1.0, file_glob: str | None = None,
                   clash_suffix: str | None = None) -> tuple[DataFrame, T.StructType | None]:
    """Landing documents of ``hours`` parsed with ``schema`` (inferred over
    the same documents when not given). Lazy: nothing is read yet unless the
    schema has to be inferred."""
    docs = read_documents(spark, source, hours, layout, file_glob)
    return parse_landing(docs, schema, mode, json_options, sampling_ratio, clash_suffix)


def one_listing(spark: SparkSession, source: str, hours: HourRange, layout: str,
                file_glob: str | None, tries: int = 5) -> tuple[DataFrame, DataFrame]:
    """The inventory and the lines of the same files: both list the landing when they are made,
    and are made again if a file came or went in between."""
    for _ in range(tries):
        inventory = list_files(spark, source, hours, layout, file_glob)
        lines = read_lines(spark, source, hours, layout, file_glob)
        if same_files(inventory, lines):
            return inventory, lines
    raise RuntimeError(f"the files of {source} change faster than they can be listed")


def ingest(spark: SparkSession, source: str, dest: str, hours: HourSpec = None,
           schema: T.StructType | str | None = None, layout: str = "plain",
           mode: str = "PERMISSIVE", quarantine: str | None = None, ledger: str | None = None,
           strategy: str = "direct", files_per_hour: int | None = None,
           row_group_bytes: int | None = None, max_records_per_file: int | None = None,
           json_options: dict | None = None, sampling_ratio: float = 1.0,
           file_glob: str | None = None, table: str | None = None,
           clear_empty_hours: bool = False, clear_all: bool = False,
           clash_suffix: str | None = None, target_file_bytes: int | None = None, swap: bool = False) -> IngestReport:
    """Publish the landing hours ``hours`` of ``source`` into ``dest``.

    ``hours`` is one hour ('YYYY-MM-DD HH'), an inclusive (start, end) pair,
    'all', None for the current UTC hour, or 'changed': every landed hour whose files
    (names, lengths, modification times) are not those that its latest run in ``ledger`` took
    and published with success. Every hour with a good document
    is replaced as a whole in one write; hours without files keep what
    an earlier run published, and so do hours whose documents are all bad: they
    are listed in ``all_bad_hours`` and the run ends as ``incomplete``. Bad documents
    are left out of ``dest`` and counted (PERMISSIVE, DROPMALFORMED) or fail the run
    before anything is replaced (FAILFAST); with ``quarantine`` set, a PERMISSIVE
    run that met bad documents writes them, with their file and hour, to that
    table under ``run_id=<run>``. A missing ``source`` raises FileNotFoundError.

    ``ledger`` gets a row per hour when the run starts and one when it ends, with
    the files and bytes of exactly the listing that is read.

    With ``table`` the published hours are registered in the catalog (see
    :func:`register_table`), and the columns of a table that exists already keep their
    types when no ``schema`` is given; documents that do not fit them are bad. With
    ``clear_empty_hours`` too, hours of a closed range that have no landing file lose
    what an earlier run published there (the original job kept it; this is
    the explicit opt-in). A run that finds no file at all clears nothing unless
    ``clear_all`` says so.

    ``clash_suffix`` is put behind the names of fields called like an hour key.
    ``target_file_bytes`` cuts the output by landed bytes (:func:`pack_by_bytes`). With ``swap`` (and ``table``) the
    hours are written to a folder of the run and the table's partitions are pointed at it afterwards
    (:func:`swap_hours`), so that readers of the table see each hour change at once; the table then is the
    way to read the lake, and :func:`drop_old_runs` clears what no hour points at any more. Without a
    ``schema`` the columns that the lake's schema log has keep their types, as those of an existing table do.
    """
    if swap and table is None:
        raise ValueError("swap needs a table")
    if hours == "changed":
        if not ledger:
            raise ValueError("hours='changed' needs a ledger")
        some = changed_hours(spark, source, dest, layout, file_glob, ledger)
        if not some:
            now = datetime.now(timezone.utc)
            return IngestReport(uuid.uuid4().hex, source, dest, HourRange(only=()), None, status="succeeded", end_time=now)
        hours = HourRange.of(some)
    hr = HourRange.parse(hours)
    if clear_empty_hours and (table is None or hr.everything):
        raise ValueError("clear_empty_hours needs a table and a closed hour range")
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    report = IngestReport(uuid.uuid4().hex, source, dest, hr, None)
    inventory, lines = one_listing(spark, source, hr, layout, file_glob)
    if ledger:
        record_run(spark, report, inventory, ledger)
    hour_rows = hour_bad = None
    try:
        existing = table is not None and spark.catalog.tableExists(table)
        parsed, struct = parse_landing(documents(lines), schema, "FAILFAST" if mode == "FAILFAST" else "PERMISSIVE",
                                       json_options, sampling_ratio, clash_suffix,
                                       table_schema(spark, table) if existing else logged_schema(spark, dest))
        report.schema = struct
        if struct is not None:
            # Counted after the layout shuffle (if any), in the write's own
            # result stage: Spark applies a result task's metrics once, so
            # retried or speculative tasks do not inflate the counts. Bad
            # rows ride through the shuffle and are dropped after counting.
            obs = Observation(f"ingest_{report.run_id}")
            hour = F.concat(*[F.col(c) for c in PARTITION_COLUMNS])
            bad_hour = F.when(F.col(CORRUPT).isNotNull(), hour)
            if target_file_bytes:
                arranged = pack_by_bytes(parsed.drop(SOURCE_FILE), bytes_per_hour(inventory), target_file_bytes)
            else:
                tasks = files_per_hour * count_hours(hr, inventory) if files_per_hour else None
                arranged = layout_for_write(parsed.drop(SOURCE_FILE), strategy, files_per_hour, tasks=tasks)
            observed = arranged.observe(obs, F.count(F.lit(1)).alias("documents"),
                                        F.count(F.col(CORRUPT)).alias("bad"),
                                        F.min(bad_hour).alias("first"), F.max(bad_hour).alias("last"),
                                        F.min(F.when(F.col(CORRUPT).isNull(), hour)).alias("good"))
            log_schema(spark, dest, report.run_id, struct)
            folder = run_folder(dest, report.run_id) if swap else dest
            write_hours(good_records(observed), folder, strategy, files_per_hour,
                        row_group_bytes, max_records_per_file, arrange=False)
            counts = obs.get
            report.documents = int(counts.get("documents") or 0)
            report.quarantined = int(counts.get("bad") or 0)
            report.published = report.documents - report.quarantined
            if report.published and (ledger or swap or report.quarantined):
                # Exactly what the write committed, retries and all: the footers of its files, read once (a row per hour).
                hour_rows = written_rows(spark, folder, hr, counts["good"]).persist()
            if report.quarantined:
                # A second pass only when the first one met bad documents, and only
                # over the hours between the first and the last that holds one.
                some = HourRange.parse(tuple(datetime.strptime(counts[k], "%Y%m%d%H") for k in ("first", "last")))
                again, _ = parsed_landing(spark, source, some, struct_of(struct, clash_suffix), layout, "PERMISSIVE",
                                          json_options, 1.0, file_glob, clash_suffix)
                if quarantine and mode == "PERMISSIVE":
                    # One folder per run, hour keys as columns: a few files per run
                    # rather than one per hour, and a re-run never mixes with or
                    # hides an earlier run's bad documents.
                    aside = f"{quarantine.rstrip('/')}/run_id={report.run_id}"
                    bad_records(again).write.mode("overwrite").parquet(aside)
                    bad = spark.read.schema(", ".join(f"{c} string" for c in PARTITION_COLUMNS)).parquet(aside)
                else:
                    bad = bad_records(again)
                # That pass is the only other parse: bad documents are counted where it wrote them, or kept as a row per
                # hour, and an hour is hopeless if it has some and the first pass wrote none of its rows.
                hour_bad = bad.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("hour_bad")).persist()
                hopeless = hour_bad if hour_rows is None else hour_bad.join(hour_rows, list(PARTITION_COLUMNS), "left_anti")
                report.all_bad_hours = sorted(tuple(r) for r in hopeless.select(*PARTITION_COLUMNS).collect())
        if swap and struct is not None:
            register_table(spark, table, dest, struct, recover=False)
            if hour_rows is not None:
                swap_hours(spark, table, folder, [tuple(r) for r in hour_rows.select(*PARTITION_COLUMNS).collect()])
        elif table and (struct is not None or existing):
            if hr.everything or not existing:
                register_table(spark, table, dest, struct)  # scans every hour folder
            else:
                register_table(spark, table, dest, struct, recover=False)
                hopeless = set(report.all_bad_hours)
                add_hours(spark, table, [h for h in landed_hours(inventory) if h not in hopeless])
        if clear_empty_hours and (struct is not None or existing) and (clear_all or inventory.limit(1).count()):
            clear_hours(spark, table, empty_published_hours(spark, report, inventory, table))
        lost = report.quarantined and not quarantine and mode == "PERMISSIVE"
        report.status = "incomplete" if report.all_bad_hours or lost else "succeeded"
    except Exception:
        report.status = "failed"
        raise
    finally:
        report.end_time = datetime.now(timezone.utc)
        if ledger:
            record_run(spark, report, inventory, ledger, hour_rows, hour_bad)
        for kept in (hour_rows, hour_bad):
            if kept is not None:
                kept.unpersist()
    return report


def written_rows(spark: SparkSession, folder: str, hours: HourRange, first: str) -> DataFrame:
    """Hour keys and ``hour_rows`` of the hours that the last write into ``folder`` replaced, ``first`` ('YYYYMMDDHH') being one of them.

    All files of one write carry its id in their names, and a replaced hour has only those; hours that kept what
    an earlier run wrote have others."""
    job = F.regexp_extract("file", "^part-[0-9]+-(.*?)[.-]c[0-9]+", 1)
    files = rows_per_file(spark, folder, hours).withColumn("job", job)
    mine = files.where(F.concat(*[F.col(c) for c in PARTITION_COLUMNS]) == first).select("job").first()[0]
    return files.where(F.col("job") == mine).groupBy(*PARTITION_COLUMNS).agg(F.sum("rows").alias("hour_rows"))


def changed_hours(spark: SparkSession, source: str, dest: str, layout: str, file_glob: str | None, ledger: str) -> list[datetime]:
    """Landed hours whose signature is not the one of their latest successful run. Only their names come to the driver."""
    now = hour_signatures(list_files(spark, source, "all", layout, file_glob))
    if path_exists(spark, ledger):
        done = unchanged_hours(read_ledger(spark, ledger), source, dest)
        now = now.join(done, [*PARTITION_COLUMNS, "signature"], "left_anti")
    return [datetime(*(int(v) for v in r)) for r in now.select(*PARTITION_COLUMNS).collect()]


def struct_of(published: T.StructType, clash_suffix: str | None) -> T.StructType:
    """The record fields behind published ones: their names without the suffix for clashes."""
    if not clash_suffix:
        return published
    clash = {c + clash_suffix: c for c in PARTITION_COLUMNS}
    return T.StructType([T.StructField(clash.get(f.name, f.name), f.dataType) for f in published.fields])


def count_hours(hours: HourRange, inventory: DataFrame) -> int:
    """Hours that a run may write."""
    return inventory.select(*PARTITION_COLUMNS).distinct().count() if hours.everything else len(hours)


def landed_hours(inventory: DataFrame) -> list[tuple[str, str, str, str]]:
    """Hours of a closed range that have landing files (bounded by the range)."""
    return [tuple(r) for r in inventory.where("length > 0").select(*PARTITION_COLUMNS).distinct().collect()]


def empty_published_hours(spark: SparkSession, report: IngestReport, inventory: DataFrame,
                          table: str) -> list[tuple[str, str, str, str]]:
    """Hours of the run's range with no landing file but with published data.
    Bounded by the number of hours in the range, so it is brought to the
    driver to drive one delete per hour (whole days and months collapse)."""
    keys = list(PARTITION_COLUMNS)
    landed = inventory.select(*keys)
    published = spark.table(table).where(hour_predicate(report.hours)).select(*keys).distinct()
    empty = (requested_hours(spark, report.hours).join(landed, keys, "left_anti")
             .join(published, keys, "left_semi"))
    return [tuple(r) for r in empty.collect()]


def requested_hours(spark: SparkSession, hours: HourRange) -> DataFrame:
    """One row per hour of a closed range, generated on the executors."""
    if hours.only is not None:
        names = [tuple(h.strftime(f) for f in ("%Y", "%m", "%d", "%H")) for h in hours.only]
        return spark.createDataFrame(names, ", ".join(f"{c} string" for c in PARTITION_COLUMNS))
    start = F.lit(hours.start.strftime("%Y-%m-%d %H:00:00")).cast("timestamp_ntz")
    ts = start + F.make_dt_interval(hours=F.col("id").cast("int"))
    return spark.range(len(hours)).select(*hour_columns_from_ts(ts))


def record_run(spark: SparkSession, report: IngestReport, inventory: DataFrame, ledger: str,
               hour_rows: DataFrame | None = None, hour_bad: DataFrame | None = None) -> None:
    """Append one ledger row per hour of the run: every requested hour for
    a closed range (0 files where nothing landed, so a run over an empty hour
    is still recorded), every landed hour for an open one. Bytes count as processed
    once the run has ended; hours of bad documents only have the status ``all_bad``. ``hour_rows`` are the rows
    that the run published in the hour, ``hour_bad`` its bad documents; both are null before it has ended."""
    per_hour = bytes_per_hour(inventory, signature())
    zero = F.lit(0).cast("bigint")
    if not report.hours.everything:
        per_hour = requested_hours(spark, report.hours).join(
            per_hour, on=list(PARTITION_COLUMNS), how="left").select(
            *PARTITION_COLUMNS, F.coalesce("files", zero).alias("files"),
            F.coalesce("total_bytes", zero).alias("total_bytes"), "signature")
    ended = report.status in ("succeeded", "incomplete")
    for name, counts in (("hour_rows", hour_rows), ("hour_bad", hour_bad)):
        if counts is not None:
            per_hour = per_hour.join(counts, list(PARTITION_COLUMNS), "left")
        else:
            per_hour = per_hour.withColumn(name, F.lit(None).cast("bigint"))
        if ended:
            per_hour = per_hour.withColumn(name, F.coalesce(name, zero))
    per_hour = per_hour.withColumn("bytes_processed", F.col("total_bytes") if ended else zero)
    status = F.lit("succeeded" if ended else report.status)
    if report.all_bad_hours:
        bad = spark.createDataFrame(report.all_bad_hours, ", ".join(f"{c} string" for c in PARTITION_COLUMNS))
        per_hour = per_hour.join(bad.withColumn("_bad", F.lit(True)), list(PARTITION_COLUMNS), "left")
        status = F.when(F.col("_bad"), "all_bad").otherwise(status)
    per_hour = per_hour.withColumn("status", status)
    run = {
        "run_id": report.run_id, "source": report.source, "dest": report.dest,
        "run_documents": report.documents, "run_published": report.published,
        "run_quarantined": report.quarantined,
        "start_time": report.start_time.replace(tzinfo=None),
        "end_time": report.end_time.replace(tzinfo=None) if report.end_time else None,
    }
    append_ledger(run_entries(per_hour, run), ledger)

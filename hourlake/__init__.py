"""hourlake: hourly JSON landing folders -> a partitioned Parquet lake, on Spark."""

from hourlake.functions.hours import PARTITION_COLUMNS, HourRange, hour_glob
from hourlake.operators.files import bytes_per_hour, new_files
from hourlake.operators.ledger import latest_per_key, latest_runs, read_ledger
from hourlake.operators.parse import infer_schema, parse_documents
from hourlake.operators.reconcile import reconcile
from hourlake.operators.schema import align_by_name
from hourlake.plans.ingest import IngestReport, ingest, parsed_landing
from hourlake.plans.publish import write_hours
from hourlake.session import build_session, scratch_dir
from hourlake.sources.inventory import list_files, list_published_files, modified_since
from hourlake.sources.json_writer import write_landing
from hourlake.sources.landing import read_documents, read_lines
from hourlake.sources.published import add_hours, clear_hours, read_published, register_table
from hourlake.streaming.file_stream import ingest_stream

__all__ = [
    "PARTITION_COLUMNS", "HourRange", "hour_glob", "bytes_per_hour", "new_files",
    "latest_per_key", "latest_runs", "read_ledger", "infer_schema", "parse_documents",
    "reconcile", "align_by_name", "IngestReport", "ingest", "parsed_landing", "write_hours",
    "build_session", "scratch_dir", "list_files", "list_published_files", "modified_since",
    "write_landing", "read_documents", "read_lines", "read_published", "ingest_stream",
    "register_table", "add_hours", "clear_hours",
]

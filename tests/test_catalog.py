"""Registered queries against their DuckDB oracle at sf0.001, and the CLI."""

import json
import os

import duckdb
import pytest

from conftest import SF, write_plain
from __spark_entry__ import entry, oracle_sql, queries
from hourlake.catalog import ORACLE_SQL, QUERIES
from hourlake.plans import cli
from hourlake.sources.published import read_published

CHECKED = ["events_hour_ingest", "text_with_braces_roundtrip", "nested_struct_roundtrip",
           "type_widening_drift", "quarantine_records", "ledger_latest_run", "new_and_removed_files",
           "separated_documents", "array_line_decimal", "dotted_and_empty_keys", "clashing_field_names",
           "nested_folder_scan", "plain_layout_ingest", "all_bad_hour_rerun", "ledger_bytes_exact", "table_gains_column",
           "drift_between_runs", "stream_late_old_file"]


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(tuple(repr(norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "documents", "conversations", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    got = df.collect()
    res = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(got, df.columns) == _canon(res.fetchall(), cols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[-4:] == ["year", "month", "day", "hour"]
    assert df.count() == 1000


def test_cli(spark, workdir, capsys):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    write_plain(src, "2018-04-06 16", "p.json", ['{"id":1}{"id":2}', "bad"])
    assert cli.main(["--source", src, "--dest", dest, "--date", "2018-04-06 16",
                     "--schema", "id bigint", "--quarantine", os.path.join(workdir, "q")]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (out["status"], out["published"], out["quarantined"]) == ("succeeded", 2, 1)
    assert sorted(r.id for r in read_published(spark, dest).collect()) == [1, 2]

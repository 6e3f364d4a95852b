import os
import random

import pytest
from pyspark.errors import PySparkException

from conftest import plan_text, write_plain
from hourlake.plans.ingest import ingest
from hourlake.sources.inventory import list_published_files
from hourlake.sources.published import read_published

SCHEMA = "id bigint, v string"


def _land(root, hour, ids, tag="a", name="p.json"):
    write_plain(root, hour, name, [f'{{"id":{i},"v":"{tag}"}}' for i in ids])


def _rows(spark, dest):
    return sorted((r.id, r.v, r.hour) for r in read_published(spark, dest).collect())


def test_rerun_replaces_only_its_hours(spark, workdir):
    src, src2, dest = (os.path.join(workdir, n) for n in ("l1", "l2", "lake"))
    _land(src, "2024-01-01 00", [1, 2])
    _land(src, "2024-01-01 01", [3])
    ingest(spark, src, dest, ("2024-01-01 00", "2024-01-01 01"), schema=SCHEMA)
    ingest(spark, src, dest, ("2024-01-01 00", "2024-01-01 01"), schema=SCHEMA)  # idempotent
    assert _rows(spark, dest) == [(1, "a", "00"), (2, "a", "00"), (3, "a", "01")]
    _land(src2, "2024-01-01 01", [4], tag="b")
    ingest(spark, src2, dest, "2024-01-01 01", schema=SCHEMA)
    assert _rows(spark, dest) == [(1, "a", "00"), (2, "a", "00"), (4, "b", "01")]


def test_hour_without_files_keeps_what_was_published(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    _land(src, "2024-01-01 00", [1])
    ingest(spark, src, dest, "2024-01-01 00", schema=SCHEMA)
    os.remove(os.path.join(src, "2024/01/01/00/p.json"))
    report = ingest(spark, src, dest, "2024-01-01 00", schema=SCHEMA)
    assert report.status == "succeeded" and report.documents == 0
    assert _rows(spark, dest) == [(1, "a", "00")]


def test_failed_run_leaves_old_hours(spark, workdir):
    src, bad, dest = (os.path.join(workdir, n) for n in ("l", "bad", "lake"))
    _land(src, "2024-01-01 00", [1])
    _land(src, "2024-01-01 01", [2])
    ingest(spark, src, dest, "all", schema=SCHEMA)
    _land(bad, "2024-01-01 00", [5], tag="new")
    write_plain(bad, "2024-01-01 01", "broken.json", ['{"id":6,"v":"x"', '{"id":7}'])
    with pytest.raises(PySparkException):
        ingest(spark, bad, dest, "all", schema=SCHEMA, mode="FAILFAST")
    assert _rows(spark, dest) == [(1, "a", "00"), (2, "a", "01")]
    assert not [d for d in os.listdir(dest) if d.startswith(".spark-staging")]


@pytest.mark.parametrize("strategy,files", [("direct", None), ("rebalance", None), ("direct", 2)])
def test_quarantine_and_counts(spark, workdir, strategy, files):
    src, dest, q = (os.path.join(workdir, n) for n in ("l", "lake", "q"))
    write_plain(src, "2024-01-01 00", "p.json", ['{"id":1,"v":"a"}{"id":2,"v":', '{"id":"x"}', '{"id":3}'])
    report = ingest(spark, src, dest, "all", schema=SCHEMA, quarantine=q, strategy=strategy,
                    files_per_hour=files)
    assert (report.documents, report.published, report.quarantined) == (4, 2, 2)
    bad = spark.read.parquet(q)
    assert sorted(r._corrupt_record for r in bad.collect()) == ['{"id":"x"}', '{"id":2,"v":']
    assert bad.first()._source_file.endswith("/2024/01/01/00/p.json")


@pytest.mark.parametrize("strategy", ["direct", "rebalance"])
def test_strategies_publish_the_same_rows(spark, workdir, strategy):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    for f in range(3):
        _land(src, "2024-01-01 00", range(f * 10, f * 10 + 10), name=f"p{f}.json")
    _land(src, "2024-01-01 01", [100])
    ingest(spark, src, dest, "all", schema=SCHEMA, strategy=strategy)
    assert len(_rows(spark, dest)) == 31


def test_files_per_hour_bounds_files(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    for f in range(6):
        _land(src, "2024-01-01 00", range(f * 50, f * 50 + 50), name=f"p{f}.json")
    ingest(spark, src, dest, "all", schema=SCHEMA, files_per_hour=2)
    files = list_published_files(spark, dest).collect()
    assert 1 <= len(files) <= 2
    assert len(_rows(spark, dest)) == 300


def test_row_group_size_option(spark, workdir):
    import pyarrow.parquet as pq

    src = os.path.join(workdir, "l")
    rng = random.Random(1)
    write_plain(src, "2024-01-01 00", "p.json",
                [f'{{"id":{i},"v":"{rng.getrandbits(8000):x}"}}' for i in range(3000)])
    groups = {}
    for size in (512 * 1024, 2 * 1024 * 1024):
        dest = os.path.join(workdir, f"lake{size}")
        ingest(spark, src, dest, "all", schema=SCHEMA, row_group_bytes=size, files_per_hour=1)
        files = [pq.ParquetFile(r.path.replace("file:", "")).metadata for r in list_published_files(spark, dest).collect()]
        assert sum(m.num_rows for m in files) == 3000
        groups[size] = sum(m.num_row_groups for m in files)
    assert groups[512 * 1024] > 1.5 * groups[2 * 1024 * 1024] > 1


def test_missing_root_clears_nothing(spark, workdir):
    src, dest, empty = (os.path.join(workdir, n) for n in ("l", "lake", "empty"))
    _land(src, "2024-01-01 00", [1])
    name = "missing_" + os.path.basename(workdir).replace("-", "_")
    day = ("2024-01-01", "2024-01-01")
    ingest(spark, src, dest, day, schema=SCHEMA, table=name)
    with pytest.raises(FileNotFoundError):
        ingest(spark, src + "x", dest, day, schema=SCHEMA, table=name, clear_empty_hours=True)
    os.makedirs(empty)
    ingest(spark, empty, dest, day, schema=SCHEMA, table=name, clear_empty_hours=True)
    assert _rows(spark, dest) == [(1, "a", "00")]
    ingest(spark, empty, dest, day, schema=SCHEMA, table=name, clear_empty_hours=True, clear_all=True)
    assert spark.table(name).count() == 0


def test_hour_with_a_0_byte_file_is_not_cleared(spark, workdir):
    src, src2, dest = (os.path.join(workdir, n) for n in ("l", "l2", "lake"))
    for hour in ("2024-01-01 00", "2024-01-01 01", "2024-01-01 02"):
        _land(src, hour, [1])
    name = "zero_" + os.path.basename(workdir).replace("-", "_")
    ingest(spark, src, dest, "2024-01-01", schema=SCHEMA, table=name)
    _land(src2, "2024-01-01 01", [9])
    write_plain(src2, "2024-01-01 02", "empty.json", [])
    ingest(spark, src2, dest, "2024-01-01", schema=SCHEMA, table=name, clear_empty_hours=True)
    assert _rows(spark, dest) == [(1, "a", "02"), (9, "a", "01")]


def test_hours_of_bad_documents_are_told(spark, workdir):
    src, src2, dest, ledger = (os.path.join(workdir, n) for n in ("l", "l2", "lake", "ledger"))
    for hour in ("2024-01-01 00", "2024-01-01 01"):
        _land(src, hour, [1])
    ingest(spark, src, dest, "2024-01-01", schema=SCHEMA)
    write_plain(src2, "2024-01-01 00", "p.json", ['{"id":', "nothing"])
    write_plain(src2, "2024-01-01 01", "p.json", ['{"id":2,"v":"b"}', "bad"])
    report = ingest(spark, src2, dest, "2024-01-01", schema=SCHEMA, ledger=ledger)
    assert (report.status, report.all_bad_hours, report.documents, report.quarantined) == (
        "incomplete", [("2024", "01", "01", "00")], 4, 3)
    assert _rows(spark, dest) == [(1, "a", "00"), (2, "b", "01")]
    from hourlake.operators.ledger import read_ledger
    ended = {r.hour: r.status for r in read_ledger(spark, ledger).collect() if r.end_time}
    assert (ended["00"], ended["01"], ended["02"]) == ("all_bad", "succeeded", "succeeded")


def test_table_follows_the_schema(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    name = "follow_" + os.path.basename(workdir).replace("-", "_")
    write_plain(src, "2024-01-01 00", "p.json", ['{"id":"x","m":{"user-id":1}}'])
    write_plain(src, "2024-01-01 01", "p.json", ['{"id":2,"new":{"a b":1.5}}'])
    write_plain(src, "2024-01-01 02", "p.json", ['{"id":"3","m":{"user-id":"text"}}', '{"id":"4"}'])
    ingest(spark, src, dest, "2024-01-01 00", table=name)
    ingest(spark, src, dest, "2024-01-01 01", table=name)
    assert [(r.id, r.hour) for r in spark.table(name).orderBy("id").collect()] == [("2", "01"), ("x", "00")]
    assert spark.table(name).where("hour = '01'").first()["new"]["a b"] == 1.5
    # A document that does not fit the table's types is bad, and counted.
    report = ingest(spark, src, dest, "2024-01-01 02", table=name)
    assert (report.published, report.quarantined) == (1, 1)
    assert spark.table(name).count() == 3


def test_map_columns_with_files_per_hour(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    write_plain(src, "2024-01-01 00", "p.json", [f'{{"a.b":{{"k":{i}}}}}' for i in range(10)])
    ingest(spark, src, dest, "all", schema="`a.b` map<string,bigint>", files_per_hour=2)
    assert sorted(r["a.b"]["k"] for r in read_published(spark, dest).collect()) == list(range(10))


def test_pruned_read_plan(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    _land(src, "2024-01-01 00", [1])
    _land(src, "2024-01-02 00", [2])
    ingest(spark, src, dest, "all", schema=SCHEMA)
    df = read_published(spark, dest, ("2024-01-02 00", "2024-01-02 23"))
    plan = plan_text(df, "simple")
    assert "PartitionFilters" in plan and [r.id for r in df.collect()] == [2]
    one = read_published(spark, dest, "2024-01-01 00")
    assert [r.id for r in one.collect()] == [1]
    # Only the hour's own folder is listed.
    assert len(one.inputFiles()) == 1 and "2024-01-01 00" and "/day=01/" in one.inputFiles()[0]
    assert read_published(spark, dest, "2030-01-01").count() == 0


def test_catalog_table_prunes_hours(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    _land(src, "2024-01-01 00", [1])
    _land(src, "2024-01-02 05", [2])
    ingest(spark, src, dest, "all", schema=SCHEMA)
    from hourlake.sources.published import register_table
    name = "t_" + os.path.basename(workdir).replace("-", "_")
    register_table(spark, name, dest)
    df = spark.sql(f"SELECT id, hour FROM {name} WHERE day = '02'")
    plan = plan_text(df, "simple")
    assert "PartitionFilters: [isnotnull(day" in plan
    assert all("/day=02/" in f for f in df.inputFiles())
    assert [tuple(r) for r in df.collect()] == [(2, "05")]


def test_clear_empty_hours(spark, workdir):
    src, src2, dest = (os.path.join(workdir, n) for n in ("l", "l2", "lake"))
    for hour in ("2024-01-01 00", "2024-01-01 01", "2024-01-02 07"):
        _land(src, hour, [int(hour[-2:]) + 10 * int(hour[8:10])])
    name = "clear_" + os.path.basename(workdir).replace("-", "_")
    ingest(spark, src, dest, "all", schema=SCHEMA, table=name)
    _land(src2, "2024-01-01 01", [99], tag="b")
    ingest(spark, src2, dest, ("2024-01-01 00", "2024-01-02 23"), schema=SCHEMA, table=name,
           clear_empty_hours=True)
    assert _rows(spark, dest) == [(99, "b", "01")]
    assert [tuple(r) for r in spark.sql(f"SELECT id, hour FROM {name}").collect()] == [(99, "01")]
    with pytest.raises(ValueError):
        ingest(spark, src2, dest, "all", schema=SCHEMA, clear_empty_hours=True)


def test_collapse_whole_days_and_months():
    from hourlake.sources.published import _collapse
    hours = [("2024", "02", f"{d:02d}", f"{h:02d}") for d in range(1, 30) for h in range(24)]
    assert _collapse(hours) == [("2024", "02")]
    hours = [("2024", "01", "05", f"{h:02d}") for h in range(24)] + [("2024", "01", "06", "03")]
    assert _collapse(hours) == [("2024", "01", "05"), ("2024", "01", "06", "03")]


def test_table_registration_is_incremental(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    _land(src, "2024-01-01 00", [1])
    _land(src, "2024-01-01 01", [2])
    ingest(spark, src, dest, "2024-01-01 00", schema=SCHEMA)  # published before the table exists
    name = "inc_" + os.path.basename(workdir).replace("-", "_")
    ingest(spark, src, dest, "2024-01-01 01", schema=SCHEMA, table=name)  # creates it: full recovery
    _land(src, "2024-01-01 02", [3])
    ingest(spark, src, dest, "2024-01-01 02", schema=SCHEMA, table=name)  # adds one partition
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert [p[-2:] for p in parts] == ["00", "01", "02"]
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3]


def test_dropmalformed_counts_but_keeps_no_quarantine(spark, workdir):
    src, dest, q = (os.path.join(workdir, n) for n in ("l", "lake", "q"))
    write_plain(src, "2024-01-01 00", "p.json", ['{"id":1,"v":"a"}', '{"id":', '{"id":2}'])
    report = ingest(spark, src, dest, "all", schema=SCHEMA, mode="dropmalformed", quarantine=q)
    assert (report.documents, report.published, report.quarantined) == (3, 2, 1)
    assert not os.path.exists(q)
    assert [r[0] for r in _rows(spark, dest)] == [1, 2]
    with pytest.raises(ValueError):
        ingest(spark, src, dest, "all", schema=SCHEMA, mode="lenient")

"""What a lake keeps of its runs: columns, run folders, signatures, rows per hour."""

import os
from datetime import datetime, timedelta, timezone

import pytest

from conftest import plan_text, write_plain
from hourlake.functions.hours import HourRange, hour_glob
from hourlake.operators.files import new_files
from hourlake.operators.ledger import latest_runs, read_ledger
from hourlake.plans.ingest import ingest
from hourlake.sources.inventory import list_files, list_published_files
from hourlake.sources.landing import read_lines
from hourlake.sources.published import drop_old_runs, read_published
from hourlake.sources.schema_log import logged_schema, schema_log_path
from hourlake.streaming.file_stream import ingest_stream, publish_batch

SCHEMA = "id bigint, v string"
DAY = "2024-01-01"


def _paths(workdir, *names):
    return [os.path.join(workdir, n) for n in names]


def test_schema_log_keeps_every_column(spark, workdir):
    src, dest = _paths(workdir, "l", "lake")
    write_plain(src, f"{DAY} 00", "p.json", ['{"a":1}'])
    write_plain(src, f"{DAY} 01", "p.json", ['{"a":2,"b":"x"}'])
    write_plain(src, f"{DAY} 02", "p.json", ['{"a":"text"}', '{"a":3}'])
    for hour in ("00", "01"):
        ingest(spark, src, dest, f"{DAY} {hour}")
    one = read_published(spark, dest, f"{DAY} 00")
    assert one.columns[:2] == ["a", "b"] and [tuple(r)[:2] for r in one.collect()] == [(1, None)]
    assert len(one.inputFiles()) == 1
    assert sorted(tuple(r)[:2] for r in read_published(spark, dest).collect()) == [(1, None), (2, "x")]
    # Only changes of the schema are logged, and a column keeps its type without a table too.
    files = len([f for f in os.listdir(schema_log_path(dest)) if f.endswith(".json")])
    report = ingest(spark, src, dest, f"{DAY} 02")
    assert (report.published, report.quarantined, report.status) == (1, 1, "incomplete")
    assert len([f for f in os.listdir(schema_log_path(dest)) if f.endswith(".json")]) == files == 2
    assert logged_schema(spark, dest).simpleString() == "struct<a:bigint,b:string>"
    assert logged_schema(spark, src) is None


def test_lake_without_a_log_merges_the_footers_of_the_hours_read(spark, workdir):
    src, dest = _paths(workdir, "l", "lake")
    write_plain(src, f"{DAY} 00", "p.json", ['{"id":1}'])
    ingest(spark, src, dest, "all", schema="id bigint")
    (spark.createDataFrame([(2, "x", "2024", "01", "01", "00")], "id bigint, extra string, year string, month string, day string, hour string")
     .write.mode("append").partitionBy("year", "month", "day", "hour").parquet(dest + "2"))
    assert read_published(spark, dest + "2", f"{DAY} 00").columns == ["id", "extra", "year", "month", "day", "hour"]
    assert read_published(spark, dest + "2", "2030-01-01").count() == 0


def test_swap_changes_hours_at_once(spark, workdir):
    src, src2, dest = _paths(workdir, "l", "l2", "lake")
    name = "swap_" + os.path.basename(workdir).replace("-", "_")
    for hour in ("00", "01"):
        write_plain(src, f"{DAY} {hour}", "p.json", ['{"id":1,"v":"old"}'])
        write_plain(src2, f"{DAY} {hour}", "p.json", ['{"id":2,"v":"new"}'])
    with pytest.raises(ValueError):
        ingest(spark, src, dest, DAY, schema=SCHEMA, swap=True)
    ingest(spark, src, dest, DAY, schema=SCHEMA, table=name, swap=True)
    reader = spark.table(name)
    listed = sorted(reader.inputFiles())
    ingest(spark, src2, dest, f"{DAY} 00", schema=SCHEMA, table=name, swap=True)
    rows = lambda: sorted((r.id, r.v, r.hour) for r in spark.table(name).collect())
    assert rows() == [(1, "old", "01"), (2, "new", "00")]
    # A reader that had listed the table still finds every old file.
    assert sorted(r.v for r in spark.read.schema(SCHEMA).parquet(*listed).collect()) == ["old", "old"]
    write_plain(src2, f"{DAY} 01", "broken.json", ['{"id":'])
    with pytest.raises(Exception):
        ingest(spark, src2, dest, f"{DAY} 01", schema=SCHEMA, table=name, swap=True, mode="FAILFAST")
    assert rows() == [(1, "old", "01"), (2, "new", "00")]
    ingest(spark, src2, dest, f"{DAY} 01", schema=SCHEMA, table=name, swap=True)
    soon = datetime.now(timezone.utc) + timedelta(hours=1)
    gone = drop_old_runs(spark, name, dest, soon)
    assert len(gone) >= 1 and rows() == [(2, "new", "00"), (2, "new", "01")]
    assert drop_old_runs(spark, name, dest, soon) == []


def test_changed_hours_only(spark, workdir):
    src, dest, ledger = _paths(workdir, "l", "lake", "ledger")
    for hour in ("00", "05"):
        write_plain(src, f"{DAY} {hour}", "p.json", ['{"id":1,"v":"a"}'])
    with pytest.raises(ValueError):
        ingest(spark, src, dest, "changed", schema=SCHEMA)
    run = lambda **kw: ingest(spark, src, dest, "changed", schema=SCHEMA, ledger=ledger, **kw)
    first = run()
    assert [h.hour for h in first.hours.hours()] == [0, 5] and first.published == 2
    assert run().documents == 0 and run().status == "succeeded"
    write_plain(src, f"{DAY} 05", "q.json", ['{"id":2,"v":"b"}', '{"id":'])
    second = run(quarantine=os.path.join(workdir, "bad"))
    assert [h.hour for h in second.hours.hours()] == [5] and (second.published, second.quarantined) == (2, 1)
    latest = {r.hour: (r.hour_rows, r.hour_bad) for r in latest_runs(read_ledger(spark, ledger)).collect()}
    assert latest == {"00": (1, 0), "05": (2, 1)}
    # A run that failed leaves its hours to be done again.
    write_plain(src, f"{DAY} 07", "p.json", ['{"id":'])
    with pytest.raises(Exception):
        run(mode="FAILFAST")
    assert [h.hour for h in run(quarantine=os.path.join(workdir, "bad")).hours.hours()] == [7]


def test_hours_that_kept_old_rows_count_none(spark, workdir):
    src, src2, dest, ledger = _paths(workdir, "l", "l2", "lake", "ledger")
    for hour in ("00", "01", "02"):
        write_plain(src, f"{DAY} {hour}", "p.json", ['{"id":1,"v":"a"}', '{"id":2,"v":"a"}'])
    ingest(spark, src, dest, DAY, schema=SCHEMA, ledger=ledger)
    write_plain(src2, f"{DAY} 00", "p.json", ['{"id":3,"v":"b"}'])
    write_plain(src2, f"{DAY} 01", "p.json", ["", "  "])
    write_plain(src2, f"{DAY} 02", "p.json", ["bad"])
    ingest(spark, src2, dest, DAY, schema=SCHEMA, ledger=ledger)
    last = {r.hour: (r.hour_rows, r.hour_bad) for r in latest_runs(read_ledger(spark, ledger)).collect() if r.files}
    # Another source path: the first run's hours stay the latest of theirs.
    mine = {r.hour: (r.hour_rows, r.hour_bad) for r in read_ledger(spark, ledger).where("end_time is not null").collect()
            if r.source == src2 and r.files}
    assert mine == {"00": (1, 0), "01": (0, 0), "02": (0, 1)} and last


def test_hour_sets():
    hours = HourRange.of([f"{DAY} 05", f"{DAY} 00", f"{DAY} 05"])
    assert len(hours) == 2 and [h.hour for h in hours.hours()] == [0, 5]
    assert hour_glob("/r", hours) == "/r/2024/01/01/{00,05}"


def test_files_by_bytes(spark, workdir):
    src, dest = _paths(workdir, "l", "lake")
    write_plain(src, f"{DAY} 00", "p.json", ['{"id":1,"v":"same"}'] * 4000)  # equal rows are spread too
    for hour in range(1, 9):
        write_plain(src, f"{DAY} {hour:02d}", "p.json", [f'{{"id":{hour},"v":"cold"}}'])
    ingest(spark, src, dest, "all", schema=SCHEMA, target_file_bytes=20_000)
    per_hour = {}
    for r in list_published_files(spark, dest).collect():
        per_hour[r.hour] = per_hour.get(r.hour, 0) + 1
    assert 4 <= per_hour["00"] <= 6 and all(per_hour[f"{h:02d}"] <= 2 for h in range(1, 9))
    assert read_published(spark, dest).count() == 4008


def test_hour_keys_take_no_pattern_per_row(spark, workdir):
    plain, hive = _paths(workdir, "a b", "c%20d")
    write_plain(plain, f"{DAY} 03", "p+q %.json", ['{"id":1}'])
    spark.createDataFrame([('{"id":1}', "2024", "01", "01", "03")], "value string, year string, month string, day string, hour string") \
        .write.partitionBy("year", "month", "day", "hour").text(hive)
    os.makedirs(os.path.join(hive, "year=2024/month=01/day=01/hour=03/deep"))
    with open(os.path.join(hive, "year=2024/month=01/day=01/hour=03/deep/x.json"), "w", encoding="utf-8") as out:
        out.write('{"id":2}\n')
    for root, layout, n in ((plain, "plain", 1), (hive, "hive", 2)):
        open(os.path.join(plain, "2024/01/01/03/e+ .json"), "w").close()
        for hours in ("all", f"{DAY} 03"):
            lines = read_lines(spark, root, hours, layout)
            assert sorted((r.year, r.month, r.day, r.hour) for r in lines.collect()) == [("2024", "01", "01", "03")] * n
        plan = plan_text(lines)
        assert "regexp" not in plan and "RLIKE" not in plan.replace("PartitionFilters: [RLIKE", "")
    files = list_files(spark, plain, "all")
    assert sorted((os.path.basename(r.path), r.length) for r in files.collect()) == [("e+ .json", 0), ("p+q %.json", 9)]
    # Folders that are not all named alike below the root: no partitioning for Spark, the same rows.
    with open(os.path.join(hive, "stray.json"), "w", encoding="utf-8") as out:
        out.write('{"id":3}\n')
    assert read_lines(spark, hive, "all", "hive").count() == 2


def test_batch_run_twice_leaves_one_copy(spark, workdir):
    src, dest, bad, ck = _paths(workdir, "l", "lake", "bad", "ck")
    write_plain(src, f"{DAY} 00", "a.json", ['{"id":1,"v":"x"}', '{"id":'])
    (query,) = ingest_stream(spark, src, dest, ck, SCHEMA, quarantine=bad)
    query.awaitTermination()
    from hourlake.plans.ingest import parsed_landing
    publish_batch(parsed_landing(spark, src, "all", SCHEMA)[0], 0, dest, bad)
    assert [tuple(r) for r in read_published(spark, dest).collect()] == [(1, "x", "2024", "01", "01", "00")]
    assert [r._corrupt_record for r in spark.read.parquet(bad).collect()] == ['{"id":']
    # A table of the file sink has a log that would hide these files.
    (other,) = ingest_stream(spark, src, dest + "2", ck + "2", SCHEMA)
    other.awaitTermination()
    with pytest.raises(ValueError):
        ingest_stream(spark, src, dest + "2", ck + "3", SCHEMA, quarantine=bad)


def test_inventories_of_two_roots_meet(spark, workdir):
    a, b = _paths(workdir, "a", "b")
    write_plain(a, f"{DAY} 00", "p.json", ['{"id":1}'])
    write_plain(b, f"{DAY} 00", "p.json", ['{"id":1}'])
    one, two = list_files(spark, a), list_files(spark, b)
    assert new_files(one, two).count() == 1 and one.join(two, "path").count() == 0
    assert sorted(r.day for r in one.unionByName(two).collect()) == ["01", "01"]


def test_bad_documents_are_counted_where_they_were_written(spark, workdir, monkeypatch):
    """The ledger's bad documents come from the quarantine's own pass: the landing is not parsed again for them."""
    import hourlake.plans.ingest as plan

    src, dest, bad, ledger = _paths(workdir, "l", "lake", "q", "ledger")
    write_plain(src, f"{DAY} 00", "p.json", ['{"id":1}', '{"id":2'])
    write_plain(src, f"{DAY} 01", "p.json", ['{"id":3'])
    record = plan.record_run

    def changed_before_the_end(spark, report, *rest):
        if report.end_time is not None:
            for hour in ("00", "01"):
                write_plain(src, f"{DAY} {hour}", "p.json", ['{"id":1}', '{"id":2}'])
        record(spark, report, *rest)

    monkeypatch.setattr(plan, "record_run", changed_before_the_end)
    for quarantine, mode in ((bad, "PERMISSIVE"), (None, "PERMISSIVE"), (bad, "DROPMALFORMED")):
        write_plain(src, f"{DAY} 00", "p.json", ['{"id":1}', '{"id":2'])
        write_plain(src, f"{DAY} 01", "p.json", ['{"id":3'])
        report = plan.ingest(spark, src, dest, "all", schema="id bigint", quarantine=quarantine, mode=mode, ledger=ledger)
        assert report.all_bad_hours == [("2024", "01", "01", "01")]
        got = {r.hour: (r.hour_rows, r.hour_bad, r.status) for r in latest_runs(read_ledger(spark, ledger)).collect()}
        assert got == {"00": (1, 1, "succeeded"), "01": (0, 1, "all_bad")}
    assert spark.read.parquet(bad).count() == 2

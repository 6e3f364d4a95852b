import os
import time
from datetime import datetime, timezone


from conftest import plan_text, write_plain
from hourlake.operators.files import bytes_per_hour, new_files, total_bytes
from hourlake.operators.ledger import latest_per_key, latest_runs, read_ledger
from hourlake.plans.ingest import ingest
from hourlake.sources.inventory import list_files, list_published_files, modified_since


def test_inventory_bytes_and_modified_since(spark, workdir):
    src = os.path.join(workdir, "l")
    write_plain(src, "2024-01-01 00", "a.json", ['{"id":1}'])
    write_plain(src, "2024-01-01 00", "b.json", ['{"id":2}', '{"id":3}'])
    time.sleep(1.1)
    mark = datetime.now(timezone.utc)
    time.sleep(0.1)
    write_plain(src, "2024-01-01 01", "c.json", ['{"id":4}'])
    files = list_files(spark, src, "all")
    per_hour = {r.hour: (r.files, r.total_bytes) for r in bytes_per_hour(files).collect()}
    assert per_hour == {"00": (2, 9 + 18), "01": (1, 9)}
    assert tuple(total_bytes(files).first()) == (3, 36)
    recent = [r.path.rsplit("/", 1)[1] for r in modified_since(files, mark).collect()]
    assert recent == ["c.json"]
    assert "content" not in plan_text(files).split("ReadSchema")[-1]


def test_new_and_removed_files_after_rerun(spark, workdir):
    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    write_plain(src, "2024-01-01 00", "a.json", ['{"id":1}'])
    write_plain(src, "2024-01-01 01", "b.json", ['{"id":2}'])
    ingest(spark, src, dest, "2024-01-01 00", schema="id bigint")
    before = list_published_files(spark, dest).checkpoint()
    ingest(spark, src, dest, "all", schema="id bigint")
    after = list_published_files(spark, dest)
    assert sorted(r.hour for r in new_files(after, before).collect()) == ["00", "01"]
    assert [r.hour for r in new_files(before, after).collect()] == ["00"]


def test_ledger_records_runs(spark, workdir):
    src, dest, ledger = (os.path.join(workdir, n) for n in ("l", "lake", "ledger"))
    write_plain(src, "2024-01-01 00", "a.json", ['{"id":1}{"id":2}'])
    write_plain(src, "2024-01-01 01", "b.json", ['{"id":3}'])
    ingest(spark, src, dest, "all", schema="id bigint", ledger=ledger)
    second = ingest(spark, src, dest, "2024-01-01 01", schema="id bigint", ledger=ledger)
    entries = read_ledger(spark, ledger)
    assert entries.count() == 6  # a row per hour when a run starts, one when it ends
    assert sorted(r.status for r in entries.collect()) == ["running"] * 3 + ["succeeded"] * 3
    latest = {r.hour: r for r in latest_runs(entries).collect()}
    assert latest["01"].run_id == second.run_id and latest["01"].run_documents == 1
    assert latest["00"].run_documents == 3 and latest["00"].status == "succeeded"
    assert (latest["00"].total_bytes, latest["00"].bytes_processed) == (17, 17)


def test_latest_per_key_ties_and_a_hot_key(spark):
    rows = [("hot", 1, i, f"r{i}") for i in range(5000)] + [("hot", 2, 7, "late-a"), ("hot", 2, 9, "late-b"),
                                                            ("cold", 1, 1, "only")]
    df = spark.createDataFrame(rows, "k string, start int, run int, payload string").repartition(8)
    out = {r.k: (r.start, r.run, r.payload) for r in latest_per_key(df, ["k"], ["start", "run"]).collect()}
    assert out == {"hot": (2, 9, "late-b"), "cold": (1, 1, "only")}
    plan = plan_text(latest_per_key(df, ["k"], ["start", "run"]), "simple")
    assert "partial_max" in plan and "Window" not in plan


def test_ledger_records_empty_hours(spark, workdir):
    src, dest, ledger = (os.path.join(workdir, n) for n in ("l", "lake", "ledger"))
    write_plain(src, "2024-01-31 23", "a.json", ['{"id":1}'])
    ingest(spark, src, dest, ("2024-01-31 22", "2024-02-01 00"), schema="id bigint", ledger=ledger)
    os.makedirs(os.path.join(workdir, "none"))
    ingest(spark, os.path.join(workdir, "none"), dest, "2024-02-01 05", schema="id bigint", ledger=ledger)
    rows = sorted((r.month, r.day, r.hour, r.files, r.run_documents) for r in latest_runs(read_ledger(spark, ledger)).collect())
    assert rows == [("01", "31", "22", 0, 1), ("01", "31", "23", 1, 1), ("02", "01", "00", 0, 1),
                    ("02", "01", "05", 0, 0)]

import os

import pytest

from conftest import write_plain
from hourlake.plans.ingest import ingest
from hourlake.sources.inventory import list_files
from hourlake.sources.landing import read_documents, read_lines
from hourlake.sources.published import read_published

SCHEMA = "id bigint, ts string"


def test_plain_layout_hours_come_from_folders(spark, workdir):
    src = os.path.join(workdir, "landing")
    # A record stamped 01:59 that landed in the 02 folder belongs to hour 02.
    write_plain(src, "2024-03-05 02", "a.json", ['{"id":1,"ts":"2024-03-05T01:59:00"}{"id":2,"ts":"x"}'])
    write_plain(src, "2024-03-05 03", "b.json", ['{"id":3,"ts":"y"}', '{"id":4,"ts":"z"}'])
    write_plain(src, "2024-03-05 03", "_hidden.json", ['{"id":99}'])
    write_plain(src, "2024-03-05 03", ".hidden.json", ['{"id":98}'])
    write_plain(src, "2024-03-05 04", "empty.json", [])
    os.makedirs(os.path.join(src, "2024", "03", "05", "05"))  # an hour with no file
    docs = read_documents(spark, src, ("2024-03-05 00", "2024-03-05 23"), "plain")
    got = sorted((r.doc, r.hour) for r in docs.collect())
    assert got == [('{"id":1,"ts":"2024-03-05T01:59:00"}', "02"), ('{"id":2,"ts":"x"}', "02"),
                   ('{"id":3,"ts":"y"}', "03"), ('{"id":4,"ts":"z"}', "03")]
    one = read_lines(spark, src, "2024-03-05 03", "plain")
    assert one.count() == 2
    # Hidden files are not listed; a 0-byte file is, although it has no line.
    files = list_files(spark, src, "all", "plain").collect()
    assert sorted((r.hour, r.path.rsplit("/", 1)[1], r.length > 0) for r in files) == [
        ("02", "a.json", True), ("03", "b.json", True), ("04", "empty.json", False)]


def test_no_files_at_all_is_empty_but_no_root_is_an_error(spark, workdir):
    src = os.path.join(workdir, "nothing")
    for call in (read_lines, list_files):
        with pytest.raises(FileNotFoundError):
            call(spark, src, "2024-03-05 02")
    os.makedirs(src)
    for call in (read_lines, list_files):
        assert call(spark, src, "2024-03-05 02").count() == 0
        assert call(spark, src, "all").count() == 0


def test_ingest_plain_layout_end_to_end(spark, workdir):
    src, dest = os.path.join(workdir, "landing"), os.path.join(workdir, "lake")
    write_plain(src, "2018-04-06 16", "part.json", ['{"id":1,"ts":"a"}{"id":2,"ts":"b"}', '{"id":3,"ts":"c"}'])
    report = ingest(spark, src, dest, "2018-04-06 16", schema=SCHEMA)
    assert (report.documents, report.published, report.quarantined) == (3, 3, 0)
    assert os.path.isdir(os.path.join(dest, "year=2018", "month=04", "day=06", "hour=16"))
    out = read_published(spark, dest)
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "a", "2018", "04", "06", "16"), (2, "b", "2018", "04", "06", "16"),
        (3, "c", "2018", "04", "06", "16")]
    parts = [f for f in os.listdir(os.path.join(dest, "year=2018/month=04/day=06/hour=16"))
             if f.endswith(".parquet")]
    assert parts and all(".snappy." in f for f in parts)


def test_inferred_schema_when_none_given(spark, workdir):
    src, dest = os.path.join(workdir, "landing"), os.path.join(workdir, "lake")
    write_plain(src, "2018-04-06 16", "p.json", ['{"id":1,"v":1.5}{"id":2,"w":"x"}'])
    report = ingest(spark, src, dest, "2018-04-06 16")
    assert report.schema.simpleString() == "struct<id:bigint,v:double,w:string>"
    got = read_published(spark, dest, schema=report.schema).orderBy("id").select("id", "v", "w").collect()
    assert [tuple(r) for r in got] == [(1, 1.5, None), (2, None, "x")]


def test_gzip_files_and_name_filter(spark, workdir):
    import gzip

    src = os.path.join(workdir, "landing")
    folder = write_plain(src, "2024-03-05 02", "a.json", ['{"id":1,"ts":"a"}'])
    with gzip.open(os.path.join(folder, "b.json.gz"), "wt", encoding="utf-8") as handle:
        handle.write('{"id":2,"ts":"b"}{"id":3,"ts":"c"}\n')
    write_plain(src, "2024-03-05 02", "notes.txt", ["not json"])
    docs = read_documents(spark, src, "2024-03-05 02", "plain", file_glob="*.json*")
    assert sorted(r.doc for r in docs.collect()) == ['{"id":1,"ts":"a"}', '{"id":2,"ts":"b"}', '{"id":3,"ts":"c"}']


def test_hour_ranges_select_exactly_their_folders(spark, workdir):
    import random
    from datetime import datetime, timedelta

    src = os.path.join(workdir, "landing")
    first = datetime(2024, 1, 30, 0)
    landed = [first + timedelta(hours=h) for h in range(0, 24 * 33, 5)]  # crosses Feb 29 into March
    for h in landed:
        write_plain(src, h.strftime("%Y-%m-%d %H"), "p.json", [f'{{"h":"{h:%Y%m%d%H}"}}'])
    rng = random.Random(3)
    for _ in range(4):
        a = first + timedelta(hours=rng.randrange(24 * 33))
        b = a + timedelta(hours=rng.randrange(24 * 20))
        want = sorted(f"{h:%Y%m%d%H}" for h in landed if a <= h <= b)
        lines = read_lines(spark, src, (a.strftime("%Y-%m-%d %H"), b.strftime("%Y-%m-%d %H")), "plain")
        got = sorted(r.year + r.month + r.day + r.hour for r in lines.collect())
        assert got == want, (a, b)
        assert all(r.value == f'{{"h":"{r.year}{r.month}{r.day}{r.hour}"}}' for r in lines.collect())


@pytest.mark.parametrize("layout", ["plain", "hive"])
def test_files_below_an_hour_folder_belong_to_the_hour(spark, workdir, layout):
    names = ("2024", "03", "05", "02") if layout == "plain" else ("year=2024", "month=03", "day=05", "hour=02")
    src = os.path.join(workdir, "a b", "2023", "01", "01", "00")  # the root may look like an hour itself
    for sub in ("", "sub dir", os.path.join("x", "y")):
        folder = os.path.join(src, *names, sub)
        os.makedirs(folder)
        with open(os.path.join(folder, f"p {len(sub)}.json"), "w") as handle:
            handle.write(f'{{"id":{len(sub)}}}\n')
    with open(os.path.join(src, "readme.txt"), "w") as handle:
        handle.write("no hour\n")
    for hours in ("2024-03-05 02", "all"):
        got = sorted((r.value, r.year, r.month, r.day, r.hour) for r in read_lines(spark, src, hours, layout).collect())
        assert got == [(f'{{"id":{n}}}', "2024", "03", "05", "02") for n in (0, 3, 7)]
        files = list_files(spark, src, hours, layout).collect()
        assert [(r.length, r.hour) for r in files] == [(9, "02")] * 3

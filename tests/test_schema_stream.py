import os

from pyspark.sql import types as T

from conftest import write_plain
from hourlake.operators.parse import infer_schema
from hourlake.operators.schema import align_by_name, common_schema
from hourlake.sources.landing import read_documents
from hourlake.sources.published import read_published
from hourlake.streaming.file_stream import ingest_stream


def test_align_by_name(spark):
    a = spark.createDataFrame([(1, "x", 2)], "id bigint, s string, n int")
    b = spark.createDataFrame([("y", 3, 1.5)], "s string, id bigint, n double")
    c = spark.createDataFrame([(4, "z")], "id int, extra string")
    out = align_by_name([a, b, c])
    assert out.schema.simpleString() == "struct<id:bigint,s:string,n:double,extra:string>"
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [(1, "x", 2.0, None), (3, "y", 1.5, None), (4, None, None, "z")], key=str)


def test_common_schema_widens_to_string():
    s = common_schema([T.StructType([T.StructField("v", T.LongType())]),
                       T.StructType([T.StructField("v", T.StringType())])])
    assert s["v"].dataType == T.StringType()


def test_native_inference_equals_reader_inference(spark, workdir):
    src = os.path.join(workdir, "l")
    write_plain(src, "2024-01-01 00", "a.json", ['{"a":1,"b":{"c":[1,2]},"d":null}{"a":2.5,"e":true}'])
    write_plain(src, "2024-01-01 01", "b.json", ['{"a":"x","b":{"c":[]},"f":[{"g":1},{"h":"i"}]}', "junk"])
    docs = read_documents(spark, src)
    native = infer_schema(docs)
    reader = infer_schema(docs, options={"prefersDecimal": "false"})
    assert native == reader
    assert native.simpleString() == ("struct<a:string,b:struct<c:array<bigint>>,d:string,e:boolean,"
                                     "f:array<struct<g:bigint,h:string>>>")


def test_available_now_stream_takes_each_file_once(spark, workdir):
    src, dest, ck, q = (os.path.join(workdir, n) for n in ("l", "lake", "ck", "q"))
    write_plain(src, "2024-01-01 00", "a.json", ['{"id":1}{"id":2}', '{"id":'])
    run = lambda: [x.awaitTermination() for x in ingest_stream(spark, src, dest, ck, "id bigint",
                                                                 max_bytes_per_trigger=8, quarantine=q)]
    run()
    write_plain(src, "2024-01-01 01", "b.json", ['{"id":3}'])
    run()
    run()
    got = sorted((r.id, r.hour) for r in read_published(spark, dest).collect())
    assert got == [(1, "00"), (2, "00"), (3, "01")]
    assert [r._corrupt_record for r in spark.read.parquet(q).collect()] == ['{"id":']


def test_byte_cap_splits_batches(spark, workdir):
    src, dest, ck = (os.path.join(workdir, n) for n in ("l", "lake", "ck"))
    for h in range(4):
        write_plain(src, f"2024-01-01 0{h}", "a.json", [f'{{"id":{h}}}'])
    (query,) = ingest_stream(spark, src, dest, ck, "id bigint", max_bytes_per_trigger=1)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 4
    assert sorted(r.id for r in read_published(spark, dest).collect()) == [0, 1, 2, 3]


def test_a_large_backlog_takes_a_bounded_number_of_batches(spark, workdir):
    src, dest, ck = (os.path.join(workdir, n) for n in ("l", "lake", "ck"))
    for h in range(9):
        write_plain(src, f"2024-01-01 0{h}", "a.json", [f'{{"id":{h}}}'])
    (query,) = ingest_stream(spark, src, dest, ck, "id bigint", max_bytes_per_trigger=1, max_batches=3)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    assert sorted(r.id for r in read_published(spark, dest).collect()) == list(range(9))


def test_published_hours_with_drifting_columns(spark, workdir):
    from hourlake.plans.ingest import ingest

    src, dest = os.path.join(workdir, "l"), os.path.join(workdir, "lake")
    write_plain(src, "2024-01-01 00", "a.json", ['{"id":1,"a":"x"}'])
    write_plain(src, "2024-01-01 01", "b.json", ['{"id":2,"b":2.5}'])
    ingest(spark, src, dest, "2024-01-01 00")
    ingest(spark, src, dest, "2024-01-01 01")
    got = sorted(tuple(r) for r in read_published(spark, dest, merge_schema=True)
                 .select("id", "a", "b", "hour").collect())
    assert got == [(1, "x", None, "00"), (2, None, 2.5, "01")]


def test_align_struct_with_text_gives_json(spark):
    a = spark.createDataFrame([(1, (2, "z"))], "id bigint, p struct<n: int, s: string>")
    b = spark.createDataFrame([(3, "raw")], "id bigint, p string")
    out = align_by_name([a, b])
    assert dict((r.id, r.p) for r in out.collect()) == {1: '{"n":2,"s":"z"}', 3: "raw"}

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourlake.operators.parse import CORRUPT, bad_records, good_records, infer_schema, parse_documents
from hourlake.sources.landing import documents

SCHEMA = "a bigint, b string"


def _lines(spark, values):
    return spark.createDataFrame([(v, "2024", "01", "01", "00", "f") for v in values],
                                 "value string, year string, month string, day string, hour string, "
                                 "_source_file string")


def test_bad_records_are_kept_with_their_text(spark):
    lines = _lines(spark, ['{"a":1,"b":"x"}', '{"a":2,"b":"y"', '{"a":"zz"}', '{"a":3}xyz',
                           "", "   ", "5", '[{"a":4},{"a":5,"b":"}{"}]', '{"a":6}{"a":7}'])
    parsed = parse_documents(documents(lines), SCHEMA)
    good = sorted((r.a, r.b) for r in good_records(parsed).collect())
    assert good == [(1, "x"), (4, None), (5, "}{"), (6, None), (7, None)]
    bad = sorted(r[CORRUPT] for r in bad_records(parsed).collect())
    assert bad == sorted(["5", '{"a":2,"b":"y"', '{"a":"zz"}', '{"a":3}xyz'])
    assert set(bad_records(parsed).columns) == {"_source_file", "year", "month", "day", "hour", CORRUPT}


def test_dropmalformed_and_failfast(spark):
    lines = _lines(spark, ['{"a":1}', '{"a":'])
    dropped = parse_documents(documents(lines), SCHEMA, mode="DROPMALFORMED")
    assert [r.a for r in dropped.collect()] == [1]
    with pytest.raises(PySparkException, match="malformed JSON record in f"):
        parse_documents(documents(lines), SCHEMA, mode="FAILFAST").collect()


def test_timestamps_keep_microseconds(spark):
    lines = _lines(spark, ['{"t":"2024-01-01T00:00:07.179575"}'])
    parsed = parse_documents(documents(lines), "t timestamp_ntz")
    assert parsed.select(F.date_format("t", "ss.SSSSSS")).first()[0] == "07.179575"


def test_hour_columns_in_schema_are_refused_or_renamed(spark):
    docs = documents(_lines(spark, ['{"hour":5,"a":1}']))
    with pytest.raises(ValueError, match="collide"):
        parse_documents(docs, "hour int")
    row = good_records(parse_documents(docs, "hour int, a int", clash_suffix="_f")).first()
    assert (row.hour_f, row.a, row.hour) == (5, 1, "00")
    with pytest.raises(ValueError, match="same name"):
        parse_documents(docs, "hour int, hour_f int", clash_suffix="_f")


@pytest.mark.parametrize("line,good,bad", [
    ('{"a":1},{"a":2}', [1, 2], []),
    ('{"a":1} , {"a":2}\t,{"a":3}', [1, 2, 3], []),
    ('{"a":1}xyz}', [], ['{"a":1}xyz}']),
    ('{"a":3}}', [], ['{"a":3}}']),
    ('{"a":1}garbage{"a":2}', [], ['{"a":1}garbage{"a":2}']),
    ('{"a":1},', [], ['{"a":1},']),
    ('{"a":1}{"a":2}}', [1], ['{"a":2}}']),
    ("{'a':1,'b':'p}{q'}{'a':2}", [1, 2], []),
    ('{"a":1,"b":"it\'s }{ fine"}{"a":2}', [1, 2], []),
    ('[{"a":1},{"a":2}]', [1, 2], []),
    ('[{"a":1}', [], ['[{"a":1}']),
    ('[{"a":1,"a":2}]', [2], []),
    ('{"a":1,"c":{"d":{}}}', [1], []),
    ('{"a":1,"c":{"d":{}}}} {"a":4}', [4], ['{"a":1,"c":{"d":{}}}}']),
])
def test_no_document_is_lost(spark, line, good, bad):
    parsed = parse_documents(documents(_lines(spark, [line])), SCHEMA).collect()
    assert sorted(r.a for r in parsed if r[CORRUPT] is None) == good
    assert [r[CORRUPT] for r in parsed if r[CORRUPT] is not None] == bad


def test_decimals_in_arrays_are_exact(spark):
    text = "1.123456789012345678"
    parsed = parse_documents(documents(_lines(spark, [f'[{{"d":{text}}},{{"d":2}}]', f'{{"d":{text}}},{{"d":{text}}}'])), "d decimal(38,18)")
    assert sorted(str(r.d) for r in parsed.collect()) == [text] * 3 + ["2.000000000000000000"]


def test_inference_with_odd_names_and_documents(spark):
    lines = ['{"user.id":1,"m":{},"e":[{}],"x":null,"b`t":{"p q":1.5},"z":[1,"a"]}', '{"x":true,"k":[{"u-v":2}]}',
             '{"a":1,"a":2,"only":7}', "{'single':'q'}", "5", "[1,2]", '{"broken":', '{"cut":1}junk}']
    schema = infer_schema(documents(_lines(spark, lines)))
    assert schema.simpleString() == ("struct<a:bigint,b`t:struct<p q:double>,k:array<struct<u-v:bigint>>,only:bigint,"
                                     "single:string,user.id:bigint,x:boolean,z:array<string>>")
    good = good_records(parse_documents(documents(_lines(spark, lines)), schema)).collect()
    assert len(good) == 4 and {r["user.id"] for r in good} == {1, None} and {r["b`t"]["p q"] for r in good if r["b`t"]} == {1.5}
    assert infer_schema(documents(_lines(spark, ["{}", "7"]))).fields == []

import json
import random

from pyspark.sql import functions as F

from conftest import plan_text
from hourlake.functions.json_text import document_values, line_documents, split_documents, token_count
from hourlake.operators.parse import parse_documents
from hourlake.operators.reconcile import reconcile
from hourlake.sources.landing import documents

PIECES = ["}", "{", '"', "\\", "}{", '"}{"', "} {", "a", " ", "\n", "é", "]", "["]


def _text(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 8)))


def test_split_cases(spark):
    lines = [
        ('{"a":1}{"b":"x}{y"} {"c":{"d":2}}', ['{"a":1}', '{"b":"x}{y"}', '{"c":{"d":2}}']),
        ('{"a":"q\\"}{"}', ['{"a":"q\\"}{"}']),
        ('{"a":1}', ['{"a":1}']),
        ('{"a":[{"b":1},{"c":2}]}{"d":3}', ['{"a":[{"b":1},{"c":2}]}', '{"d":3}']),
        ('{"a":"unclosed}{"b":1}', ['{"a":"unclosed}{"b":1}']),
        # Documents before an unclosed string are kept; the rest stays one (bad) fragment.
        ('{"a":1} {"b":"oops}{"c":2}', ['{"a":1}', '{"b":"oops}{"c":2}']),
        ('{"a":1}\t{"b":2}', ['{"a":1}', '{"b":2}']),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(lines)], "i int, value string")
    got = {r.i: r.parts for r in df.select("i", split_documents(F.col("value")).alias("parts")).collect()}
    for i, (_, want) in enumerate(lines):
        assert got[i] == want, (i, got[i])


def test_split_property_against_python_json(spark):
    rng = random.Random(42)
    rows, expected = [], []
    for line_no in range(3000):
        docs = []
        for _ in range(rng.randint(1, 4)):
            doc = {"k": rng.randint(0, 10**6), "s": _text(rng), "n": {"t": _text(rng)}}
            docs.append(doc)
            expected.append((line_no, doc["k"], doc["s"], doc["n"]["t"]))
        seps = [rng.choice(["", "", " ", "\t"]) for _ in docs]
        rows.append((line_no, "".join(json.dumps(d, ensure_ascii=rng.random() < 0.5) + s
                                      for d, s in zip(docs, seps))))
    lines = spark.createDataFrame(rows, "line_no int, value string")
    docs = lines.select("line_no", F.explode(split_documents(F.col("value"))).alias("doc"))
    parsed = parse_documents(docs, "k bigint, s string, n struct<t: string>")
    got = sorted((r.line_no, r.k, r.s, r.n.t) for r in parsed.collect())
    assert parsed.where("_corrupt_record is not null").count() == 0
    assert got == sorted(expected)


def test_array_elements(spark):
    df = spark.createDataFrame([('[{"a":1},{"a":"zz"}]',), ('  {"a":2} ',), ("[{\"a\":1}",), ("[]",)], "doc string")
    got = [r.e for r in df.select(document_values(F.col("doc"))["doc"].alias("e")).collect()]
    assert got == [['{"a":1}', '{"a":"zz"}'], ['{"a":2}'], ['[{"a":1}'], []]


def test_split_property_nested_values(spark):
    rng = random.Random(7)
    rows, expected = [], []
    for line_no in range(1500):
        docs = []
        for _ in range(rng.randint(1, 3)):
            doc = {"k": rng.randint(0, 10**6),
                   "a": [_text(rng) for _ in range(rng.randint(0, 3))],
                   "o": [{"t": _text(rng), "u": [rng.randint(0, 9)]} for _ in range(rng.randint(0, 2))]}
            docs.append(doc)
            expected.append((line_no, doc["k"], tuple(doc["a"]), tuple((o["t"], tuple(o["u"])) for o in doc["o"])))
        rows.append((line_no, "".join(json.dumps(d, separators=rng.choice([(",", ":"), (", ", ": ")]))
                                      + rng.choice(["", " ", "\n "]) for d in docs)))
    lines = spark.createDataFrame(rows, "line_no int, value string")
    docs = lines.select("line_no", F.explode(split_documents(F.col("value"))).alias("doc"))
    parsed = parse_documents(docs, "k bigint, a array<string>, o array<struct<t: string, u: array<int>>>")
    assert parsed.where("_corrupt_record is not null").count() == 0
    got = sorted((r.line_no, r.k, tuple(r.a), tuple((o.t, tuple(o.u)) for o in r.o)) for r in parsed.collect())
    assert got == sorted(expected)


def test_mixed_values(spark):
    cases = [
        ('[{"a":1},{"a":2}][{"a":3}]', ['{"a":1}', '{"a":2}', '{"a":3}'], True),
        ('[{"a":1}] , [{"a":2}]', ['{"a":1}', '{"a":2}'], True),
        ('[{"a":1}]{"a":2}', ['{"a":1}', '{"a":2}'], True),
        ('{"a":1}[{"a":2}]', ['{"a":1}', '{"a":2}'], True),
        ('{"a":1},[{"a":{"b":[2]}}]', ['{"a":1}', '{"a":{"b":[2]}}'], True),
        ('[{"a":"][ }{"}][]', ['{"a":"][ }{"}'], True),
        ('[{"a":1}] junk', ['[{"a":1}] junk'], False),
        ('junk [{"a":1}]', ['junk [{"a":1}]'], False),
        # A list that closes early would hide what is behind it.
        ('{"a":1}],[{"a":2}', ['{"a":1}],[{"a":2}'], False),
        ('1],"x":[2', ['1],"x":[2'], False),
    ]
    lines = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, value string")
    docs = documents(lines)
    got = {}
    for r in docs.collect():
        got.setdefault(r.i, []).append((r.doc, r._one_value))
    for i, (_, want, whole) in enumerate(cases):
        assert got[i] == [(w, whole) for w in want], cases[i]
    tokens = lambda df, col: {r.i: r.n for r in df.groupBy("i").agg(F.sum(token_count(F.col(col))).alias("n")).collect()}
    assert tokens(lines, "value") == tokens(docs, "doc")


def test_audit_sees_a_lost_document(spark):
    hour = "'2024' AS year, '01' AS month, '01' AS day, '00' AS hour"
    lines = spark.createDataFrame([('[{"a":1},{"a":2}][{"a":3}]',)], "value string").selectExpr("value", *hour.split(", "))
    docs = documents(lines)
    rows = docs.select(F.get_json_object("doc", "$.a").alias("a"), "year", "month", "day", "hour")
    none = docs.limit(0)
    assert reconcile(docs, none, rows, lines).first().matches
    # A splitter that stops behind the first array agrees with what it published, not with the text.
    lost = docs.where("doc <> '{\"a\":3}'")
    published = rows.where("a <> '3'")
    assert reconcile(lost, none, published).first().matches
    audit = reconcile(lost, none, published, lines).first()
    assert (audit.landed_tokens, audit.document_tokens, audit.matches) == (9, 6, False)


def test_a_fragment_is_read_once(spark):
    """What stands in a lambda's body is computed as often as it stands there."""
    df = spark.createDataFrame([("[1,2]",)], "v string")
    assert plan_text(df.select(line_documents(F.col("v")).alias("d")), "extended").split("== Physical Plan ==")[1].count("concat([[") == 1

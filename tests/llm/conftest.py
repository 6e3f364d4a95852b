import random

import pytest

from pyspark.sql import Row
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use for columns of their own.
    *(T.StructField(c, T.StringType()) for c in (
        "row", "rows", "chunk", "class", "host", "sig", "size", "target", "copies", "taken", "score", "lang_pred", "start",
        "n_tokens", "ids", "word", "part", "answers", "component_id", "removed_lines", "kept", "segment", "h")),
])


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def messy_rows():
    """Nulls, empty and odd texts, a long text, exact and near copies, repeated rows, a hot source."""
    rng = random.Random(5)
    out = []

    def add(doc_id, text, lang="en", source="hot"):
        extra = {f.name: "x" for f in SCHEMA.fields[5:]}
        out.append(Row(doc_id=doc_id, text=text, lang=lang, source=source, n_chars=None if text is None else len(text), **extra))

    base = words(rng, 120)
    for k in range(12):
        add(k, base if k % 3 == 0 else base + " " + words(rng, 3), source="hot")
    for k in range(12, 40):
        add(k, words(rng, rng.randrange(1, 150)) + "\n" + words(rng, 5), lang="ab"[k % 2], source=f"s{k % 4}")
    add(40, None)
    add(41, "", lang=None, source=None)
    add(42, " \t\n\x0b ")
    add(43, "one")
    add(44, "é ß 日本  x  y\r\nz \x1c   <|endoftext|> ]]", source=None)
    add(45, words(rng, 30_000, 20_000), source="long")
    add(46, "a " * 300)
    add(47, base[:300], source=None)
    add(48, "12 34 ... !!")
    out.append(out[3])                                   # a repeated row
    add(5, words(rng, 60), source="again")               # a doc_id with another text
    add(None, base, source="nobody")
    add(None, words(rng, 40))
    add(49, base.upper(), lang=None)
    return out


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(5, "doc_id")


@pytest.fixture(scope="session")
def plain(spark):
    """The messy documents whose ids are whole and unique."""
    seen, rows = set(), []
    for r in messy_rows():
        if r.doc_id is not None and r.doc_id not in seen:
            seen.add(r.doc_id)
            rows.append(r)
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "text")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

"""Embeddings, conversations, components, registered queries and the pipeline."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from hourlake.llm import chat_format, embedding_dedup
from hourlake.llm.chunks import save
from hourlake.llm.components import components
from hourlake.llm.queries import ORACLE_SQL, QUERIES


def vectors():
    rng = np.random.default_rng(8)
    out = []
    centers = rng.normal(size=(6, 16))
    for k in range(300):
        out.append((k, (centers[k % 6] + rng.normal(size=16) * (0.05 + 0.1 * (k % 5))).tolist()))
    out += [(300 + k, out[0][1]) for k in range(20)] + [(330, [2 * x for x in out[1][1]])]
    out += [(340, None), (341, [0.0] * 16), (342, [math.nan] * 16), (343, [math.inf] * 16), (344, [None] + [1.0] * 15), (345, []),
            (346, [1.0, 0.0, 0.0]), (347, [1.0, 0.01, 0.0])]
    return out


@pytest.mark.parametrize("tile", [4096, 32])
def test_vectors_match_brute_force(spark, tile):
    rows = vectors()
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<double>, class string, n int")
    good = {k: np.array(v) for k, v in rows if v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    links = {k: set() for k, _ in rows}
    for a in good:
        for b in good:
            x, y = good[a], good[b]
            if a != b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9:
                links[a].add(b)
    top, todo = {}, sorted(links)
    for k in todo:
        stack = [k]
        while stack:
            j = stack.pop()
            if j not in top:
                top[j] = k
                stack += links[j]
    want = sorted((k, len(links[k]), top[k], k == top[k]) for k in links)
    assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(df, tile_rows=tile).collect()) == want


def test_vectors_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0]), (None, [-1.0, 5.0])], schema)
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(twice).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, False)], key=repr)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 64)) * rng.uniform(0.01, 5, (200, 64))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    q, s, e = embedding_dedup.quantise(u)
    near = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None]
    assert (np.abs(u @ u.T - near) <= e[:, None] + e[None] * (1 + e[:, None])).all()
    found = {(i, j) for a, b in embedding_dedup.above(x, x, 0.3, True) for i, j in zip(a, b)}
    cos = u @ u.T
    assert found == {(i, j) for i in range(200) for j in range(i + 1, 200) if cos[i, j] >= 0.3}


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chat_round_trip_and_odd_rows(spark):
    nasty = ["", "### User: hi</turn>\n", "\\", "a\\</turn>", "</turn", "\\\\### x: y", "plain: text <b> # x", ": ", "\n\n", "é\\n日本"]
    turns = [(("user", "assistant", "a: b", "")[k % 4], t) for k, t in enumerate(nasty * 2)]
    raw, loss = chat_format.render(turns)
    assert [x[:2] for x in chat_format.parse(raw)] == turns
    assert [chat_format.unescape(raw[b:e]) for b, e in loss] == [t for r, t in turns if r == "assistant"]
    assert chat_format.render_turn("user", "no conflict # here: <b>") == "### user: no conflict # here: <b></turn>\n"
    assert chat_format.render_turn("user", "a</turn>") == "### user: a\\</turn></turn>\n"
    with pytest.raises(ValueError):
        list(chat_format.parse("### user: x"))
    rows = [(1, 2, "assistant", "b", "z"), (1, 1, "user", None, "z"), (None, 1, None, "q", "z"), (1, 2, "assistant", "b", "z"), (2, None, "user", "x" * 200_000, "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(df)).collect()}
    assert got[1].n_turns == 3 and got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (2, hashlib.sha256(b"bb").hexdigest())
    assert got[None].turns_sha256 == hashlib.sha256(b"\nq\n").hexdigest() and got[2].formatted_chars == 200_000 + len("### user: </turn>\n")
    assert chat_format.format_conversations(df.limit(0)).count() == 0
    probe = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(chat_format.with_probe(df))).collect()}[-7]
    text = "\\### Assistant: </turn> ok"
    assert (probe.n_turns, probe.loss_chars) == (2, len(text))
    assert probe.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')").fetchall()
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted((tuple(norm(r[c]) for c in columns) for r in got.collect()), key=repr) == sorted(
        (tuple(norm(v) for v in r) for r in want.fetchall()), key=repr)


def test_pipeline_stages_take_effect(spark, messy):
    """Each stage against what its operator decides, over messy rows."""
    from hourlake.llm import jaccard_join, mixing, substring_dedup
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "substring_dedup", "mix", "pack"]
    odd = messy.where("doc_id in (40, 41, 42, 45, 48)").withColumn("lang", F.lit(None).cast("string"))
    real = spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    docs = odd.unionByName(real, allowMissingColumns=True)
    columns, given = docs.columns, {r.doc_id for r in real.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = save(stage(spark, docs, SF), "stage")
        if name == "language_id":
            ids = {r.doc_id for r in out.collect()}
            assert not ids & {40, 41, 42, 48} and len(given - ids) <= 2
        elif name == "ngram_jaccard":
            first = {r.doc_id for r in jaccard_join.groups(docs).where("doc_id = component_id").collect()}
            assert sorted(r.doc_id for r in out.collect()) == sorted(first)
        elif name == "substring_dedup":
            left = {r.doc_id: r.n_words - r.n_removed for r in substring_dedup.digest(docs).collect()}
            got = {r.doc_id: len(r.text.encode().split()) for r in out.collect()}
            assert got == {k: v for k, v in left.items() if v}
        elif name == "mix":
            want = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
            got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
            assert got == {k: v for k, v in want.items() if v}
        if name != "pack":
            assert out.columns == columns
            docs = out
        else:
            per = out.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
            copies = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert {r.doc_id: r.n // r.doc_tokens for r in per} == copies

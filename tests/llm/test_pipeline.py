"""Cases of the pipeline's stages: what must not be lost."""

from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from hourlake.llm import jaccard_join, language_id, mixing
from llm.test_documents import jaccard_sets, reachable


def test_near_copies_keep_null_and_repeated_ids(spark, messy):
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcde")
    rows = [(0, a), (5, a), (5, b), (None, a), (None, c), (None, d), (None, d + " more"), (7, e), (7, "two words"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted((r for r in got if not (r[1] or "").startswith(d)), key=repr) == sorted(
        [(0, a), (5, b), (None, c), (7, e), (7, "two words"), (8, None)], key=repr)
    assert [r[0] for r in got if (r[1] or "").startswith(d)] == [None]


def test_near_copies_of_messy_rows_match_brute_force(spark, messy, empty):
    rows = messy.collect()
    sets = jaccard_sets(rows)
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    top = reachable(range(len(rows)), pairs)
    of = {}
    for k, t in top.items():
        of.setdefault(t, []).append(rows[k].doc_id)
    want = [min(ids, key=lambda x: (x is None, x)) for ids in of.values()]
    out = jaccard_join.firsts(messy)
    got = out.collect()
    assert out.schema == messy.schema and set(got) <= set(rows)
    assert sorted((r.doc_id for r in got), key=repr) == sorted(want, key=repr)
    assert jaccard_join.firsts(empty).count() == 0


def test_language_stage_loses_no_text_with_letters(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    some = {r.lang: r.text[:300] for r in real.orderBy("doc_id").collect() if r.lang and len(r.text) > 300}
    mixed = [(10_000 + k, x, "en") for k, x in enumerate(["Von.", "That it.", "a", "Ok!", " ".join(some.values())])]
    none = [(20_000, None, "en"), (20_001, "", "de"), (20_002, "12 34 ... !!", "fr")]
    docs = real.unionByName(spark.createDataFrame(mixed + none, real.schema))
    out = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(r.doc_id for r in out.collect()) == sorted(
        r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect())
    assert not {r[0] for r in none} & {r.doc_id for r in out.collect()}


def test_every_labelled_language_is_learned(spark):
    names = [f"l{k:03d}" for k in range(70)]
    rows = [(k * 20 + j, f"{x} text {j}", x) for k, x in enumerate(names) for j in range(2 + 18 * (k < 64))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = sorted({r.lang for r in docs.where(~language_id.held_out(F.col("doc_id"))).collect()})
    assert len(want) > 64
    languages, weights = language_id.learn(docs)
    assert languages == want and len(weights["c"]) == len(want)


def test_mix_keeps_rows_that_differ_in_other_columns(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text, "s", "en"), (1, text, "s", "de"), (1, text, "s", "de"), (2, text + " x", "s", "en"), (None, text, None, "fr"), (3, None, "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = docs.select("doc_id", "source", F.xxhash64("text").alias("sig"), F.lit(1).cast("long").alias("copies"))
    got = sorted((tuple(r) for r in mixing.repeat(docs, mixed).collect()), key=repr)
    assert got == sorted(rows, key=repr)
    twice = sorted((tuple(r) for r in mixing.repeat(docs, mixed.withColumn("copies", F.lit(2).cast("long"))).collect()), key=repr)
    assert twice == sorted(rows * 2, key=repr)


def _written(spark, docs):
    from hourlake.session import scratch_dir
    folder = scratch_dir(spark, "pipeline-input")
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_whole_run_on_messy_rows(spark, messy):
    """Null, repeated and odd rows through all stages: pieces of every kept document, each id once, all windows full but the last."""
    real = spark.read.parquet(f"{SF}/documents.parquet").limit(60).withColumn("doc_id", F.col("doc_id") + 1000)
    docs = messy.unionByName(real, allowMissingColumns=True)
    out = corpus_pipeline.run(spark, _written(spark, docs)).collect()
    per = {}
    for r in out:
        assert r.length > 0 and 0 <= r.offset and r.offset + r.length <= 1024
        per.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in per.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    # Whole documents, as often as the mix takes them; texts without a letter are gone.
    sums = {}
    for r in out:
        sums[r.doc_id, r.doc_tokens] = sums.get((r.doc_id, r.doc_tokens), 0) + r.length
    assert all(n % size == 0 for (_, size), n in sums.items())
    assert not {40, 41, 42, 48} & {r.doc_id for r in out} and {r.doc_id for r in out} & set(range(12, 40))


def test_a_stage_leaves_no_scratch_behind_the_next(spark):
    import os
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    corpus_pipeline.drop_near_copies(spark, docs, "").count()
    folders = list(corpus_pipeline._BEHIND)
    assert folders and all(os.path.isdir(f.replace("file:", "")) for f in folders)
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert not any(os.path.exists(f.replace("file:", "")) for f in folders)
    assert out.count() >= 0 and corpus_pipeline._BEHIND


def test_whole_run_on_an_empty_table(spark, empty):
    out = corpus_pipeline.run(spark, _written(spark, empty))
    assert out.count() == 0 and "sequence_id" in out.columns

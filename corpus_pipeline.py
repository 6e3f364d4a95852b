"""A training-data pipeline over ``documents``: five of the operators, one after the other."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm import jaccard_join, language_id, mixing, packing, substring_dedup
from hourlake.llm.chunks import clear, collecting
from hourlake.llm.queries import ship
from hourlake.session import scratch_dir


_BEHIND: list[str] = []


def stage(function):
    """A stage whose scratch tables go when the next stage begins: its result is written by then, and nothing reads them.

    So the shared folder holds one stage's intermediate tables, not those of all.
    """
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear(spark, _BEHIND)
        with collecting() as folders:
            out = function(spark, docs, sf_dir)
        _BEHIND.extend(folders)
        return out

    return run_stage


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text with a letter goes on, however unsure its language; ``und`` goes."""
    ship(spark)
    languages, weights = language_id.learn(docs)
    found = language_id.predict(docs, languages, weights)
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select(docs.columns)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their word 5-grams one row stays, that of the least doc_id.

    A null doc_id comes after all others, and of rows that share a doc_id each unlinked text stays.
    """
    ship(spark)
    return jaccard_join.firsts(docs)


@stage
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that repeat an earlier 20-word window go, and documents of which nothing is left."""
    ship(spark)
    out = substring_dedup.remove_repeats(docs)
    return out.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat(docs, mixing.mix(docs))


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    ship(spark)
    return packing.pack(docs).drop("ids")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: The recurrent network and the mix's roundings are nothing SQL expresses.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    clear(spark, _BEHIND)
    return docs

"""Registered queries of the llm operators: thin digests over whole tables."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm import chat_format, embedding_dedup, jaccard_join, language_id, lm_score, merkle, mixing, neighbour_graph, packing, prefix_trie, quality_lines, sql, substring_dedup, token_planes
from hourlake.session import scratch_dir

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python may not find it otherwise."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="run-ship-"), "hourlake_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("hourlake", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_lines.judge(_table(spark, sf_dir, "documents"))
    return judged.drop("host", "sig", "removed_lines")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).drop("ids")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_probe(_table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.format_conversations(rows))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op9_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = scratch_dir(spark, "token-planes")
    token_planes.write_token_files(docs, path)
    return token_planes.read_token_files(spark, path)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuild(_table(spark, sf_dir, "conversations")))


def op12_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.nearest(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_frequency": op1_line_frequency,
    "op3_substring_dedup": op3_substring_dedup,
    "op2_pack": op2_pack,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_language_id": op5_language_id,
    "op6_chat_format": op6_chat_format,
    "op7_masked_lm": op7_masked_lm,
    "op8_mix": op8_mix,
    "op9_token_planes": op9_token_planes,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_nn_descent": op12_nn_descent,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE_SQL: dict[str, str] = {
    "op1_line_frequency": sql.OP1,
    "op3_substring_dedup": sql.OP3,
    "op4_embedding_dedup": sql.OP4,
    "op6_chat_format": sql.OP6,
    "op10_ngram_jaccard": sql.OP10,
    "op11_prefix_trie": sql.OP11,
    "op13_merkle_manifest": sql.OP13,
}

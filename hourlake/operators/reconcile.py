"""Reconciling landed documents with published rows, per hour."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.functions.hours import PARTITION_COLUMNS
from hourlake.functions.json_text import token_count


def reconcile(documents: DataFrame, bad: DataFrame, published: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Per hour: documents landed, bad documents, rows published, and
    whether every document is published or set aside exactly once.

    ``documents`` are those of the landing before any schema is applied, ``bad`` the
    quarantined ones, so what the parse loses shows. With ``lines``, the landed text itself, the
    documents are held against it too: ``landed_tokens`` and ``document_tokens`` count the names, values and
    objects of the lines and of the documents cut from them (:func:`token_count`, one pattern over the raw text, which
    knows nothing of how lines are cut), and an hour with more or fewer in its documents does not match. All sides are aggregated to
    one row per hour before they meet, so the joins are small.
    """
    keys = list(PARTITION_COLUMNS)
    rows = F.count(F.lit(1))
    sides = [(documents, [rows.alias("source_docs")]), (bad, [rows.alias("bad_docs")]), (published, [rows.alias("published_rows")])]
    if lines is not None:
        sides[0][1].append(F.sum(token_count(F.col("doc"))).alias("document_tokens"))
        sides.append((lines, [F.sum(token_count(F.col("value"))).alias("landed_tokens")]))
    per_hour = [df.groupBy(*keys).agg(*aggs) for df, aggs in sides]
    out = reduce(lambda a, b: a.join(b, on=keys, how="full_outer"), per_hour)
    names = ["source_docs", "bad_docs", "published_rows"] + (["landed_tokens", "document_tokens"] if lines is not None else [])
    zero = F.lit(0).cast("bigint")
    out = out.select(*keys, *[F.coalesce(n, zero).alias(n) for n in names])
    matches = (F.col("source_docs") - F.col("bad_docs")) == F.col("published_rows")
    if lines is not None:
        matches &= F.col("landed_tokens") == F.col("document_tokens")
    return out.withColumn("matches", matches)

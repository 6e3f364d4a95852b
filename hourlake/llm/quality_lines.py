"""Quality rules: base counts of a text, and lines that too many documents of a host share.

A line counts by the hash of its normalised words (A-Z in lower case, one space between words). Per host, the
distinct documents that hold it are counted; exact copies of a text are one document here, removing them is
another operator's work. Lines held by more documents than the limit are removed, and a document is
rejected if too little is left of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm import words as W
from hourlake.llm.chunks import few, save, slices

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A line goes if more documents of its host hold it than both of these allow.
LIMIT_DOCS = 10
LIMIT_SHARE = 0.002
#: A document is depleted if fewer than MIN_WORDS or less than this share of its words are left.
LEAST_LEFT = 0.5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeat_words(h: np.ndarray, w: W.Words, length: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of ``length`` words found twice or more in it."""
    if len(h) < length:
        return np.zeros(len(w.first) - 1, np.int64)
    at = np.flatnonzero(W.within(w, length))
    key = W.pair(W.window_hashes(h, length)[at], w.document[at].astype(np.uint64))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[count[which] > 1]
    edge = np.bincount(twice, minlength=len(h) + 1) - np.bincount(twice + length, minlength=len(h) + 1)[:len(h) + 1]
    return _per_text(np.cumsum(edge)[:len(h)] > 0, w.first)


def lines(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word: first word, begin and end byte."""
    breaks = np.flatnonzero(w.data == 10)
    line = np.searchsorted(breaks, w.start)
    doc = w.document
    new = np.concatenate([[True], (np.diff(line) > 0) | (np.diff(doc) > 0)]) if len(line) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    line, doc = line[first], doc[first]
    begin = np.maximum(np.concatenate([[0], breaks + 1])[line], w.offsets[doc])
    end = np.minimum(np.concatenate([breaks, [len(w.data)]])[line], w.offsets[doc + 1])
    return first, begin, end


def line_hashes(w: W.Words, first: np.ndarray) -> np.ndarray:
    """Hash of each line's lower-cased words, whatever the white space between them."""
    data = np.where((w.data >= 65) & (w.data <= 90), w.data + np.uint8(32), w.data)
    return span_hashes(W.hash_spans(data, w.start, w.end), first, np.append(first[1:], len(w.start)))


def span_hashes(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of word hashes."""
    up, down = W._powers(len(h))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:len(h)], dtype=np.uint64)])
    return W.pair((total[end] - total[begin]) * down[begin], (end - begin).astype(np.uint64))


_FIELDS = ("doc_id long, host string, sig long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, hashes array<long>, counts array<int>")


def _measure(part: pa.RecordBatch) -> pa.RecordBatch:
    w = W.split_words(part.column("text"))
    n, h = part.num_rows, W.word_hashes(w)
    first, begin, end = lines(w)
    doc = w.document[first].astype(np.uint64)
    raw = W.pair(W.hash_spans(w.data, begin, end), doc)
    _, earliest = np.unique(raw, return_index=True)
    again = np.ones(len(first), bool)
    again[earliest] = False
    dup = np.bincount(doc[again].astype(np.int64), minlength=n)
    # The distinct normalised lines of each text with their words.
    key = line_hashes(w, first)
    size = np.diff(np.append(first, len(w.start)))
    order = np.lexsort((key, doc))
    fresh = np.concatenate([[True], (np.diff(doc[order]) > 0) | (key[order][1:] != key[order][:-1])]) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(fresh)
    counts = np.add.reduceat(size[order], at) if len(at) else np.zeros(0, np.int64)
    ends = np.searchsorted(doc[order][at], np.arange(n + 1).astype(np.uint64)).astype(np.int32)
    inside = ~W._SPACE[w.data]
    columns = [part.column("doc_id"), part.column("host"), part.column("sig"), pa.array(w.count, pa.int64()),
               pa.array(_per_text(inside & ((w.data & 0xC0) != 0x80), w.offsets)),
               pa.array(_per_text(_SYMBOL[w.data], w.offsets)), pa.array(dup.astype(np.int64)),
               pa.array(repeat_words(h, w)),
               pa.ListArray.from_arrays(pa.array(ends), pa.array(key[order][at].view(np.int64))),
               pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.astype(np.int32)))]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _FIELDS.split(", ")])


def judge(docs: DataFrame, limit_docs: int = LIMIT_DOCS, limit_share: float = LIMIT_SHARE,
          least_left: float = LEAST_LEFT) -> DataFrame:
    """A row per document: doc_id, host, sig, the base counts, base_failed, removed_words, removed_lines, kept.

    ``docs`` needs doc_id, source (the host) and text; other columns are not read. A null or empty text has no
    words and fails; a null host is one host; repeated rows are judged alike; an empty table gives no rows.
    ``removed_lines`` lists the hashes of the document's lines above the limit.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield _measure(part)

    host = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("host")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host, F.xxhash64("text").alias("sig"), "text")
    rows = save(rows.mapInArrow(run, _FIELDS).withColumn("row", F.monotonically_increasing_id()), "lines")
    # Distinct texts of a host; sums of one row per host and text.
    hosts = rows.groupBy("host").agg(F.count("*").alias("docs")).select(
        F.col("host").alias("h"), F.greatest(F.lit(limit_docs), (F.col("docs") * limit_share).cast("long")).alias("limit"))
    held = rows.join(few(hosts), F.col("host") == F.col("h")).select(
        "row", "host", "sig", "limit", F.explode(F.arrays_zip("hashes", "counts")).alias("l"))
    held = held.select("row", "sig", "limit", F.xxhash64("host", "l.hashes").alias("key"), "l.hashes", "l.counts")
    common = (held.select("key", "sig", "limit").distinct().groupBy("key")
              .agg(F.count("*").alias("n"), F.max("limit").alias("limit")).where("n > limit").select("key"))
    gone = held.select("row", "key", "hashes", "counts").join(save(common, "common"), "key").groupBy("row").agg(
        F.sum("counts").alias("removed_words"), F.collect_list("hashes").alias("removed_lines"))
    out = rows.drop("hashes", "counts").join(gone, "row", "left")
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - removed
    kept = ~failed & (left >= MIN_WORDS) & (left >= least_left * F.col("n_words"))
    return out.select("doc_id", "host", "sig", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), kept.alias("kept"), removed.alias("removed_words"),
                      F.coalesce("removed_lines", F.array().cast("array<long>")).alias("removed_lines"))


def clean(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, all columns, without their removed lines; repeated rows come out as often as given."""
    keys = judged.where("kept").groupBy("doc_id", "sig").agg(F.first("removed_lines").alias("_gone")).select(
        F.col("doc_id").alias("_id"), F.col("sig").alias("_sig"), "_gone")
    joined = docs.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_sig")))
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column("text"), batch.column("_gone").to_pylist(), strict=True):
                if gone:
                    w = W.split_words(pa.array([text.as_py()], pa.string()))
                    first, begin, end = lines(w)
                    bad = np.isin(line_hashes(w, first).view(np.int64), gone)
                    raw, parts, at = w.data.tobytes(), [], 0
                    for b, e in zip(begin[bad].tolist(), end[bad].tolist(), strict=True):
                        parts.append(raw[at:b])
                        at = min(e + 1, len(raw))
                    texts.append(b"".join([*parts, raw[at:]]).decode())
                else:
                    texts.append(text.as_py())
            columns = [pa.array(texts, batch.schema.field("text").type) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*names, "_gone").mapInArrow(run, docs.schema)

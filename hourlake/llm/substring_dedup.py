"""Removal of word sequences that an earlier document holds too, by level-wise doubling.

Windows of ``base`` words come first. Only where one of them is held twice is it extended to a window of twice
its length, and so on up to ``window`` words; what is unique at one length is never looked at again.

At the short lengths it is enough to ask for some of the windows: of all short windows inside a long one, the
one with the least hash. Equal long windows have equal least short windows, so a long window whose least
short window is unique is unique itself, and about one short window in eight is asked for. The last length
asks for every window left. Keys are 64-bit hashes, at the last length 80 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm import words as W
from hourlake.llm.chunks import bucket_count, entries, entry_batch, exchange, joined_bits, save, tidy, unpack, write_chunks

WINDOW = 20
BASE = 5
_LAST = np.iinfo(np.int64).max
_HIGH = np.uint64(0xFFFFFFFFFFFFFFFF)


def levels(window: int = WINDOW, base: int = BASE) -> list[int]:
    """Window lengths from ``base`` on, each twice the one before, and ``window`` last."""
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


class _Chunk:
    """A chunk's words and which of its windows may still be repeats."""

    def __init__(self, rows: pa.RecordBatch, text: str, doc_id: str, window: int):
        self.rows, self.window = rows, window
        self.words = W.split_words(rows.column(text))
        self.h = W.word_hashes(self.words)
        self.alive = W.within(self.words, window)
        ids = rows.column(doc_id).cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.ids = np.repeat(ids, self.words.count)  # of each word; null is the last id

    def _padded(self, length: int) -> np.ndarray:
        out = np.full(len(self.h), _HIGH, np.uint64)
        found = W.window_hashes(self.h, length)
        out[:len(found)] = found
        return out

    def ask(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the least windows of ``length`` inside the long windows left begin, and all short hashes."""
        span = self.window - length + 1
        short = self._padded(length)
        least = W.sliding_min(short, span)
        cover = W.sliding_max_before(np.where(self.alive, least, np.uint64(0)), span)
        return np.flatnonzero(cover == short), short

    def keys(self, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Distinct keys of a level and whether the chunk itself holds them twice.

        Least hashes are small ones; scrambled, the keys spread evenly over the key ranges.
        """
        at, short = self.ask(length)
        keys, count = np.unique(W.mix(short[at]), return_counts=True)
        return keys, [(count > 1).astype(np.uint8)]

    def drop_unique(self, length: int, bits: np.ndarray | None) -> None:
        """Keep the long windows whose least short window of ``length`` is held twice."""
        at, short = self.ask(length)
        if bits is None or not len(at):
            self.alive[:] = False
            return
        asked = W.mix(short[at])
        twice = bits[np.searchsorted(np.unique(asked), asked)] > 0
        span = self.window - length + 1
        seen = np.full(len(short), _HIGH, np.uint64)
        seen[at[twice]] = short[at[twice]]
        self.alive &= (W.sliding_min(seen, span) == W.sliding_min(short, span)) & (W.sliding_min(seen, span) != _HIGH)

    def last_keys(self):
        """Windows left, their distinct keys, each key's least doc_id here, its check, and the key of each window."""
        at = np.flatnonzero(self.alive)
        full = W.window_hashes(self.h, self.window)[at] if len(at) else np.zeros(0, np.uint64)
        order = np.lexsort((self.ids[at], full))
        keys, first = np.unique(full[order], return_index=True)
        which = np.searchsorted(keys, full)
        least = self.ids[at][order][first]
        check = W.window_hashes(W.mix(self.h ^ np.uint64(0x5851F42D4C957F2D)), self.window)[at][order][first].astype(np.uint16) \
            if len(at) else np.zeros(0, np.uint16)
        return at, which, keys, least, check

    def repeats(self, bits: np.ndarray | None) -> np.ndarray:
        """Words covered by a window that begins earlier too; ``bits``: the chunk holds the key's least doc_id."""
        at, which, keys, least, _ = self.last_keys()
        covered = np.zeros(len(self.h) + 1, np.int64)
        if bits is not None and len(at):
            mine = (bits[which] > 0) & (self.ids[at] == least[which])
            # Of a row's equal windows only the first begins earliest.
            row = self.words.document[at]
            key = W.pair(keys[which], row.astype(np.uint64))
            _, first = np.unique(key, return_index=True)
            earliest = np.zeros(len(at), bool)
            earliest[first] = True
            later = at[~(mine & earliest)]
            np.add.at(covered, later, 1)
            np.add.at(covered, later + self.window, -1)
        return np.cumsum(covered)[:len(self.h)] > 0


def _twice(keys: np.ndarray, holder: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each entry whether two places hold its key."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    begin = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
    size = np.diff(np.append(begin, len(k)))
    hit = (size > 1) | (np.maximum.reduceat(many[order], begin) > 0)
    out = np.zeros(len(keys), np.uint8)
    out[order] = np.repeat(hit, size)
    return out


def _first_holder(keys: np.ndarray, holder: np.ndarray, ids: np.ndarray, check: np.ndarray) -> np.ndarray:
    """For each entry whether no other chunk holds its key under a smaller doc_id."""
    order = np.lexsort((ids, check, keys))
    k, c, i = keys[order], check[order], ids[order]
    begin = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]) | (c[1:] != c[:-1])) + 1])
    size = np.diff(np.append(begin, len(k)))
    out = np.zeros(len(keys), np.uint8)
    out[order] = i == np.repeat(i[begin], size)
    return out


def find_repeats(chunks: DataFrame, window: int = WINDOW, base: int = BASE, text: str = "text",
                 doc_id: str = "doc_id") -> tuple[DataFrame, list[int]]:
    """Answers of every level: ``chunk``, ``answers`` map from level to (bucket, bits), and the levels."""
    steps, buckets, known = levels(window, base), bucket_count(chunks), None
    for level, length in enumerate(steps):
        def run(batches, level=level, length=length):
            for batch in batches:
                for i in range(batch.num_rows):
                    c = _Chunk(unpack(batch.column("rows")[i]), text, doc_id, window)
                    _replay(c, batch, i, steps[:level])
                    if length < window:
                        keys, columns = c.keys(length)
                    else:
                        _, _, keys, least, check = c.last_keys()
                        columns = [least, check]
                    if len(keys):
                        yield entry_batch(entries(batch.column("chunk")[i].as_py(), keys, columns, buckets))

        source = chunks if known is None else chunks.join(known, "chunk")
        asked = source.mapInArrow(tidy(run), "bucket int, chunk long, n int, blob binary")
        if length < window:
            found = exchange(asked, ["u1"], _twice)
        else:
            found = exchange(asked, ["i8", "u2"], _first_holder)
        found = found.select("chunk", F.col("answers").alias(f"level{level}"))
        # A chunk without an answer has nothing left to ask; only its absence is passed on.
        known = save(found if known is None else known.join(found, "chunk", "left"), "repeats")
    return known, steps


def _replay(c: _Chunk, batch: pa.RecordBatch, i: int, steps: list[int]) -> None:
    for level, length in enumerate(steps):
        c.drop_unique(length, joined_bits(batch.column(f"level{level}")[i].as_py()))


def _apply(docs: DataFrame, window: int, base: int, text: str, doc_id: str, rows_of, schema) -> DataFrame:
    chunks = write_chunks(docs, text)
    known, steps = find_repeats(chunks, window, base, text, doc_id)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                c = _Chunk(unpack(batch.column("rows")[i]), text, doc_id, window)
                _replay(c, batch, i, steps[:-1])
                yield rows_of(c, c.repeats(joined_bits(batch.column(f"level{len(steps) - 1}")[i].as_py())))

    return chunks.join(known, "chunk", "left").mapInArrow(tidy(run), schema)


def kept_words(c: _Chunk, gone: np.ndarray) -> list[bytes]:
    """Each text's kept words joined by one space."""
    raw = c.words.data.tobytes()
    start, end, first = c.words.start.tolist(), c.words.end.tolist(), c.words.first.tolist()
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if not gone[a:b].any():
            out.append(b" ".join(raw[start[a]: end[b - 1]].split()) if b > a else b"")
        else:
            out.append(b" ".join([raw[start[k]: end[k]] for k in (np.flatnonzero(~gone[a:b]) + a).tolist()]))
    return out


def digest(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document (doc_id, text); other columns are not read.

    Null and empty texts have no words. A null doc_id counts as the greatest. Rows that share a doc_id are
    documents of their own of which none is earlier than the other. An empty table gives no rows.
    """
    def rows_of(c: _Chunk, gone: np.ndarray) -> pa.RecordBatch:
        removed = np.concatenate([[0], np.cumsum(gone)])
        sha = [hashlib.sha256(x).hexdigest() for x in kept_words(c, gone)]
        return pa.RecordBatch.from_arrays(
            [c.rows.column("doc_id"), pa.array(c.words.count, pa.int64()),
             pa.array(removed[c.words.first[1:]] - removed[c.words.first[:-1]], pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _apply(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), window, base, "text", "doc_id",
                  rows_of, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """``docs``, all columns, their texts without repeated words; texts that lose nothing stay as they are.

    White space before a removed word goes with it. Cases are those of :func:`digest`.
    """
    names = docs.columns
    where = names.index("text")

    def rows_of(c: _Chunk, gone: np.ndarray) -> pa.RecordBatch:
        raw, texts = c.words.data.tobytes(), c.rows.column(where).to_pylist()
        first, offsets = c.words.first, c.words.offsets
        for k in np.unique(c.words.document[gone]).tolist():
            a, b = int(first[k]), int(first[k + 1])
            begins = np.concatenate([[offsets[k]], c.words.end[a: b - 1]]) if b > a else []
            parts = [raw[x:y] for x, y, g in zip(begins, c.words.end[a:b], gone[a:b], strict=True) if not g]
            parts.append(raw[c.words.end[b - 1]: offsets[k + 1]])
            texts[k] = b"".join(parts).decode().lstrip() if gone[a] else b"".join(parts).decode()
        columns = [pa.array(texts, f.type) if i == where else c.rows.column(i) for i, f in enumerate(c.rows.schema)]
        return pa.RecordBatch.from_arrays(columns, names)

    return _apply(docs, window, base, "text", "doc_id", rows_of, docs.schema)

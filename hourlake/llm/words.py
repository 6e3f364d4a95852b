"""Words of whole texts as numpy arrays: offsets and 64-bit hashes, many documents at a time.

A word is a run of bytes other than space and \\x09-\\x0D, which for UTF-8 text is the
pattern ``[^\\x20\\x09-\\x0D]+``; a null text has no words. All sums wrap at 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shifts and odd multiplications)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each ordered pair of hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + mix(b + np.uint64(0x2545F4914F6CDD1D)))


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` consecutive values from each position on; ``len(h) - length + 1`` of them.

    A window of 2n values is the pair of its halves, one of 2n + 1 values adds the last.
    """
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if length == 1:
        return h.copy()
    if length % 2:
        return pair(window_hashes(h, length - 1)[:n], h[length - 1:])
    half = window_hashes(h, length // 2)
    return pair(half[:n], half[length // 2: length // 2 + n])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts behind each other and the offsets of each; null counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    data: np.ndarray      # bytes of all texts
    offsets: np.ndarray   # of the texts in data
    start: np.ndarray     # of each word in data
    end: np.ndarray
    first: np.ndarray     # index of each text's first word, and the number of words

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def document(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Words of each text of ``column``; ``lower`` turns the bytes A-Z into a-z first."""
    data, offsets = text_buffers(column)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside])      # the byte before is part of a word
    here = np.concatenate([inside, [False]])
    start = np.flatnonzero(here & (~before | edge))
    end = np.flatnonzero(before & (~here | edge))
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial in a fixed odd base, scrambled with the length."""
    up, down = _powers(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])
    return pair((total[end] - total[start]) * down[start], (end - start).astype(np.uint64))


def word_hashes(w: Words) -> np.ndarray:
    return hash_spans(w.data, w.start, w.end)


def within(w: Words, length: int) -> np.ndarray:
    """Whether ``length`` words of one text begin at each word."""
    last = np.repeat(w.first[1:], w.count)
    return np.arange(len(w.start)) + length <= last


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Least of x[i:i+k] for each i (short at the end)."""
    out, have = x.copy(), 1
    while have < k:
        step = min(have, k - have)
        out[:-step] = np.minimum(out[:-step], out[step:])
        have += step
    return out


def sliding_max_before(x: np.ndarray, k: int) -> np.ndarray:
    """Greatest of x[i-k+1:i+1] for each i (short at the start)."""
    out, have = x.copy(), 1
    while have < k:
        step = min(have, k - have)
        out[step:] = np.maximum(out[step:], out[:-step].copy())
        have += step
    return out

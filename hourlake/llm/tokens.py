"""Token ids of whole texts by the public ``tokenizers`` library, with a cache of units.

A byte-level BPE never merges over the start of a run of white space, so a text may be cut before every
space or newline that follows a visible sign, and the ids of the units put behind each other. One whose pattern of
words is that of the library's byte level ends a word before every other ASCII sign than a letter or digit, too. Units repeat
a lot: those of a slice of texts are hashed and looked up at once in a bounded cache per Python
worker, and only unknown ones are made distinct and tokenized. Signs count as visible if they are ASCII or a letter of the next
Unicode blocks; after any other sign nothing is cut, so unusual white space stays inside its unit.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from hourlake.llm import words as W

#: Units that the cache holds before it is emptied, besides those of the slice at hand.
CACHE_UNITS = 1_000_000
_STATE: dict[str, tuple] = {}


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Cache:
    """Ids of units by their hash, in arrays: an open-addressed table of hashes (0: free), half full at most, the
    number of each hash's unit beside it, and the ids of all units behind each other. Whole slices are looked up at once."""

    def __init__(self, kind: np.dtype):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.count, self.used = 0, 0
        self.keys, self.unit = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int32)
        self.begin, self.size = np.zeros(1 << 11, np.int64), np.zeros(1 << 11, np.int64)
        self.ids = np.zeros(1 << 12, self.kind)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key's unit, -1 if it is unknown."""
        out = np.full(len(keys), -1, np.int64)
        mask = len(self.keys) - 1
        at, slot = None, (keys & np.uint64(mask)).astype(np.int64)
        while len(slot):
            have = self.keys[slot]
            hit = have == keys
            on = ~hit & (have != 0)
            if at is None:
                out[hit] = self.unit[slot[hit]]
                at = np.flatnonzero(on)
            else:
                out[at[hit]] = self.unit[slot[hit]]
                at = at[on]
            keys, slot = keys[on], (slot[on] + 1) & mask
        return out

    def _place(self, keys: np.ndarray, unit: np.ndarray) -> None:
        mask = len(self.keys) - 1
        slot = (keys & np.uint64(mask)).astype(np.int64)
        while len(slot):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]  # one of those that share a slot gets it
            got = self.keys[slot] == keys
            self.unit[slot[got]] = unit[got]
            keys, unit, slot = keys[~got], unit[~got], (slot[~got] + 1) & mask

    def add(self, keys: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of new units, whose ids lie at ``begin`` of ``ids``."""
        number = np.arange(self.count, self.count + len(keys))
        if 2 * (self.count + len(keys)) > len(self.keys):
            old, unit = self.keys, self.unit
            slots = 1 << int(4 * (self.count + len(keys)) - 1).bit_length()
            self.keys, self.unit = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
            self._place(old[old != 0], unit[old != 0])
        self._place(keys, number)
        self.begin = _put(self.begin, self.count, begin + self.used)
        self.size = _put(self.size, self.count, size)
        self.ids = _put(self.ids, self.used, ids)
        self.count += len(keys)
        self.used += len(ids)
        return number


def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``array`` with ``values`` from ``at`` on, made larger if they do not fit."""
    if at + len(values) > len(array):
        array = np.concatenate([array[:at], np.zeros(2 * (at + len(values)) - at, array.dtype)])
    array[at: at + len(values)] = values
    return array


def _load(path: str):
    if path not in _STATE:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # Units are cut from texts that hold no special token; whole texts that do go another way.
        tokenizer.encode_special_tokens = True
        size = tokenizer.get_vocab_size()
        kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # In a byte-level vocabulary every sign of an id's name is a byte.
        sizes = np.array([len(tokenizer.id_to_token(k) or "") for k in range(size)])
        special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values() if t.content]
        pre = json.loads(tokenizer.to_str())["pre_tokenizer"] or {}
        words = pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        _STATE[path] = (tokenizer, kind, sizes, _Cache(kind), special, words)
    return _STATE[path]


def forget() -> None:
    """Empty the caches of units."""
    for state in _STATE.values():
        state[3].clear()


def _with_special(state: tuple, raw: bytes, offsets: np.ndarray) -> list[tuple[int, bytes]]:
    """Index and ids of the texts that hold a special token by name, which the library takes for the token: encoded as they are."""
    tokenizer, kind, special = state[0], state[1], state[4]
    found = set()
    for name in special:
        at = raw.find(name)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            if at + len(name) <= offsets[row + 1]:
                found.add(row)
                at = raw.find(name, int(offsets[row + 1]))
            else:
                at = raw.find(name, at + 1)
    tokenizer.encode_special_tokens = False
    try:
        return [(k, np.array(tokenizer.encode(raw[offsets[k]: offsets[k + 1]].decode(), add_special_tokens=False).ids, kind).tobytes())
                for k in sorted(found)]
    finally:
        tokenizer.encode_special_tokens = True


def id_type(path: str) -> np.dtype:
    """Two bytes where all ids fit, else four."""
    return _load(path)[1]


def _units(data: np.ndarray, offsets: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each unit of all texts, and whether each byte ends a visible sign."""
    two = (data >= 0xC3) & (data <= 0xDF)
    visible = (data >= 0x21) & (data <= 0x7E)
    visible[1:] |= two[:-1] & ((data[1:] & 0xC0) == 0x80)
    cut = (data == 0x20) | (data == 0x0A)
    cut[1:] &= visible[:-1]
    if words:
        low = data | 0x20
        letter = (low >= 0x61) & (low <= 0x7A)
        sign = (data >= 0x21) & (data <= 0x7E) & ~letter & ((data < 0x30) | (data > 0x39))
        cut[1:] |= sign[1:] & letter[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    begin = np.flatnonzero(cut)
    return begin, np.append(begin[1:], len(data)), visible


def _learn(state: tuple, data: np.ndarray, begin: np.ndarray, end: np.ndarray,
           visible: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of unknown units behind each other, and where those of each begin and how many they are; many units go in one text.

    A unit led by white space may stand behind any that ends with a visible sign. The first unit of a text
    has no white space before it; put behind a newline, which is an id of its own before a visible sign, it
    keeps its ids. Others are tokenized by themselves. Every id stands for a fixed number of bytes, so
    the ids of a unit end where its bytes end.
    """
    tokenizer, kind, sizes = state[:3]
    first = data[begin]
    led = (first == 0x20) | (first == 0x0A)
    # A visible first sign: ASCII, or the lead byte of one of the next blocks.
    seen = ((first >= 0x21) & (first <= 0x7E)) | ((first >= 0xC3) & (first <= 0xDF))
    together = visible[end - 1] & (led | seen)
    ids, counts = [], np.zeros(len(begin), np.int64)
    joined, alone = np.flatnonzero(together), np.flatnonzero(~together)
    for lo in range(0, len(joined), 2_000):
        some = joined[lo: lo + 2_000]
        head = ~led[some]
        length = end[some] - begin[some] + head
        ends = np.cumsum(length)
        text = data[np.maximum(np.repeat(begin[some] - head - (ends - length), length) + np.arange(ends[-1]), 0)]
        text[(ends - length)[head]] = 0x0A
        found = np.array(tokenizer.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, kind)
        cuts = np.searchsorted(np.cumsum(sizes[found]), ends, side="right")
        starts = np.concatenate([[0], cuts[:-1]])
        counts[some] = cuts - starts - head
        ids.append(np.delete(found, starts[head]))
    for k in alone.tolist():
        found = np.array(tokenizer.encode(data[begin[k]: end[k]].tobytes().decode(), add_special_tokens=False).ids, kind)
        counts[k] = len(found)
        ids.append(found)
    order = np.concatenate([joined, alone])
    at = np.empty(len(begin), np.int64)
    at[order] = np.cumsum(counts[order]) - counts[order]
    return np.concatenate([np.zeros(0, kind), *ids]), at, counts


def encode_column(column: pa.Array, path: str, end_id: int | None = 0) -> list[bytes]:
    """Little-endian ids of each text, in :func:`id_type`, with ``end_id`` behind each; null counts as empty.

    The ids are those of the library with its defaults and add_special_tokens=False: the name of a special token in
    a text is that token."""
    state = _load(path)
    kind, cache = state[1], state[3]
    data, offsets = W.text_buffers(column)
    begin, end, visible = _units(data, offsets, state[5])
    keys = np.maximum(W.hash_spans(data, begin, end), np.uint64(1))
    unit = cache.find(keys)
    new = np.flatnonzero(unit < 0)
    if len(new):
        names, first, which = np.unique(keys[new], return_index=True, return_inverse=True)
        if cache.count + len(names) > CACHE_UNITS and cache.count:
            cache.clear()
            new = np.arange(len(keys))
            names, first, which = np.unique(keys, return_index=True, return_inverse=True)
        at = new[first]
        unit[new] = cache.add(names, *_learn(state, data, begin[at], end[at], visible))[which]
    count = cache.size[unit]
    after = np.concatenate([[0], np.cumsum(count)])
    ids = cache.ids[np.repeat(cache.begin[unit] - after[:-1], count) + np.arange(after[-1])]
    bounds = after[np.searchsorted(begin, offsets)].tolist()
    tail = b"" if end_id is None else np.array([end_id], kind).tobytes()
    out = [ids[a:b].tobytes() + tail for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for k, whole in _with_special(state, data.tobytes(), offsets):
        out[k] = whole + tail
    return out

"""Language-model scores by masked pseudo-likelihood: every token predicted from both sides.

A token is a lower-cased word. The words with the highest counts in the whole corpus are classes of their own, all
others are classes by their last bytes, in which a word is as likely as its share of the class's count in the
corpus. There are more classes the more distinct words the corpus has. A network sees SIDE tokens before and after a place, never the place itself, and gives each class a
probability in two steps, the class's group and the class in its group. A document's score is the sum of the
logarithms over all its tokens.

The network starts from a fit to a sample of places. Then every task fits it to all places of its share of the corpus,
and the weights of the tasks are averaged by their places.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm import words as W
from hourlake.llm.chunks import entries, entry_batch, exchange, joined_bits, save, slices

#: The least number of groups of classes and of classes in a group; both grow with the corpus' distinct words.
GROUPS = 32
PER_GROUP = 32
ENDINGS = 64
SIDE = 2
HIDDEN = 24
#: The bounded sample of the first fit; counts and the second fit cover the whole corpus.
SAMPLE_DOCS = 1200
SAMPLE_TOKENS = 200
STEPS = 250
BATCH = 2048
#: Places of a step of the second fit, its rate, and numbers in a row of weights.
FIT_PLACES = 1 << 14
FIT_RATE = 0.004
_PART = 4096
_FLUSH = 1 << 20


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _endings(w: W.Words) -> np.ndarray:
    """Class of each word among the endings."""
    last = w.data[w.end - 1].astype(np.int64)
    before = np.where(w.end - 2 >= w.start, w.data[np.maximum(w.end - 2, 0)], 0).astype(np.int64)
    return (last * 31 + before * 7) % ENDINGS


def corpus_counts(docs: DataFrame) -> DataFrame:
    """Written table (word hash, ending class, n) of all words of the corpus."""
    def run(batches):
        held, rows = [], 0

        def flush():
            words, ending, n = (np.concatenate(x) for x in zip(*held, strict=True))
            keys, first, which = np.unique(words, return_index=True, return_inverse=True)
            total = np.bincount(which, n).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ending[first].astype(np.int32)), pa.array(total)],
                                              ["word", "ending", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                w = W.split_words(part.column("text"), lower=True)
                keys, first, n = np.unique(W.word_hashes(w), return_index=True, return_counts=True)
                if len(keys):
                    held.append((keys, _endings(w)[first], n))
                    rows += len(keys)
                if rows > _FLUSH:
                    done = flush()
                    held, rows = [], 0
                    yield done
        if held:
            yield flush()

    parts = docs.select("text").mapInArrow(run, "word long, ending int, n long")
    return save(parts.groupBy("word", "ending").agg(F.sum("n").alias("n")), "word-counts")


def class_shape(distinct: int) -> tuple[int, int]:
    """Groups and classes in a group for a corpus of so many distinct words: classes grow with their cube root."""
    side = 4 * int(np.ceil(np.sqrt(10 * np.cbrt(distinct)) / 4))
    return max(GROUPS, side), max(PER_GROUP, side)


def vocabulary(counts: DataFrame, shape: tuple[int, int] = (GROUPS, PER_GROUP)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending hashes of the words that are classes, their classes, and the log of each ending class's count.

    What reaches the driver is at most a row per class.
    """
    known = shape[0] * shape[1] - ENDINGS
    found = counts.orderBy(F.desc("n"), "word").limit(known).collect()
    words = np.array([r["word"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(words)
    sizes = np.zeros(ENDINGS)
    for r in counts.groupBy("ending").agg(F.sum("n").alias("n")).collect():
        sizes[r["ending"]] = r["n"]
    for r in found:
        sizes[r["ending"]] -= r["n"]
    return words[order], order.astype(np.int64), np.log(np.maximum(sizes, 1))


def token_classes(w: W.Words, words: np.ndarray, shape: tuple[int, int] = (GROUPS, PER_GROUP)) -> np.ndarray:
    """Class of each word: its rank in the vocabulary, or its ending behind all ranks."""
    vocabulary_hashes, rank = words
    h, known = W.word_hashes(w), shape[0] * shape[1] - ENDINGS
    out = known + _endings(w)
    if len(vocabulary_hashes):
        at = np.minimum(np.searchsorted(vocabulary_hashes, h), len(vocabulary_hashes) - 1)
        hit = vocabulary_hashes[at] == h
        out[hit] = rank[at[hit]]
    return out


def contexts(classes: np.ndarray, first: np.ndarray, side: int = SIDE, edge: int = GROUPS * PER_GROUP) -> np.ndarray:
    """(token, 2 * side) classes around each token; ``edge``, the number of classes, stands outside a text."""
    begin = np.repeat(first[:-1], np.diff(first))
    end = np.repeat(first[1:], np.diff(first))
    at = np.arange(len(classes))
    out = np.full((len(classes), 2 * side), edge, np.int64)
    for k, step in enumerate([s for s in range(-side, side + 1) if s]):
        inside = (at + step >= begin) & (at + step < end)
        out[inside, k] = classes[(at + step)[inside]]
    return out


def start_weights(seed: int = 11, shape: tuple[int, int] = (GROUPS, PER_GROUP)) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    groups, per = shape
    sizes = {"t": (2 * SIDE, groups * per + 1, HIDDEN), "h": (HIDDEN,), "a": (HIDDEN, groups), "ac": (groups,),
             "b": (groups, HIDDEN, per), "bc": (groups, per)}
    return {k: (rng.normal(0, 0.1, s) if len(s) > 1 and k not in ("bc",) else np.zeros(s)).astype(np.float32)
            for k, s in sizes.items()}


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _by_group(target: np.ndarray, groups: int, per: int):
    group = (target // per).astype(np.int16)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(groups + 1))
    for g in range(groups):
        rows = order[cuts[g]: cuts[g + 1]]
        if len(rows):
            yield g, rows


def _sums(at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``x`` added up by their place ``at`` among ``n``."""
    out = np.zeros((n, x.shape[1]), x.dtype)
    if len(at):
        order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
        keys = at[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        out[keys[begin]] = np.add.reduceat(x[order], begin, axis=0)
    return out


def _hidden(w, around: np.ndarray) -> np.ndarray:
    x = w["t"][0].take(around[:, 0], axis=0)
    for k in range(1, around.shape[1]):
        x += w["t"][k].take(around[:, k], axis=0)
    x += w["h"]
    return x


def log_probabilities(w: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of each target class given the classes around it."""
    groups, per = w["bc"].shape
    h = _soft(_hidden(w, around))
    out = _log_softmax(h @ w["a"] + w["ac"])[np.arange(len(target)), target // per]
    for g, rows in _by_group(target, groups, per):
        inner = _log_softmax(h[rows] @ w["b"][g] + w["bc"][g])
        out[rows] += inner[np.arange(len(rows)), target[rows] % per]
    return out


def gradients(w: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-probability and its gradients."""
    n = len(target)
    groups, per = w["bc"].shape
    x = _hidden(w, around)
    h = _soft(x)
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    lp = _log_softmax(h @ w["a"] + w["ac"])
    loss = -lp[np.arange(n), target // per].sum()
    d = np.exp(lp)
    d[np.arange(n), target // per] -= 1
    d /= n
    grad["a"], grad["ac"] = h.T @ d, d.sum(axis=0)
    d_h = d @ w["a"].T
    for g, rows in _by_group(target, groups, per):
        lp = _log_softmax(h[rows] @ w["b"][g] + w["bc"][g])
        own = target[rows] % per
        loss -= lp[np.arange(len(rows)), own].sum()
        d = np.exp(lp)
        d[np.arange(len(rows)), own] -= 1
        d /= n
        grad["b"][g], grad["bc"][g] = h[rows].T @ d, d.sum(axis=0)
        d_h[rows] += d @ w["b"][g].T
    d_x = d_h / (1 + np.abs(x)) ** 2
    grad["h"] = d_x.sum(axis=0)
    for k in range(around.shape[1]):
        grad["t"][k] = _sums(around[:, k], d_x, w["t"].shape[1])
    return float(loss / n), grad


class _Steps:
    """Moments of the gradients, and steps along them that change the weights ``w``."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w, self.step = w, 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))

    def take(self, around: np.ndarray, target: np.ndarray, rate: float) -> None:
        _, grad = gradients(self.w, around, target)
        self.step += 1
        for k, w in self.w.items():
            self.first[k] = 0.9 * self.first[k] + 0.1 * grad[k]
            self.second[k] = 0.99 * self.second[k] + 0.01 * grad[k] ** 2
            w -= rate * (self.first[k] / (1 - 0.9 ** self.step)) / (np.sqrt(self.second[k] / (1 - 0.99 ** self.step)) + 1e-8)


def train(around: np.ndarray, target: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02,
          seed: int = 11, shape: tuple[int, int] = (GROUPS, PER_GROUP)) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = start_weights(seed, shape)
    if not len(target):
        return w
    fit = _Steps(w)
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(target), batch)
        fit.take(around[rows], target[rows], rate * min(1.0, 2 * (1 - step / (steps + 1))))
    return w


def fit(places: DataFrame, start: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], int]:
    """Weights fitted from ``start`` to every place of the table of :func:`encode`, and the number of places.

    A task steps through all places of its share once. Weights are averaged by the places behind them, a
    slice of the weights at a time, so that the driver gets one set of weights however many tasks there are.
    """
    edge = start["t"].shape[1] - 1

    def run(batches):
        steps, total = _Steps({k: v.copy() for k, v in start.items()}), 0
        for batch in batches:
            for classes, first in zip(batch.column("classes"), batch.column("first"), strict=True):
                classes, first = np.frombuffer(classes.as_buffer(), "<i4"), np.frombuffer(first.as_buffer(), "<i8")
                around, n = contexts(classes, first, edge=edge), -(-len(classes) // FIT_PLACES)
                total += len(classes)
                for k in range(n):
                    # Few places are a small step.
                    some = classes[k::n]
                    steps.take(around[k::n], some, FIT_RATE * min(1.0, len(some) / FIT_PLACES) / np.sqrt(1 + steps.step / 50))
        if total:
            flat = np.concatenate([steps.w[k].ravel() for k in sorted(start)])
            parts = [flat[k: k + _PART].tobytes() for k in range(0, len(flat), _PART)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(parts)), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(parts), pa.int32()),
                 pa.array([total] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["part", "task", "n", "raw"])

    def mean(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")
        n = group.column("n").to_numpy()
        out = 0.0
        for share, raw in zip(n / n.sum(), group.column("raw").to_pylist(), strict=True):
            out = out + share * np.frombuffer(raw, np.float32)
        return pa.table({"part": group.column("part")[:1], "n": pa.array([int(n.sum())]),
                         "raw": pa.array([out.astype(np.float32).tobytes()], pa.binary())})

    done = places.select("classes", "first").mapInArrow(run, "part int, task int, n long, raw binary")
    rows = sorted(done.groupBy("part").applyInArrow(mean, "part int, n long, raw binary").collect(), key=lambda r: r["part"])
    if not rows:
        return start, 0
    flat, at, out = np.frombuffer(b"".join(r["raw"] for r in rows), np.float32), 0, {}
    for k in sorted(start):
        out[k] = flat[at: at + start[k].size].reshape(start[k].shape)
        at += start[k].size
    return out, rows[0]["n"]


def _sample(docs: DataFrame, words, sample_docs: int, shape: tuple[int, int] = (GROUPS, PER_GROUP)) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and targets of at most SAMPLE_TOKENS places, spread evenly, of about ``sample_docs`` documents."""
    total = docs.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = W.split_words(part.column("text"), lower=True)
                classes = token_classes(w, words, shape)
                around = contexts(classes, w.first, edge=shape[0] * shape[1])
                size = w.count
                pick = [a + np.arange(min(n, SAMPLE_TOKENS)) * n // max(1, min(n, SAMPLE_TOKENS))
                        for a, n in zip(w.first[:-1].tolist(), size.tolist(), strict=True)]
                at = np.concatenate([*pick, np.zeros(0, np.int64)])
                raw = np.concatenate([around[at], classes[at, None]], axis=1).astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["raw"])

    some = docs.where(draw < min(1.0, sample_docs / max(1, total))).select("text").mapInArrow(run, "raw binary")
    rows = [np.frombuffer(r[0], "<i4").reshape(-1, 2 * SIDE + 1) for r in some.collect()]
    both = np.concatenate([*rows, np.zeros((0, 2 * SIDE + 1), np.int32)]).astype(np.int64)
    both = both[np.lexsort(both.T[::-1])]
    return both[:, :-1], both[:, -1]


_PLACES = "chunk long, ids array<long>, first binary, classes binary, keys binary, held binary, which binary"


def encode(docs: DataFrame, words, shape: tuple[int, int] = (GROUPS, PER_GROUP)) -> DataFrame:
    """Written table of chunks of documents as classes: the documents' ids, the first token of each and the number of
    tokens, the tokens' classes; the distinct words that are no class of their own, ascending, how often the
    chunk holds each, and which of them each such token is."""
    known = shape[0] * shape[1] - ENDINGS

    def run(batches):
        for batch in batches:
            rows = []
            for part in slices(batch, "text"):
                w = W.split_words(part.column("text"), lower=True)
                classes = token_classes(w, words, shape)
                keys, which, held = np.unique(W.word_hashes(w)[classes >= known], return_inverse=True, return_counts=True)
                rows.append((uuid.uuid4().int >> 65, part.column("doc_id").to_pylist(), w.first.astype("<i8").tobytes(),
                             classes.astype("<i4").tobytes(), keys.tobytes(), held.astype("<u4").tobytes(),
                             which.astype("<i4").tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             [f.split()[0] for f in _PLACES.split(", ")])

    return save(docs.mapInArrow(run, _PLACES), "places")


def _totals(keys: np.ndarray, holder: np.ndarray, held: np.ndarray) -> np.ndarray:
    """For each entry how often the corpus holds its word."""
    _, which = np.unique(keys, return_inverse=True)
    return np.bincount(which, held)[which]


def rare_counts(places: DataFrame) -> DataFrame:
    """(chunk, answers) with the corpus count of each of the chunk's words that are no class of their own."""
    buckets = max(64, places.count() // 4)

    def ask(batches):
        for batch in batches:
            for chunk, keys, held in zip(batch.column("chunk").to_pylist(), batch.column("keys"), batch.column("held"), strict=True):
                yield entry_batch(entries(chunk, np.frombuffer(keys.as_buffer(), np.uint64),
                                          [np.frombuffer(held.as_buffer(), "<u4")], buckets))

    asked = places.select("chunk", "keys", "held").mapInArrow(ask, "bucket int, chunk long, n int, blob binary")
    return exchange(asked, ["<u4"], _totals, "<i8")


def score(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_prob) of every document (doc_id, text); other columns are not read.

    Null and empty texts have no tokens, likelihood 0 and a null mean. Repeated rows are documents of their own, null
    doc_ids are kept, and an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = corpus_counts(docs)
    shape = class_shape(counts.count())
    hashes, rank, sizes = vocabulary(counts, shape)
    known = shape[0] * shape[1] - ENDINGS
    places = encode(docs, (hashes, rank), shape)
    weights, _ = fit(places, train(*_sample(docs, (hashes, rank), sample_docs, shape), shape=shape))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                first, classes, which = (np.frombuffer(batch.column(c)[i].as_buffer(), k)
                                         for c, k in (("first", "<i8"), ("classes", "<i4"), ("which", "<i4")))
                logs = np.zeros(len(classes))
                around = contexts(classes, first, edge=shape[0] * shape[1])
                for at in range(0, len(classes), 1 << 16):
                    rows = slice(at, at + (1 << 16))
                    logs[rows] = log_probabilities(weights, around[rows], classes[rows])
                rare = classes >= known
                if len(which):
                    count = joined_bits(batch.column("answers")[i].as_py(), "<i8")
                    logs[rare] += np.log(count)[which] - sizes[classes[rare] - known]
                n = np.diff(first)
                sums = np.bincount(np.repeat(np.arange(len(n)), n), logs, minlength=len(n))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(sums, pa.float64()),
                     pa.array(sums / np.maximum(n, 1), pa.float64(), mask=n == 0)],
                    ["doc_id", "n_tokens", "log_likelihood", "mean_log_prob"])

    found = places.select("chunk", "ids", "first", "classes", "which").join(rare_counts(places), "chunk", "left")
    return found.mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double, mean_log_prob double")

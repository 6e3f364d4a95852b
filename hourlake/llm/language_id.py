"""Language of whole texts by a bidirectional gated recurrent network over bytes, trained here in numpy.

Each position of a text gets the states of two gated networks, one read from the left and one from the right,
and from both a probability for every language; a text's probabilities are the means over its positions. Texts
are read in windows of WINDOW bytes that run side by side as rows of a matrix. The gates are x / (1 + |x|),
scaled to 0..1 where a gate needs it: bounded and smooth like the usual ones, and a few plain operations.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm import words as W
from hourlake.llm.chunks import few, save, slices, tidy

WINDOW = 64
HIDDEN = 8
#: The bounded sample that is learned from: so many documents per language and so many windows of each.
SAMPLE_DOCS = 300
SAMPLE_WINDOWS = 8
STEPS = 120
BATCH = 384
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of learning: crc32 of its id as text is 2 modulo 4. Null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def start_weights(languages: int, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {}
    for side in "fb":
        out["x" + side] = rng.normal(0, 0.3, (257, 3 * hidden))   # row 256 stands behind a text's end
        out["u" + side] = rng.normal(0, 0.6 / np.sqrt(hidden), (hidden, 3 * hidden))
        out["o" + side] = rng.normal(0, 0.3, (hidden, languages))
    out["c"] = np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in out.items()}


def _run(x: np.ndarray, u: np.ndarray, bytes_: np.ndarray, order, keep: bool):
    """States of one direction, (time, row, hidden); with ``keep`` also what the way back needs."""
    hidden = u.shape[0]
    steps, rows = bytes_.shape
    states = np.empty((steps, rows, hidden), np.float32)
    h, tape = np.zeros((rows, hidden), np.float32), {}
    for t in order:
        a = np.take(x, bytes_[t], axis=0)
        g = h @ u
        zr = a[:, :2 * hidden] + g[:, :2 * hidden]
        gate = _soft(zr)
        gate *= 0.5
        gate += 0.5
        z, r = gate[:, :hidden], gate[:, hidden:]
        n = a[:, 2 * hidden:] + r * g[:, 2 * hidden:]
        new = _soft(n)
        if keep:
            tape[t] = (h, zr, z, r, g[:, 2 * hidden:], n, new)
        h = new + z * (h - new)
        states[t] = h
    return states, tape


def _back(x, u, bytes_, order, tape, d_states, grad_x, grad_u) -> None:
    hidden = u.shape[0]
    carry = np.zeros_like(d_states[0])
    for t in reversed(order):
        h, zr, z, r, gn, n, new = tape[t]
        d = d_states[t] + carry
        d_new = d * (1 - z)
        d_z = d * (h - new)
        d_n = d_new / (1 + np.abs(n)) ** 2
        d_r = d_n * gn
        d_zr = np.concatenate([d_z, d_r], axis=1) * 0.5 / (1 + np.abs(zr)) ** 2
        d_g = np.concatenate([d_zr, d_n * r], axis=1)
        d_a = np.concatenate([d_zr, d_n], axis=1)
        grad_u += h.T @ d_g
        np.add.at(grad_x, bytes_[t], d_a)
        carry = d * z + d_g @ u.T


def probabilities(w: dict[str, np.ndarray], bytes_: np.ndarray, keep: bool = False):
    """Probability of each language at each position, (time, row, language); bytes are (time, row)."""
    ahead = range(len(bytes_))
    f, tape_f = _run(w["xf"], w["uf"], bytes_, ahead, keep)
    b, tape_b = _run(w["xb"], w["ub"], bytes_, ahead[::-1], keep)
    steps, rows, hidden = f.shape
    logits = f.reshape(-1, hidden) @ w["of"] + b.reshape(-1, hidden) @ w["ob"] + w["c"]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits.reshape(steps, rows, -1), f, b, tape_f, tape_b


def gradients(w: dict[str, np.ndarray], bytes_: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over the positions of all windows and its gradients, through time in both directions."""
    p, f, b, tape_f, tape_b = probabilities(w, bytes_, keep=True)
    steps, rows, _ = p.shape
    inside = (bytes_ < 256).astype(np.float32)
    total = inside.sum()
    at = np.arange(rows)
    loss = float(-(np.log(p[:, at, label] + 1e-12) * inside).sum() / total)
    d = p.copy()
    d[:, at, label] -= 1
    d *= inside[:, :, None] / total
    flat = d.reshape(-1, d.shape[2])
    hidden = f.shape[2]
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["of"], grad["ob"], grad["c"] = f.reshape(-1, hidden).T @ flat, b.reshape(-1, hidden).T @ flat, flat.sum(axis=0)
    ahead = range(steps)
    _back(w["xf"], w["uf"], bytes_, ahead, tape_f, (flat @ w["of"].T).reshape(f.shape), grad["xf"], grad["uf"])
    _back(w["xb"], w["ub"], bytes_, ahead[::-1], tape_b, (flat @ w["ob"].T).reshape(b.shape), grad["xb"], grad["ub"])
    return loss, grad


def train(windows: np.ndarray, label: np.ndarray, languages: int, hidden: int = HIDDEN, steps: int = STEPS,
          batch: int = BATCH, rate: float = 0.03, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights learned from windows (row, time) of bytes, 256 behind the end; every language is drawn alike often."""
    rng = np.random.default_rng(seed)
    w = start_weights(languages, hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    groups = [np.flatnonzero(label == k) for k in range(languages)]
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(g, -(-batch // languages)) for g in groups if len(g)])
        _, grad = gradients(w, np.ascontiguousarray(windows[rows].T), label[rows])
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        clip = min(1.0, 1.0 / (size + 1e-9))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in w:
            g = grad[k] * clip
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return w


def _windows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, (row, time), 256 behind the end, and the text of each row."""
    size = np.diff(offsets)
    count = -(-size // length)
    owner = np.repeat(np.arange(len(size)), count)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][owner] + step * length
    at = begin[:, None] + np.arange(length)
    behind = at >= offsets[1:][owner][:, None]
    out = data[np.minimum(at, max(len(data) - 1, 0))].astype(np.int16) if len(owner) else np.zeros((0, length), np.int16)
    out[behind] = 256
    return out, owner


def pooled(w: dict[str, np.ndarray], column: pa.Array, window: int = WINDOW, block: int = 2048) -> np.ndarray:
    """Mean probability of every language over all positions of each text; zeros for an empty one."""
    data, offsets = W.text_buffers(column)
    rows, owner = _windows(data, offsets, window)
    sums = np.zeros((len(column), len(w["c"])))
    for k in range(0, len(rows), block):
        bytes_ = np.ascontiguousarray(rows[k: k + block].T)
        p = probabilities(w, bytes_)[0]
        p *= (bytes_ < 256)[:, :, None]
        np.add.at(sums, owner[k: k + block], p.sum(axis=0, dtype=np.float64))
    return sums / np.maximum(np.diff(offsets), 1)[:, None]


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], dict[str, np.ndarray]]:
    """Languages and weights learned from a bounded sample of the labelled documents that are not held out.

    The sample is drawn by a hash of the document's id and text; it holds about ``sample_docs`` documents per language and
    SAMPLE_WINDOWS windows, spread evenly, of each, and every language that a label names. Texts without letters are not learned from.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    shares = save(usable.groupBy("lang").agg((F.lit(float(sample_docs)) / F.count(F.lit(1))).alias("share")), "languages")
    count = shares.count()
    if not count:
        return [], {}
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def cut(batches):
        for batch in batches:
            lang, rows = [], []
            for code, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not _LETTER.search(text):
                    continue
                raw = text.encode()
                last = max(0, len(raw) - WINDOW)
                for at in sorted({last * k // max(1, SAMPLE_WINDOWS - 1) for k in range(SAMPLE_WINDOWS)}):
                    lang.append(code)
                    rows.append(raw[at: at + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(rows, pa.binary())], ["lang", "bytes"])

    drawn = usable.join(few(shares), "lang").where(draw < F.col("share")).select("lang", "text").mapInArrow(tidy(cut), "lang string, bytes binary")
    most = 2 * sample_docs * SAMPLE_WINDOWS * count
    # The limit only backs the bound, of equal rows say; the draw stays far below it. In the order of a hash it
    # takes the same rows however they are dealt.
    found = sorted((r["lang"], bytes(r["bytes"])) for r in drawn.orderBy(F.xxhash64("lang", "bytes"), "lang", "bytes").limit(most).collect())
    if not found:
        return [], {}
    languages = sorted({x for x, _ in found})
    windows = np.full((len(found), WINDOW), 256, np.int16)
    for k, (_, raw) in enumerate(found):
        windows[k, :len(raw)] = np.frombuffer(raw, np.uint8)
    label = np.array([languages.index(x) for x, _ in found])
    return languages, train(windows, label, len(languages))


def predict(docs: DataFrame, languages: list[str], weights: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with the columns lang_pred and score, which replace columns of these names.

    ``und`` with score 0 for null texts, texts without a letter, and if nothing was learned.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    fields = [f for f in docs.schema.fields if f.name in names]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                if languages:
                    p = pooled(weights, part.column("text"))
                    best, score = np.argmax(p, axis=1), p.max(axis=1)
                has = [bool(languages) and t is not None and _LETTER.search(t) is not None for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names),
                     pa.array([languages[best[k]] if ok else UNKNOWN for k, ok in enumerate(has)], pa.string()),
                     pa.array([min(1.0, float(score[k])) if ok else 0.0 for k, ok in enumerate(has)], pa.float64())],
                    [*names, "lang_pred", "score"])

    schema = type(docs.schema)(fields).add("lang_pred", "string").add("score", "double")
    return docs.select(names).mapInArrow(tidy(run), schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document (doc_id, text, lang); other columns are not read.

    Repeated rows are documents of their own, null ids are not held out and not learned from, and an empty table
    gives no rows. If no document may be learned from, every text is ``und``.
    """
    languages, weights = learn(docs)
    found = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), languages, weights)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

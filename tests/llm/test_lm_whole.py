"""The language model takes the whole corpus: counts of rare words, classes and places."""

import math

import numpy as np

from hourlake.llm import lm_score


def test_rare_words_score_by_their_counts(spark):
    many = " ".join(f"k{j}" for j in range(1200))
    rows = [(k, many) for k in range(5)] + [(10, "aaxq"), (11, "aaxq aaxq"), (12, "bbxq"), (13, "aaxq"), (14, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in lm_score.score(docs).collect()}
    assert len(got) == len(rows) and got[14].log_likelihood == 0
    # Same place, same class: only the counts 4 and 1 differ.
    assert math.isclose(got[10].log_likelihood - got[12].log_likelihood, math.log(4), rel_tol=1e-6)


def test_fit_takes_every_place_and_classes_grow(spark):
    rows = [(k, " ".join(f"w{(k * j) % 50}" for j in range(300))) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashes, rank, _ = lm_score.vocabulary(lm_score.corpus_counts(docs))
    places = lm_score.encode(docs, (hashes, rank))
    start = lm_score.start_weights()
    weights, n = lm_score.fit(places, start)
    assert n == 120 * 300 and {k: v.shape for k, v in weights.items()} == {k: v.shape for k, v in start.items()}
    classes = np.concatenate([np.frombuffer(r.classes, "<i4") for r in places.collect()]).astype(np.int64)
    around = np.full((len(classes), 2 * lm_score.SIDE), 1024)
    assert lm_score.gradients(weights, around, classes)[0] < lm_score.gradients(start, around, classes)[0]
    shapes = [lm_score.class_shape(x) for x in (0, 10**5, 10**7, 10**9)]
    assert shapes[0] == shapes[1] == (32, 32) and shapes[1] < shapes[2] < shapes[3]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in lm_score.start_weights(shape=(36, 36)).items()}
    x, y = rng.integers(0, 36 * 36 + 1, (60, 4)), rng.integers(0, 36 * 36, 60)
    _, grad = lm_score.gradients(w, x, y)
    for k in w:
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        ends = []
        for step in (1e-4, -1e-4):
            moved = {n: v.copy() for n, v in w.items()}
            moved[k][at] += step
            ends.append(lm_score.gradients(moved, x, y)[0])
        assert math.isclose((ends[0] - ends[1]) / 2e-4, grad[k][at], rel_tol=0.01, abs_tol=1e-6)

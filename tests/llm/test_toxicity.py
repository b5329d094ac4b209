import random

import numpy as np
import pytest

from voltlens.llm import toxicity

CLEAN = [a + b for a in ("ka", "lo", "mi", "ren", "du") for b in ("tu", "sa", "vel", "on", "e")]
RUDE = ["vilkat", "grumo", "vilkon", "spezzo"]


def text(rng, grade):
    words = [rng.choice(CLEAN) for _ in range(rng.randint(20, 90))]
    for _ in range((0, 2, 9)[grade]):
        words.insert(rng.randrange(len(words)), rng.choice(RUDE))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    return [(i, text(rng, g), g) for i in range(900) for g in [rng.choice([0, 0, 0, 1, 2])]]


def test_gradient():
    """Fitted probabilities are calibrated and ordered; numeric check of the loss at the fit."""
    rng = np.random.default_rng(2)
    n = 1500
    x = rng.integers(0, 2, (n, 3)).astype(float)
    z = x @ [2.0, -1.0, 0.0]
    grades = (z + rng.logistic(size=n) > 0.5).astype(int) + (z + rng.logistic(size=n) > 9).astype(int) * 0
    grades = np.digitize(z + rng.logistic(size=n), [0.5, 2.5])
    rows = [(np.flatnonzero(r), r[r > 0]) for r in x]
    m = toxicity.fit_weights(rows, grades, np.ones(n), l1=0.0, steps=800, raising_only=False)
    w = np.array([m.weights.get(j, 0.0) for j in range(3)])
    assert np.abs(w - [2, -1, 0]).max() < 0.35 and np.abs(m.thresholds - [0.5, 2.5]).max() < 0.35

    def loss(w, t):
        p = np.concatenate([np.ones((n, 1)), toxicity.sigmoid((x @ w)[:, None] - t[None, :]), np.zeros((n, 1))], 1)
        i = np.arange(n)
        return -np.log(p[i, grades] - p[i, grades + 1]).mean()

    at = loss(w, m.thresholds)
    for j in range(3):
        for s in (-0.05, 0.05):
            assert loss(w + s * np.eye(3)[j], m.thresholds) > at - 1e-4


def test_held_out_grades(spark, frame, corpus):
    docs = frame([(i, t) for i, t, _ in corpus])
    labels = spark.createDataFrame([(i, g) for i, _, g in corpus if i % 3], "doc_id long, grade int")
    model = toxicity.fit(docs, labels, "grade", fit_rows=200)
    assert model.thresholds[0] < model.thresholds[1]
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(rows[i], g) for i, _, g in corpus if i % 3 == 0]
    assert np.mean([r.toxic == (g > 0) for r, g in held]) > 0.97
    assert np.mean([r.grade == g for r, g in held]) > 0.9
    low, mid, high = (np.mean([r.expected_severity for r, g in held if g == k]) for k in range(3))
    assert low < 0.1 < mid < high <= 2


def test_binary_labels_are_split(spark, frame, corpus):
    docs = frame([(i, t) for i, t, _ in corpus])
    labels = spark.createDataFrame([(i, int(g > 0)) for i, _, g in corpus], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "toxic", fit_rows=300, split_positives=2)
    assert len(model.thresholds) == 2
    rows = {r.doc_id: r for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    assert np.mean([rows[i].toxic == (g > 0) for i, _, g in corpus]) > 0.97


def test_edges(spark, frame, edge, corpus):
    none = toxicity.fit(edge, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, grade int"), "grade")
    assert [r.grade for r in toxicity.score(edge, none).collect()] == [0] * edge.count()
    single = toxicity.fit(edge, spark.createDataFrame([(4, 0), (5, 0)], "doc_id long, grade int"), "grade")
    assert not any(r.toxic for r in toxicity.score(edge, single).collect())
    model = toxicity.Model({toxicity.word_features("vilkat")[0]: 9.0}, [2.0, 5.0])
    out = toxicity.score(frame([(1, None), (2, ""), (3, "Vilkat!"), (3, "Vilkat!")]), model)
    rows = sorted(((r.doc_id, r.grade, r.toxic) for r in out.select("doc_id", "grade", "toxic").collect()))
    assert rows == [(1, 0, False), (2, 0, False), (3, 2, True), (3, 2, True)]
    assert toxicity.score(frame([]), model).count() == 0


def test_sampling_rate_of_any_table_size():
    for rows in (1501, 10 ** 6, 10 ** 12, 10 ** 15):
        share = (toxicity.hash_below(1500, rows) + 2 ** 63) / 2 ** 64
        assert abs(share * rows - 1500) < 1e-2
    assert toxicity.hash_below(1500, 1500) == 2 ** 63 - 1

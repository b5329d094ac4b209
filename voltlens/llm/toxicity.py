"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade >= k | x) = sigmoid(w.x - t_k) for k = 1..K with ordered thresholds t_1 < t_2 < ...
and one weight vector shared by all of them. Features are words and word stems (the first
four and five letters), hashed; a feature's value is the sum of log(1 + count) over
the distinct words of the text that carry it, so a text's score is a sum over its
distinct words. The weights are fitted with an L1 penalty (proximal steps with per-feature
step sizes) and kept at zero or above, which leaves only features that carry severity. Output: the expected
severity sum_k P(grade >= k), the most probable grade and ``toxic`` (P(grade >= 1) >= 0.5).

The fit takes a bounded sample of the labelled rows: about ``fit_rows`` of each grade,
drawn by a hash of the id and weighted back to the labels' shares. Scoring reads every
whole text; only non-zero weights are sent to the tasks.

Cases: null text and text without words have no features and get the bare thresholds'
probabilities; rows without a grade are not learned from; with a single grade or none
everything gets that grade (0 when none); a document labelled twice counts twice; repeated
rows score alike; an empty table gives no rows; extra columns are carried, those named
like a result column are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from voltlens.llm.common import annotate, pick

HASH_BITS = 20
WORD = re.compile(r"[^\W\d_]+")
#: Distinct words whose weight a task keeps.
KEPT_WORDS = 400_000


def word_features(word: str) -> list[int]:
    forms = [word] + [f"{word[:n]}-" for n in (4, 5) if len(word) > n]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1) for f in forms]


def features(text: str | None) -> tuple[list[int], list[float]]:
    x: Counter = Counter()
    for word, n in Counter(WORD.findall((text or "").lower())).items():
        for f in word_features(word):
            x[f] += float(np.log1p(n))
    return list(x.keys()), list(x.values())


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    def __init__(self, weights: dict[int, float], thresholds: list[float]):
        self.weights, self.thresholds = weights, np.array(thresholds, float)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K: texts x K."""
        return sigmoid(np.asarray(score, float)[:, None] - self.thresholds[None, :])


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, weight: np.ndarray, l1: float = 5e-5,
                steps: int = 250, least_texts: int = 5, raising_only: bool = True) -> Model:
    """Proximal gradient with per-feature step sizes on the weighted log-likelihood.

    ``raising_only`` keeps the weights at zero or above: a feature may raise the severity,
    and no amount of harmless words in a long text outweighs the harmful ones."""
    top = int(grades.max(initial=0))
    if top == 0:
        return Model({}, [])
    at = np.concatenate([np.asarray(r[0], np.int64) for r in rows])
    value = np.concatenate([np.asarray(r[1]) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    seen, place, n = np.unique(at, return_inverse=True, return_counts=True)
    often = n >= least_texts
    keep = often[place]
    new = np.cumsum(often) - 1
    col, value, row, names = new[place[keep]], value[keep], row[keep], seen[often]
    weight = weight / weight.sum()
    w = np.zeros(len(names))
    # thresholds: the first, then positive gaps on a log scale
    share = np.array([(weight * (grades >= k)).sum() for k in range(1, top + 1)]).clip(1e-6, 1 - 1e-6)
    base = -np.log(share / (1 - share))
    free = np.concatenate([base[:1], np.log(np.maximum(np.diff(base), 1e-2))])
    seen_sq, free_sq = np.full(len(w), 1e-8), np.full(top, 1e-8)
    for _ in range(steps):
        t = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        z = np.bincount(row, weights=value * w[col], minlength=len(rows))
        s = np.concatenate([np.ones((len(rows), 1)), sigmoid(z[:, None] - t[None, :]), np.zeros((len(rows), 1))], 1)
        i = np.arange(len(rows))
        hi, lo = s[i, grades], s[i, grades + 1]
        p = np.maximum(hi - lo, 1e-9)
        slope_hi, slope_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        dz = -weight * (slope_hi - slope_lo)
        dt = np.zeros(top)
        for k in range(1, top + 1):  # t_k lowers P(grade >= k)
            dt[k - 1] = (weight * ((grades == k) * slope_hi - (grades == k - 1) * slope_lo)).sum()
        after = np.cumsum(dt[::-1])[::-1]
        d_free = np.concatenate([after[:1], after[1:] * np.exp(free[1:])])
        grad = np.bincount(col, weights=value * dz[row], minlength=len(w))
        seen_sq += grad ** 2
        free_sq += d_free ** 2
        step = 0.5 / np.sqrt(seen_sq)
        w = w - step * grad
        w = np.maximum(w - step * l1, 0) if raising_only else np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        free = free - 0.2 * d_free / np.sqrt(free_sq)
    t = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    return Model({int(f): float(x) for f, x in zip(names, w) if x != 0}, t.tolist())


def hash_below(wanted: int, rows: int) -> int:
    """Bound up to which a signed 64-bit hash lies for about ``wanted`` of ``rows`` rows, at any number of rows."""
    return (wanted << 64) // rows - (1 << 63) if wanted < rows else (1 << 63) - 1


def fit(docs: DataFrame, labels: DataFrame, grade_col: str, id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = 1500, split_positives: int = 1) -> Model:
    """Fit on about ``fit_rows`` labelled rows of each grade (grades 0..K).

    Labels that say whether but not how much (0 and 1) can be refined: with
    ``split_positives`` = n > 1 the positives of the sample are cut at quantiles of a
    first fit's score per unit of feature mass into grades 1..n, then fitted again."""
    graded = pick(labels, {"doc_id": id_col, "grade": grade_col}).where(
        F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
    sizes = {r.grade: r.n for r in graded.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    bound = F.lit(None).cast("long")
    for g, n in sizes.items():
        bound = F.when(F.col("grade") == g, F.lit(hash_below(fit_rows, n)).cast("long")).otherwise(bound)
    sample = graded.where(F.xxhash64(F.lit(9), "doc_id") <= bound)
    texts = pick(docs, {"doc_id": id_col, "text": text_col})
    rows = texts.join(F.broadcast(sample), "doc_id")  # the sample is bounded by fit_rows a grade
    fields = [T.StructField("f", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.FloatType()))]

    def make():
        return lambda texts: [list(c) for c in zip(*map(features, texts))] if texts else [[], []]

    got = annotate(rows, "text", fields, make, keep=["grade"]).toArrow()
    grades = np.array(got.column("grade").to_pylist(), np.int64)
    if not len(grades):
        return Model({}, [])
    kept = [(f.values.to_numpy(), x.values.to_numpy()) for f, x in zip(got.column("f"), got.column("x"))]
    n = Counter(grades.tolist())
    weight = np.array([sizes[g] / n[g] for g in grades.tolist()])
    model = fit_weights(kept, grades, weight)
    if split_positives > 1 and grades.max() == 1:
        table = np.zeros(1 << HASH_BITS)
        table[list(model.weights)] = list(model.weights.values())
        density = np.array([(table[f] * x).sum() / max(x.sum(), 1e-9) for f, x in kept])
        cuts = np.quantile(density[grades == 1], np.arange(1, split_positives) / split_positives)
        model = fit_weights(kept, np.where(grades == 1, 1 + np.searchsorted(cuts, density), 0), weight)
    return model


FIELDS = [T.StructField("expected_severity", T.DoubleType()), T.StructField("grade", T.IntegerType()),
          T.StructField("p_toxic", T.DoubleType()), T.StructField("toxic", T.BooleanType())]


def score(docs: DataFrame, model: Model, text_col: str = "text", keep=None) -> DataFrame:
    """Append ``expected_severity``, ``grade``, ``p_toxic`` and ``toxic``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted, known = sent.value, {}

        def word_weight(word: str) -> float:
            got = known.get(word)
            if got is None:
                if len(known) >= KEPT_WORDS:
                    known.clear()
                got = known[word] = sum(fitted.weights.get(f, 0.0) for f in word_features(word))
            return got

        def one(text):
            total = 0.0
            for word, n in Counter(WORD.findall((text or "").lower())).items():
                w = word_weight(word)
                if w:
                    total += w * float(np.log1p(n))
            return total

        def work(texts):
            p = fitted.at_least(np.array([one(t) for t in texts]))
            if not p.shape[1]:
                return [[0.0] * len(texts), [0] * len(texts), [0.0] * len(texts), [False] * len(texts)]
            edges = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
            return [p.sum(axis=1).tolist(), np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).tolist(),
                    p[:, 0].tolist(), (p[:, 0] >= 0.5).tolist()]

        return work

    return annotate(docs, text_col, FIELDS, make, keep)

"""k-nearest-neighbour classifier and its k grid (M7, M9).

The labelled rows a model holds are bounded by the documented parameter
``max_rows`` (beyond it a sample by a hash of the row's key); within it the
neighbours are exact. The model's rows go to the tasks as arrays of known
size; scored rows pass through vectorised distance steps, batch by batch, so
no table of pairs exists. Votes are weighted by 1 / distance; rows at distance
zero, if there are any among the neighbours, vote alone. Neighbours at one
distance are taken by key order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlens.functions.schema import q

#: Scored rows handled at once: rows x ``max_rows`` distances exist meanwhile.
STEP = 256


@dataclass
class KnnModel:
    features: list
    x: np.ndarray        # rows x features, in key order
    y: np.ndarray        # class positions
    classes: list
    fold: np.ndarray     # fold of every row; -1: none

    def probabilities(self, rows: np.ndarray, ks: list[int], fold: np.ndarray | None = None) -> np.ndarray:
        """rows x ks x classes. With ``fold``, a row's neighbours come from the other folds."""
        out = np.full((len(rows), len(ks), len(self.classes)), np.nan)
        most = max(ks)
        for a in range(0, len(rows), STEP):
            part = rows[a:a + STEP]
            dist = np.zeros((len(part), len(self.x)))
            for j in range(part.shape[1]):
                diff = part[:, j, None] - self.x[None, :, j]
                dist += diff * diff
            dist = np.sqrt(dist)
            if fold is not None:
                dist[fold[a:a + STEP, None] == self.fold[None, :]] = np.inf
            near = np.argsort(dist, axis=1, kind="stable")[:, :most]
            d = np.take_along_axis(dist, near, axis=1)
            weight = np.where(np.isinf(d), 0.0, 1 / np.where(d == 0, 1.0, d))
            weight = np.where((d == 0).any(axis=1)[:, None], (d == 0) * 1.0, weight)
            votes = weight[:, :, None] * (self.y[near][:, :, None] == np.arange(len(self.classes)))
            running = np.cumsum(votes, axis=1)
            for i, k in enumerate(ks):
                got = running[:, min(k, running.shape[1]) - 1]
                out[a:a + STEP, i] = got / got.sum(axis=1, keepdims=True)
        return out


def hash_below(wanted: int, rows: int) -> int:
    """Bound under which a signed 64-bit hash falls for about ``wanted`` of ``rows`` rows, at any number of rows."""
    return (wanted << 64) // rows - (1 << 63) if wanted < rows else (1 << 63) - 1


def fit(df: DataFrame, features, label: str, key, max_rows: int = 20_000, fold: str | None = None,
        seed: int = 42) -> KnnModel:
    """M7 fit: the labelled rows (all up to ``max_rows``, else about that many by a hash of
    ``key``) in key order. Rows with a missing feature or label are left out."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.select(*[F.col(q(c)).cast("double").alias(f"f{i}") for i, c in enumerate(features)],
                     F.col(q(label)).alias("y"), *[F.col(q(k)).alias(f"k{i}") for i, k in enumerate(keys)],
                     (F.col(q(fold)) if fold else F.lit(-1)).cast("int").alias("fold"))
    rows = rows.where(usable([f"f{i}" for i in range(len(features))]) & F.col("y").isNotNull())
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.xxhash64(F.lit(seed), *[f"k{i}" for i in range(len(keys))]) < hash_below(max_rows, n))
    got = rows.orderBy(*[f"k{i}" for i in range(len(keys))]).collect()
    classes = sorted({r.y for r in got})
    place = {c: i for i, c in enumerate(classes)}
    x = np.array([[r[f"f{i}"] for i in range(len(features))] for r in got]).reshape(len(got), len(features))
    return KnnModel(list(features), x, np.array([place[r.y] for r in got], np.int64), classes,
                    np.array([r.fold for r in got], np.int64))


def usable(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(q(c)).isNotNull() & ~F.isnan(F.col(q(c)).cast("double"))
    return cond


def score(df: DataFrame, model: KnnModel, ks, carry, fold: str | None = None) -> DataFrame:
    """(carried columns..., k, p array<double>) for every usable row and every k."""
    carry = list(carry)
    rows = df.where(usable(model.features)).select(
        *[F.col(q(c)).alias(f"c{i}") for i, c in enumerate(carry)], (F.col(q(fold)) if fold else F.lit(-2)).cast("int").alias("fold"),
        F.array(*[F.col(q(c)).cast("double") for c in model.features]).alias("x"))
    n, ks = len(carry), list(ks)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(n + 1).to_pylist(), float)
            p = fitted.probabilities(x, ks, batch.column(n).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(p.tolist(), pa.list_(pa.list_(pa.float64())))],
                                             names=[*(f"c{i}" for i in range(n)), "p"])

    schema = T.StructType([*rows.schema.fields[:n], T.StructField("p", T.ArrayType(T.ArrayType(T.DoubleType())))])
    out = rows.mapInArrow(run, schema)
    each = out.select(*(f"c{i}" for i in range(n)), F.posexplode("p").alias("i", "p"))
    return each.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
                       F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("i") + 1).alias("k"), "p")


def predict(df: DataFrame, model: KnnModel, k: int, carry) -> DataFrame:
    """M7: carried columns, one ``p_<class>`` per class and ``pred`` (first class of the largest)."""
    out = score(df, model, [k], carry)
    probs = [F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(model.classes)]
    best = F.array_position("p", F.array_max("p")).cast("int")
    labels = F.array(*[F.lit(c) for c in model.classes])
    return out.select(*[q(c) for c in carry], *probs, F.element_at(labels, best).alias("pred"))


def grid(df: DataFrame, features, label: str, fold: str, key, ks=range(3, 50, 2), max_rows: int = 20_000) -> DataFrame:
    """M9: (k, auc): support-weighted one-vs-rest AUC of every k, averaged over the folds.
    Neighbours are ranked once, at the largest k."""
    from voltlens.operators.metrics import auc

    model = fit(df, features, label, key, max_rows, fold)
    scored = score(df.where(F.col(q(label)).isNotNull()), model, ks, [label, fold], fold)
    # probabilities are compared at nine digits: sums in another order tie the same way
    long = scored.select("k", F.col(q(fold)).alias("fold"), F.col(q(label)).alias("y0"), F.posexplode("p").alias("i", "p"))
    labels = F.array(*[F.lit(c) for c in model.classes])
    long = long.select("k", "fold", "i", (F.col("y0") == F.element_at(labels, F.col("i") + 1)).cast("int").alias("y"),
                       F.round("p", 9).alias("p"))
    per = auc(long, "y", "p", by=["k", "fold", "i"])
    folds = per.groupBy("k", "fold").agg((F.sum(F.col("auc") * F.col("positives")) / F.sum("positives")).alias("a"))
    return folds.groupBy("k").agg(F.avg("a").alias("auc"))


def best_k(scores: DataFrame) -> int:
    """The k of the highest AUC, the smallest on ties."""
    return scores.orderBy(F.desc("auc"), "k").first()["k"]

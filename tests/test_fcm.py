"""Fuzzy c-means against a NumPy implementation of the same updates."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltlens.operators import fcm


def numpy_fcm(X, U0, m, iters):
    U = U0.copy()
    C = (U ** m).T @ X / (U ** m).sum(axis=0)[:, None]
    for _ in range(iters - 1):
        d2 = ((X[:, None, :] - C[None, :, :]) ** 2).sum(axis=2)
        U = 1.0 / ((d2[:, :, None] / d2[:, None, :]) ** (1 / (m - 1))).sum(axis=2)
        C = (U ** m).T @ X / (U ** m).sum(axis=0)[:, None]
    return C


@pytest.mark.parametrize("m", [2.0, 1.5])
def test_centres_match_numpy(spark, m):
    rng = np.random.default_rng(7)
    n, d, K = 300, 3, 3
    X = np.vstack([rng.normal(c, 0.5, size=(n // 3, d)) for c in (0, 3, 6)])
    W = rng.uniform(1, 10, size=(n, K))
    pdf = pd.DataFrame(X, columns=[f"f{j}" for j in range(d)])
    for k in range(K):
        pdf[f"w{k}"] = W[:, k]
    pdf["zone"] = "z"
    df = spark.createDataFrame(pdf)
    model = fcm.fit(df, "zone", d, K=K, m=m, max_iter=8, tol=0.0, init=[F.col(f"w{k}") for k in range(K)])
    C = numpy_fcm(X, W / W.sum(axis=1, keepdims=True), m, 8)
    got = np.array(model.centres["z"])
    exp = np.array(sorted(C.tolist()))
    assert np.abs(got - exp).max() < 1e-9


def test_memberships_sum_to_one_and_zero_distance(spark):
    model = fcm.FcmModel("zone", 2, 2, 2.0, {"z": [[0.0, 0.0], [1.0, 1.0]]}, 1)
    df = spark.createDataFrame([("z", 0.0, 0.0), ("z", 0.3, 0.9), ("y", 1.0, 1.0)], "zone string, f0 double, f1 double")
    out = fcm.predict(df, model).collect()
    assert len(out) == 2  # zone without a model is dropped
    for r in out:
        assert abs(r.cluster_0 + r.cluster_1 - 1) < 1e-12
    on_centre = [r for r in out if r.f0 == 0.0][0]
    assert on_centre.cluster_0 == 1.0 and on_centre.cluster_id == 0


def test_silhouette_sq_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(60, 2))
    lab = rng.integers(0, 3, 60)
    lab[0] = 2
    pdf = pd.DataFrame({"zone": "z", "f0": X[:, 0], "f1": X[:, 1], "cluster_id": lab})
    got = fcm.silhouette_sq(spark.createDataFrame(pdf), "zone", 2, 3).first()["silhouette"]
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2)
    s = []
    for i in range(60):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(got - np.mean(s)) < 1e-9


def test_partition_scores(spark):
    model = fcm.FcmModel("zone", 2, 1, 2.0, {"z": [[0.0], [2.0]]}, 1)
    df = spark.createDataFrame([("z", 1.0)], "zone string, f0 double")
    r = fcm.partition_scores(fcm.predict(df, model), model).first()
    assert abs(r.PC - 0.5) < 1e-12 and abs(r.PEC - np.log(2)) < 1e-12


def test_convergence_is_reported_and_centres_are_a_fixed_point(spark):
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(c, 0.3, size=(40, 2)) for c in (0, 4, 9)])
    pdf = pd.DataFrame(X, columns=["f0", "f1"]).assign(zone="z")
    df = spark.createDataFrame(pdf)
    short = fcm.fit(df, "zone", 2, max_iter=2, tol=1e-8)
    assert short.converged is False and short.shift > 1e-8
    model = fcm.fit(df, "zone", 2, max_iter=150, tol=1e-8)
    assert model.converged is True and model.shift < 1e-8 and model.iterations < 150
    C = np.array(model.centres["z"])
    d2 = ((X[:, None, :] - C[None, :, :]) ** 2).sum(axis=2)
    U = 1.0 / (d2[:, :, None] / d2[:, None, :]).sum(axis=2)
    again = (U ** 2).T @ X / (U ** 2).sum(axis=0)[:, None]
    assert np.abs(again - C).max() < 1e-7

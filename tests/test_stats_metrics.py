"""Rank statistics, AUC, quantiles and calibration against brute force."""

import numpy as np
import pandas as pd

from voltlens.operators import metrics as MT
from voltlens.operators import stats as ST
from voltlens.operators.profile import exact_quantiles


def _df(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


def test_kendall_tau_b_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(1, 6, 200)
    y = np.round(rng.normal(size=200) + 0.3 * x, 1)
    got = ST.kendall_tau_b(_df(spark, x=x, y=y), "x", "y", [1, 2, 3, 4, 5]).first()["tau_b"]
    s = 0
    for i in range(200):
        s += (np.sign(x[i] - x[i + 1:]) * np.sign(y[i] - y[i + 1:])).sum()
    n0 = 200 * 199 / 2
    n1 = sum(c * (c - 1) / 2 for c in np.unique(x, return_counts=True)[1])
    n2 = sum(c * (c - 1) / 2 for c in np.unique(y, return_counts=True)[1])
    assert abs(got - s / np.sqrt((n0 - n1) * (n0 - n2))) < 1e-12


def test_spearman_with_ties(spark):
    x = np.array([1, 2, 2, 3, 4, 4, 4, 5], dtype=float)
    y = np.array([2, 1, 4, 3, 6, 5, 5, 7], dtype=float)
    got = ST.spearman(_df(spark, x=x, y=y), "x", "y").first()["rho"]
    rx = pd.Series(x).rank().values
    ry = pd.Series(y).rank().values
    assert abs(got - np.corrcoef(rx, ry)[0, 1]) < 1e-12


def test_auc_rank_sum(spark):
    y = np.array([0, 0, 1, 1, 0, 1, 1, 0])
    s = np.array([0.1, 0.4, 0.35, 0.8, 0.4, 0.4, 0.9, 0.2])
    got = MT.auc(_df(spark, y=y, s=s), "y", "s").first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    exp = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert abs(got - exp) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    v = np.random.default_rng(2).integers(0, 50, 101).astype(float)
    r = exact_quantiles(_df(spark, v=v), "v", [0.1, 0.25, 0.5, 0.95]).first()
    for p, c in [(0.1, "q_0_1"), (0.25, "q_0_25"), (0.5, "q_0_5"), (0.95, "q_0_95")]:
        assert abs(r[c] - np.percentile(v, p * 100)) < 1e-12


def test_calibration_bins(spark):
    rng = np.random.default_rng(9)
    p = rng.uniform(size=200)
    y = (rng.uniform(size=200) < p).astype(int)
    got = MT.calibration(_df(spark, y=y, p=p), "y", "p", 10).toPandas().sort_values("bin")
    edges = np.percentile(p, np.linspace(0, 100, 11))
    ids = np.searchsorted(edges[1:-1], p)
    exp = pd.DataFrame({"bin": ids, "y": y, "p": p}).groupby("bin").mean()
    assert np.allclose(got["prob_true"].values, exp["y"].values)
    assert np.allclose(got["prob_pred"].values, exp["p"].values)


def test_per_class_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    pc = {r["class"]: r for r in MT.per_class(df, "y", "p").collect()}
    assert pc[2].precision == 0.0 and pc[2].recall == 0.0 and pc[2].f1 == 0.0
    assert abs(pc[1].precision - 1 / 3) < 1e-12


def test_pvalues(spark):
    import math

    def p3(r):  # closed form of the two-sided t p-value for 3 degrees of freedom
        t = r * math.sqrt(3 / (1 - r * r))
        x = t / math.sqrt(3)
        return 1 - 2 / math.pi * (math.atan(x) + x / (1 + x * x))

    big = 10**11
    r_big = 1.96 / math.sqrt(big - 2 + 1.96**2)
    rows = [(0.6, 5, p3(0.6)), (0.0, 5, 1.0), (1.0, 9, 0.0), (-1.0, 9, 0.0), (0.3, 2, None), (None, 9, None),
            (r_big, big, 0.04999579029),  # the normal limit: 2 (1 - Phi(1.96))
            (0.5, 3, 2 / math.pi * math.acos(0.5)),  # one degree of freedom
            (-0.2, 4, 0.8)]  # two degrees: 1 - |r|
    got = ST.with_pvalues(spark.createDataFrame([r[:2] for r in rows], "rho double, n long")).collect()
    for (_, _, want), g in zip(rows, got):
        assert (g.p_value is None) == (want is None)
        assert want is None or abs(g.p_value - want) < 1e-9
        assert g.significant == (want is not None and want < 0.05)


def test_box_stats_and_grouped_quantiles(spark):
    rng = np.random.default_rng(11)
    g = rng.integers(0, 3, 300)
    v = np.round(rng.normal(size=300) * 10, 1)
    v[:3] = [500.0, -400.0, 300.0]
    got = {r.g: r for r in ST.box_stats(_df(spark, g=g, v=v), "v", by="g").collect()}
    for k in range(3):
        x = v[g == k]
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        iqr = q3 - q1
        inside = x[(x >= q1 - 1.5 * iqr) & (x <= q3 + 1.5 * iqr)]
        r = got[k]
        assert abs(r.q1 - q1) < 1e-9 and abs(r.median - med) < 1e-9 and abs(r.q3 - q3) < 1e-9
        assert r.whisker_low == inside.min() and r.whisker_high == inside.max()
        assert r.outliers == len(x) - len(inside)


def test_curve_multi_range_matches_single(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 400)
    s = rng.integers(0, 150, 400).astype(float)
    df = _df(spark, y=y, s=s)
    single = None
    for partitions in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = sorted(tuple(r) for r in MT.curve(df, "y", "s").collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert single is None or got == single
        single = got

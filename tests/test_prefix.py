"""Ranged running sums against pandas, and independence of the number of ranges."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from voltlens.operators.prefix import dense_codes, row_rank, running_sum


def test_running_sum_many_ranges_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "k": rng.permutation(500).astype(float),
                        "x": rng.integers(0, 10, 500)})
    df = spark.createDataFrame(pdf)
    out = running_sum(df, ["k"], ["x"], by=["g"], ranges=14).toPandas()
    exp = pdf.sort_values(["g", "k"]).assign(x_cum=lambda d: d.groupby("g")["x"].cumsum())
    m = out.merge(exp, on=["g", "k", "x"], suffixes=("", "_e"))
    assert len(m) == 500
    assert (m["x_cum"] == m["x_cum_e"]).all()


def test_running_sum_descending_global(spark):
    pdf = pd.DataFrame({"k": np.arange(300, dtype=float), "x": np.ones(300, dtype=int)})
    out = running_sum(spark.createDataFrame(pdf), ["k"], ["x"], descending=True, ranges=6).toPandas()
    out = out.sort_values("k")
    assert list(out["x_cum"]) == list(range(300, 0, -1))


def test_row_rank_ties_broken_by_second_column(spark):
    pdf = pd.DataFrame({"k": [1.0, 1.0, 2.0, 0.5], "t": [2, 1, 0, 9]})
    out = row_rank(spark.createDataFrame(pdf), ["k", "t"], name="r", ranges=4).toPandas()
    assert dict(zip(zip(out.k, out.t), out.r)) == {(0.5, 9): 1, (1.0, 1): 2, (1.0, 2): 3, (2.0, 0): 4}


def test_dense_codes_text_sorted_bytes(spark):
    vals = ["b", "a", "ab", "B", "é", "a", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = {r["v"]: r["code"] for r in dense_codes(df, "v", ranges=4).collect()}
    assert out == {v: i for i, v in enumerate(sorted({x for x in vals if x}, key=lambda s: s.encode()))}


def test_number_of_ranges_never_changes_the_result(spark):
    """NULL keys last, NaN the largest number, NULL groups a group of their own."""
    rows = [(g, k, i) for g in ("a", "b", None) for i, k in enumerate(
        [None, float("nan"), -1.0, 0.0, 2.5, float("inf"), float("-inf"), 1e-300])]
    df = spark.createDataFrame(rows, "g string, k double, x int")
    for descending in (False, True):
        one, many = ([tuple(map(str, r)) for r in running_sum(df, ["k"], ["x"], by=["g"], descending=descending,
                                                               ranges=n, totals=True).collect()] for n in (1, 9))
        assert sorted(one) == sorted(many)
        key = {(r.g, r.x): r.x_cum for r in running_sum(df, ["k"], ["x"], by=["g"], descending=descending).collect()}
        order = [6, 2, 3, 7, 4, 5, 1] if not descending else [1, 5, 4, 7, 3, 2, 6]
        for g in ("a", "b", None):
            total = 0
            for x in [*order, 0]:
                total += x
                assert key[g, x] == total


def test_dense_codes_common_prefix(spark):
    """Ids that share a long prefix are cut into ranges like any others."""
    vals = [f"Customer#{i:09d}" for i in range(1500)]
    df = spark.createDataFrame([(v,) for v in vals], "v string").repartition(5)
    codes = dense_codes(df, "v", ranges=16)
    assert {r.v: r.code for r in codes.collect()} == {v: i for i, v in enumerate(vals)}
    plan = df.repartitionByRange(16, "v").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(plan) == 16 and max(r["count"] for r in plan) < 400


def test_counts_beyond_bigint_products(spark):
    """AUC and Kendall tau of four billion rows a class: products exceed BIGINT."""
    from voltlens.operators import metrics, stats

    big = 4_000_000_000
    rows = spark.createDataFrame([(0, 0.1, big), (1, 0.9, big)], "y int, s double, w long")
    c = rows.groupBy(F.col("s").alias("score")).agg(F.sum(F.when(F.col("y") == 1, F.col("w")).otherwise(0)).alias("pos"),
                                                     F.sum(F.when(F.col("y") == 0, F.col("w")).otherwise(0)).alias("neg"))
    import unittest.mock as mock
    with mock.patch.object(metrics, "score_counts", return_value=c):
        assert metrics.auc(rows, "y", "s").first()["auc"] == 1.0
    r = running_sum(c.withColumnsRenamed({"pos": "_n1", "neg": "_n0"}), ["score"], ["_n0", "_n1"], totals=True)
    with mock.patch.object(stats, "F", stats.F), mock.patch("voltlens.operators.prefix.running_sum", return_value=r):
        got = stats.kendall_tau_b(rows, "y", "s", [0, 1]).first()
    assert abs(got["tau_b"] - 1.0) < 1e-12 and got["n"] == 2 * big

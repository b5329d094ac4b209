"""Reconciliation by key, correlations on pairs, sketches: small cases."""

import random

import numpy as np
import pytest

from voltlens.operators import sketches, stats

SCHEMA = "k long, `a.b` string, v double"


def test_added_removed_changed(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "x", 1.0), (3, None, 1.0), (3, "y", 2.0), (4, "q", 4.0), (4, "q", 4.0), (None, "n", 1.0),
                               (6, "same", None)], SCHEMA)
    b = spark.createDataFrame([(1, "x", 1.0), (2, "z", None), (3, "w", 1.0), (4, "q", 4.0), (5, "new", 1.0), (None, "n", 2.0),
                               (6, "same", None)], SCHEMA)
    got = {r.k: (r.status, r.rows_a, r.rows_b, r.changed) for r in stats.reconcile_by_key(a, b.select("v", "`a.b`", "k"), "k").collect()}
    assert got == {2: ("changed", 1, 1, ["a.b", "v"]), 3: ("changed", 2, 1, None), 4: ("removed", 1, 0, None),
                   5: ("added", 0, 1, None), None: ("changed", 1, 1, ["v"])}
    assert stats.reconcile_by_key(a, a, "k").collect() == []
    with pytest.raises(ValueError):
        stats.reconcile_by_key(a, a.drop("v"), "k")


def test_spearman_on_pairs_equals_ranks(spark):
    rng = random.Random(4)
    rows = [(g, rng.choice([None, 0, 0, 0, 1, 2]), rng.randrange(4)) for g in ("a", "b", None) for _ in range(60)]
    df = spark.createDataFrame(rows, "g string, x int, y int")

    def ranks(v):
        return np.array([np.sum(v < i) + (np.sum(v == i) + 1) / 2 for i in v])

    for r in stats.spearman(df, "x", "y", by="g").collect():
        x, y = (np.array(c) for c in zip(*[(a, b) for g, a, b in rows if g == r.g and a is not None]))
        assert abs(r.rho - np.corrcoef(ranks(x), ranks(y))[0, 1]) < 1e-12 and r.n == len(x)
    flat = spark.createDataFrame([(1, 2), (1, 3)], "x int, y int")
    assert stats.spearman(flat, "x", "y").first().rho is None
    assert stats.spearman(flat.where("x > 5"), "x", "y").first().n == 0


def test_merged_sketches_equal_one_sketch(spark):
    df = spark.range(30000).selectExpr("id % 5 AS year", "id % 7000 AS customer", "CASE WHEN id % 100 = 0 THEN NULL ELSE CAST(id AS DOUBLE) END AS v")
    table = sketches.sketch_table(df, "year", ["customer"], ["v"])
    r = sketches.estimates(sketches.merge(table), [0.1, 0.5]).first()
    assert r.n == 30000 and abs(r.customer_distinct - 7000) < 5 * sketches.distinct_error() * 7000
    assert abs(r["v_q0.5"] - 15000) < 600 and abs(r["v_q0.1"] - 3000) < 600
    assert sketches.merge(table, "year").count() == 5

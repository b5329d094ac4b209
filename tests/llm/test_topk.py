import numpy as np
import pytest
from pyspark.sql import functions as F

from voltlens.llm import topk


def brute(rows, k, scale=256):
    vs = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in vs:
        if i % 5:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vs if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", F.lit("x").alias("VEC_ID"))
    got = topk.top_k(df.repartition(3), F.col("vec_id") % 5 == 0, **how).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


@pytest.mark.parametrize("seed,spread", [(1, 0.3), (2, 0.01), (3, 5000.0)])
def test_against_brute_force(spark, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (6, 20))
    rows = [(i, (centres[i % 6] + rng.normal(0, spread / 9, 20)).astype(float).tolist()) for i in range(700)]
    assert run(spark, rows, block_rows=300, query_rows=64, dim_block=4) == brute(rows, 5)


def test_ties_and_edges(spark):
    one = [1.0, 0.0, -1.0]
    rows = [(i, one) for i in range(12)] + [(20, None), (25, [1.0, None, 0.0]), (30, [float("nan")] * 3), (None, one),
            (35, [float("inf"), 0.0, 0.0]), (40, [2.0]), (41, [3.0]), (45, [1.0, 1.0]), (50, []), (51, []), (7, one)]
    assert run(spark, rows) == brute_with_repeats(rows)
    assert run(spark, []) == [] and run(spark, [(5, one)]) == []


def brute_with_repeats(rows):
    return brute(rows, 5)


def test_large_cells_stay_exact(spark):
    rows = [(i, [float(2 ** 20 + i), float(2 ** 21 - 3 * i)]) for i in range(30)]
    assert run(spark, rows, scale=2 ** 8, k=3) == brute(rows, 3, 2 ** 8)  # products beyond 2^53


def test_query_passes(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 10)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 8).tolist()) for i in range(200)]
    assert run(spark, rows) == brute(rows, 5)


def test_bounds_prune():
    """With far clusters later dimension blocks see few candidates; results stay exact."""
    rng = np.random.default_rng(5)
    c = np.concatenate([rng.integers(-3, 4, (500, 32)), rng.integers(90, 99, (20, 32))]).T
    ids = np.arange(520)
    found = {q: (i.tolist(), s.tolist()) for q, i, s in topk.search(np.array([600]), c[:, 510:511], ids, c, 4, 8)}
    scores = c[:, 510] @ c
    want = np.lexsort((ids, -scores))[:4]
    assert found[600] == (want.tolist(), scores[want].tolist())


def test_scores_beyond_64_bits_raise_and_smaller_ones_are_exact():

    from voltlens.llm.topk import search

    ids, one = np.array([1]), np.array([[2 ** 40], [1]])
    with pytest.raises(OverflowError):
        list(search(ids, one, np.array([2, 3]), np.array([[2 ** 40, 5], [0, 7]]), 2, 16))
    (_, got, scores), = search(ids, one, np.array([2, 3]), np.array([[2 ** 22, -5], [0, 7]]), 2, 16)
    assert got.tolist() == [2, 3] and scores.tolist() == [2 ** 62, 7 - 5 * 2 ** 40]
    wide = np.array([[2 ** 40], [-2 ** 40]])  # large products that cancel
    (_, got, scores), = search(ids, wide, np.array([2]), np.array([[2 ** 40], [2 ** 40 - 3]]), 1, 16)
    assert scores.tolist() == [3 * 2 ** 40]

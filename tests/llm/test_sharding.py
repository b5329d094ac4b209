import math
from collections import Counter

import numpy as np

from voltlens.llm import sharding


def test_hypergeometric_quantiles_are_exact():
    good, bad, n = 13, 20, 9
    pmf = [math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) for k in range(n + 1)]
    cdf = np.cumsum(pmf)
    for u in np.linspace(0.001, 0.999, 97):
        assert sharding.hypergeometric(good, bad, n, u) == int(np.searchsorted(cdf, u, side="right"))
    assert sharding.hypergeometric(0, 5, 3, 0.5) == 0 and sharding.hypergeometric(5, 0, 3, 0.5) == 3


def test_hypergeometric_at_scale():
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(2 * 10**9, 46 * 10**9, 10**6, u) for u in rng.random(400)]
    sd = math.sqrt(1e6 * (2 / 48) * (46 / 48))
    assert abs(np.mean(draws) - 1e6 * 2 / 48) < 5 * sd / 20 and 0.85 < np.std(draws) / sd < 1.15


def test_matrix_margins():
    counts, sizes = [10, 0, 7, 30], sharding.shard_sizes(47, 5)
    m = np.array(sharding.communication_matrix(counts, sizes, 3))
    assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).tolist() == sizes and (m >= 0).all()


def test_exact_sizes_and_slots(spark):
    df = spark.range(5003).withColumnRenamed("id", "doc_id").repartition(7)
    rows = sharding.shuffle_into_shards(df, shards=24, range_rows=64).collect()
    assert sorted(r.doc_id for r in rows) == list(range(5003))
    sizes = Counter(r.shard for r in rows)
    assert sorted(sizes) == list(range(24)) and max(sizes.values()) - min(sizes.values()) == 1
    for k in range(24):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))


def test_uniform(spark):
    """Each (source partition, shard) count is within 5 sd of its mean; slots do not follow ids."""
    df = spark.range(0, 24000, 1, 6).withColumnRenamed("id", "doc_id")
    rows = sharding.shuffle_into_shards(df, shards=6, seed=7).collect()
    cells = Counter((r.doc_id // 4000, r.shard) for r in rows)
    sd = math.sqrt(4000 * (1 / 6) * (5 / 6) * (20000 / 23999))
    assert all(abs(cells[p, k] - 4000 / 6) < 5 * sd for p in range(6) for k in range(6))
    r = np.corrcoef([x.doc_id for x in rows], [x.slot for x in rows])[0, 1]
    assert abs(r) < 0.04


def test_seed_changes_and_repeats(spark):
    df = spark.range(300).withColumnRenamed("id", "doc_id")
    get = lambda s: {r.doc_id: (r.shard, r.slot) for r in sharding.shuffle_into_shards(df, 4, s).collect()}
    assert get(1) == get(1) and get(1) != get(2)


def test_edges(edge, frame):
    out = sharding.shuffle_into_shards(edge, 24)
    assert out.count() == edge.count()
    assert [c for c in out.columns if c.lower() == "shard"] == ["shard"]
    assert sharding.shuffle_into_shards(frame([])).count() == 0


def test_native(spark):
    plan = sharding.shuffle_into_shards(spark.range(100), 3)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))

import random

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from voltlens.llm import simhash


def fingerprint(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(ids, fps, bits):
    n, root = len(ids), list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return [low.get(find(i)) for i in range(n)]


@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=600), max_size=6))
@settings(max_examples=40, deadline=None)
def test_fold_counts_bits(groups):
    flat = np.array([h for g in groups for h in g], np.uint64)
    got = simhash.fold(flat, np.array([len(g) for g in groups], np.int64))
    want = [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in g) > len(g)) for g in groups]
    assert got.tolist() == want


def test_edge_documents(edge):
    rows = simhash.near_duplicates(edge).collect()
    texts = {1: None, 2: "", 3: " \t\n ", 4: "a b c d e f", 5: "A B C d e f"}
    assert len(rows) == edge.count()
    by_id = {r.doc_id: r for r in rows}
    for i, t in texts.items():
        assert by_id[i].fingerprint == f"{fingerprint(t):016x}"
    assert by_id[1].component_id == by_id[3].component_id == 1  # without words: linked like any other
    assert by_id[5].component_id == 4 and by_id[7].component_id == 6


def test_components_match_brute_force(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(25)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "doc_id long, simhash long")
    pairs = {(r.u, r.v) for r in simhash.links(df.select("simhash").distinct(), 3).collect()}
    want = {(min(a, b), max(a, b)) for a in set(signed) for b in set(signed)
            if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert pairs == want
    groups = simhash.fingerprint_groups(df, 3)
    low = df.join(groups, "simhash").groupBy("root").agg(F.min("doc_id").alias("c"))
    got = {r.doc_id: r.c for r in df.join(groups, "simhash").join(low, "root").collect()}
    assert [got[i] for i in range(len(fps))] == classes(list(range(len(fps))), fps, 3)


def test_other_distances(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(63) for _ in range(6)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(63), rng.randint(0, 4))) for b in base for _ in range(12)})
    df = spark.createDataFrame([(f,) for f in fps], "simhash long")
    for bits in (0, 1, 5):
        got = {(r.u, r.v) for r in simhash.links(df, bits).collect()}
        assert got == {(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= bits}


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "u long, v long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_keep_one(edge, frame):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(r[0] for r in kept.collect() if r[0] is not None)
    assert ids == [1, 4, 6, 8, 9, 10, 11]
    assert simhash.keep_one(frame([])).count() == 0 and simhash.near_duplicates(frame([])).count() == 0


def test_probes_are_not_broadcast(spark):
    """Spark sizes an exploded side by the rows before it; the probes are over thirty rows a fingerprint."""
    df = spark.range(2000).select(F.xxhash64("id").alias("simhash"))
    found = simhash.links(df, 3)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan and "BroadcastHashJoin" not in plan

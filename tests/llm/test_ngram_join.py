import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from voltlens.llm import ngram_join


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + 3]) for i in range(len(w) - 2)} or ({b" ".join(w)} if w else set())


def brute(rows, percent=90):
    """Sorted (id, set size, smallest id reachable, number of links) by the definition."""
    sets, root, links = [shingles(t) for _, t in rows], list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j, o in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i)), links[i]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(df, **how):
    out = ngram_join.jaccard_components(df, **how)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def near_copies(rng, n, length, changes):
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(changes + 1)):
            t[rng.randrange(length)] = f"x{rng.randrange(50)}"
        out.append(" ".join(t[rng.randrange(3):]))
    return out


def test_edge_rows(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert run(edge) == brute(rows)


def test_empty_table(frame):
    assert run(frame([(1, "a")]).where("doc_id > 5")) == []


@pytest.mark.parametrize("block_rows,block_entries", [(2048, 1 << 20), (7, 400), (1, 1)])
def test_near_copies_in_any_blocks(frame, block_rows, block_entries):
    rng = random.Random(5)
    texts = near_copies(rng, 60, 80, 4) + near_copies(rng, 25, 300, 8) + near_copies(rng, 20, 12, 1)
    shared = " ".join(f"s{i}" for i in range(40))  # a passage that many documents share
    texts += [shared + " " + " ".join(f"u{i}_{j}" for j in range(60)) for i in range(40)] + [texts[0]] * 9
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert run(frame(rows), block_rows=block_rows, block_entries=block_entries) == brute(rows)


@pytest.mark.parametrize("percent", [60, 100])
def test_other_thresholds(frame, percent):
    rng = random.Random(percent)
    rows = list(enumerate(near_copies(rng, 40, 40, 10) + near_copies(rng, 30, 9, 3)))
    assert run(frame(rows), percent=percent, block_rows=8, block_entries=200) == brute(rows, percent)


@given(st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=14), min_size=2, max_size=12), st.integers(0, 12),
       st.sampled_from([50, 80, 90]))
@settings(max_examples=80, deadline=None)
def test_product_against_definition(sets, cut, percent):
    """Blocks of a matrix with themselves and with each other, with dense columns from two rows on."""
    sets = [np.unique(np.array(s, np.uint64)) for s in sets]
    n = np.array([len(s) for s in sets])
    side = (np.arange(len(sets)) >= cut).astype(np.int64) if 0 < cut < len(sets) else np.zeros(len(sets), np.int64)
    keys = np.arange(len(sets)) * 10
    before, ngram_join.DENSE_FROM = ngram_join.DENSE_FROM, 1 + len(sets) // 3
    try:
        got = ngram_join.link_block(keys, n, np.arange(1, len(sets) + 1), side, [s.tobytes() for s in sets], percent)
    finally:
        ngram_join.DENSE_FROM = before
    want = Counter()
    for i in range(len(sets)):
        for j in range(len(sets)):
            o = len(np.intersect1d(sets[i], sets[j]))
            across = side[i] != side[j] if side.any() else i != j
            if across and 100 * o >= percent * (n[i] + n[j] - o):
                want[i * 10] += j + 1
    assert dict(zip(got[0].tolist(), got[2].tolist())) == dict(want)


def test_extra_columns_and_repeated_rows(frame):
    df = frame([(3, "a b c d e"), (3, "a b c d e"), (2, "A B C D E"), (5, "z")]).withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    assert run(df) == [(2, 3, 2, 2), (3, 3, 2, 2), (3, 3, 2, 2), (5, 1, 5, 0)]


@given(st.lists(st.lists(st.integers(0, 25), min_size=1, max_size=24), min_size=2, max_size=10), st.integers(0, 10),
       st.sampled_from([1, 50, 80, 90, 100]))
@settings(max_examples=80, deadline=None)
def test_bound_columns_find_every_link(sets, cut, percent):
    """Rows that are linked reach the bound of their bound columns, in blocks with themselves and with each other."""
    sets = [np.unique(np.array(s, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in sets]
    n, keys = np.array([len(s) for s in sets]), np.arange(len(sets))
    side = (keys >= cut).astype(np.int64) if 0 < cut < len(sets) else np.zeros(len(sets), np.int64)
    bound = [s[:ngram_join.bound_size(len(s), percent)].tobytes() for s in sets]
    full = ngram_join.link_block(keys, n, np.ones(len(n)), side, [s.tobytes() for s in sets], percent)
    near = ngram_join.link_block(keys, n, np.ones(len(n)), side, bound, percent, bound=True)
    star = dict(zip(near[0].tolist(), near[1].tolist()))
    assert set(full[0].tolist()) <= set(star)
    assert all(star[k] == star[root] for k, root in zip(full[0].tolist(), full[1].tolist()))


def test_a_cluster_of_chance_columns_is_cut(frame):
    """Texts of few words share rare columns by chance: one cluster of many blocks, whose rows went to every block pair."""
    rng = random.Random(3)
    texts = [[f"v{rng.randrange(12)}" for _ in range(100)] for _ in range(60)]
    texts += [t[:50] + ["z"] + t[51:] for t in texts[:6]]
    rows = list(enumerate(" ".join(t) for t in texts))
    docs = ngram_join.pick(frame(rows), {"doc_id": "doc_id", "text": "text"})
    keyed, sets, _ = ngram_join.distinct_rows(docs, 3, 90)
    pairs = ngram_join.block_pairs(ngram_join.clusters(keyed, sets, 90), sets, 90, 8, 1 << 20)
    cut = ngram_join.refined(keyed, pairs, sets, 90, 8, 1 << 20)
    sent = lambda p: p.agg(F.sum(F.size("pairs"))).first()[0]
    assert pairs.where("not whole").count() > 50 and sent(pairs) > 4 * 60
    assert cut.where("not whole").isEmpty() and sent(cut) == 12
    assert run(frame(rows), block_rows=8) == brute(rows)

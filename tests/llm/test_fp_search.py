import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from voltlens.llm import fp_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def tokens(t):
    return TERM.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k=10):
    rows = [(d, Counter(tokens(t))) for d, t in docs]
    rows = [(d, c, sum(c.values())) for d, c in rows if c]
    n, total, df = len(rows), sum(r[2] for r in rows), Counter(t for r in rows for t in r[1])
    out = []
    for item, text in items:
        found = []
        for d, c, size in rows:
            m = 25 + (75 * size * n) // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, q in Counter(tokens(text)).items() if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        found.sort(key=lambda f: f[:3])
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(found[:k])]
    return sorted(out, key=str)


def run(docs, items, **how):
    out = fp_search.ranked_search(docs, items, **how)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def asked(spark, items):
    return spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, TEXT string, rank int")


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_terms(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in fp_search.terms(text)] == tokens(text)


@pytest.mark.parametrize("cells", [1 << 20, 200, 1])
def test_random_documents(spark, frame, cells):
    rng = random.Random(cells)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 300}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(2000 + i, docs[7][1] + " w1" * i) for i in range(10)]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 20)))) for i in range(25)]
    assert run(frame(docs), asked(spark, items), tree_cells=cells) == brute(docs, items)


def test_edge_rows(spark, edge):
    items = [(1, None), (2, ""), (3, "!!"), (4, "a b c"), (4, "a b c"), (None, "the no id word1 Apples"), (5, "ÉÉÉ 日本語 end"),
             (6, "absent terms only"), (7, "word5 word5 word5 long")]
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    assert run(edge, asked(spark, items)) == brute(docs, items)


def test_empty_tables(spark, frame):
    some = frame([(1, "a b")])
    assert run(some.where("doc_id > 3"), asked(spark, [(1, "a")])) == []
    assert run(some, asked(spark, [(1, "a")]).where("item_id > 3")) == []


def test_blocks_of_items(spark, frame, monkeypatch):
    monkeypatch.setattr(fp_search, "BLOCK_ITEMS", 3)
    docs = [(i, f"t{i % 7} t{i % 5} t{i % 3} x") for i in range(60)]
    items = [(i, f"t{i % 7} x t{i % 4}") for i in range(10)]
    assert run(frame(docs), asked(spark, items), k=4) == brute(docs, items, 4)


def test_first_bars_come_from_a_part_and_keep_the_result(spark, frame, monkeypatch):
    monkeypatch.setattr(fp_search, "BAR_SHARE", 2)
    docs = [(i, f"a{i % 50} b c d{i % 9}") for i in range(300)]
    items = [(i, f"a{i} b d{i % 9}") for i in range(20)]
    assert run(frame(docs), asked(spark, items)) == brute(docs, items)


@given(st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(1, 5)), max_size=8), min_size=1, max_size=25),
       st.lists(st.integers(0, 12), min_size=1, max_size=6, unique=True), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_tree_search_against_all_scores(docs, wanted, k):
    docs = [sorted(dict(d).items()) for d in docs]
    lens = np.array([len(d) for d in docs])
    rank = np.array([t for d in docs for t, _ in d], np.int64)
    tf = np.array([f for d in docs for _, f in d], np.int64)
    m = 25 + 7 * np.arange(len(docs)) % 90
    tree = fp_search.Tree(np.arange(len(docs)), m, lens, rank, tf)
    ranks, weights = np.array(sorted(wanted)), 1 + np.arange(len(wanted)) * 37
    dense = np.zeros(20, np.int64)
    dense[ranks] = weights
    scores = [sum(dense[t] * (10 ** 9 * f // (1000 * f + 8 * m[i])) for t, f in d) for i, d in enumerate(docs)]
    want = sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:k]
    none = np.zeros(0, np.int64)
    got = tree.search(ranks, weights, dense, k, (none, none), 1)
    assert [(-s, i) for s, i in zip(got[0].tolist(), got[1].tolist())] == want
    # a node's maxima and minima hold for all documents below it
    for level in tree.levels:
        for lo, hi, term, most, least in zip(*(level[c] for c in ("lo", "hi", "term", "tf", "m"))):
            cells = [c for i in range(lo, hi) for c in range(tree.ptr[i], tree.ptr[i + 1]) if tree.rank[c] == term]
            assert most == max(tree.tf[cells]) and least == min(tree.m[lo:hi]) and len(cells) == hi - lo


def test_extra_columns(spark, frame):
    docs = frame([(1, "a b"), (2, "b"), (2, "b")]).withColumn("n", F.lit(1)).withColumn("score", F.lit(1))
    assert run(docs, asked(spark, [(1, "b")])) == brute([(1, "a b"), (2, "b"), (2, "b")], [(1, "b")])

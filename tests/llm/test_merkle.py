import hashlib
import zlib

import pytest
from pyspark.sql import functions as F, types as T

from voltlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT int, leaf string, number string"


def tampered():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def small(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def leaf(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def build(level, fanout):
    levels = [level]
    while len(levels[-1]) > 1:
        p = levels[-1]
        levels.append([sha("".join(p[i:i + fanout])) for i in range(0, len(p), fanout)])
    return levels


def ascend(levels, i, h, fanout):
    siblings = []
    for level in levels[:-1]:
        run, at = level[i // fanout * fanout:i // fanout * fanout + fanout], i % fanout
        siblings += run[:at] + run[at + 1:]
        h, i = sha("".join(run[:at] + [h] + run[at + 1:])), i // fanout
    return siblings, h


def brute(rows, fanout=8):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = [build([leaf(r, r[1]) for r in by[lang]], fanout) for lang in langs]
    top = build([t[-1][0] for t in trees], fanout)
    out = []
    for n, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            held = leaf(r, small(r[1]) if hit and r[1] is not None else r[1])
            s1, h = ascend(trees[n], i, held, fanout)
            s2, h = ascend(top, n, h, fanout)
            root = top[-1][0]
            out.append((r[0], leaf(r, r[1]), trees[n][-1][0], root, sha("".join(s1 + s2)), h, h == root))
    return sorted(out, key=str)


def run(spark, rows, fanout=8):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    out = merkle.verify(df, fanout=fanout, tampered=tampered())
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("n", [1, 9, 600])
def test_one_language(spark, n):
    rows = [(i, f"Text {i} É", "en", "s", i) for i in range(n)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("fanout", [2, 8])
def test_edge_rows(spark, fanout):
    rows = [(1, None, "en", "s", 0), (2, "", "en", None, 0), (None, "No id", "en", "s", None), (None, "No id", "en", "s", None),
            (4, "A b", None, "s", 3), (4, "A b", None, "s", 3), (4, "other", None, "s", 5), (6, "X" * 200_000, "éé", "s", 9),
            (7, "tie", "", "s", 1), (8, "ÀB 日本 🙂", "é", "s:1", -3), (-9, "Neg", "zz", "-", 2)]
    rows += [(i, f"T{i}", f"l{i % 11}", "s", i) for i in range(10, 90)]
    assert run(spark, rows, fanout) == brute(rows, fanout)


def test_upper_nodes_are_spread(spark):
    """Leaves of a tall binary tree meet several copies of its upper nodes."""
    rows = [(i, f"T{i}", "en", "s", i) for i in range(300)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    leaves, nodes, _, root = merkle.manifest(df, fanout=2)
    stored = {r.node: r.c for r in nodes.groupBy("node").agg(F.count("*").alias("c")).collect()}
    assert {k & 63: v for k, v in stored.items()} == {h: max(1, 2 ** (h - 4)) for h in range(1, 10)}
    met = merkle.climb(leaves, nodes, fanout=2)
    assert met.where(F.col("folded_root") == root).count() == 300
    assert run(spark, rows, 2) == brute(rows, 2)


def test_empty_table_and_settings_stay(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    df = spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))
    assert merkle.verify(df, tampered=tampered()).collect() == []
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_any_change_of_a_field_is_found(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(70)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    leaves, nodes, _, root = merkle.manifest(df)
    forged = leaves.withColumn("held", F.when(F.col("doc_id") == 33, F.sha2(F.lit("forged"), 256)).otherwise(F.col("held")))
    bad = merkle.climb(forged, nodes).where(F.col("folded_root") != root)
    assert bad.join(leaves, "number").select("doc_id").collect() == [(33,)]

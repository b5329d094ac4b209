"""The pipeline against brute force, and every query over sf0.001."""

import re

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as cp
from voltlens.llm import byte_bpe, decontaminate, langid, queries, secrets
from voltlens.llm.common import materialize, table

from tests.llm.test_decontaminate import brute as leaks_by_definition
from tests.llm.test_simhash import classes, fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_are_listed_in_order():
    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination",
                                         "secret_scan", "byte_bpe"]


def test_pipeline_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    # language ID: a document goes when the fitted model rejects it
    model = langid.fit(docs)
    scorer = langid.Scorer(model)
    keep = [i for i, r in rows.items() if not scorer.predict([r.text])[2][0]]
    stage = materialize(cp.language_id(spark, docs, SF), "t")
    assert stage.columns == docs.columns and sorted(r.doc_id for r in stage.collect()) == sorted(keep)
    # near-dedup: the smallest id of each class
    fps = [fingerprint(rows[i].text) for i in keep]
    left = sorted(i for i, c in zip(keep, classes(keep, fps, 3)) if i == c)
    stage = materialize(cp.simhash_near_dedup(spark, stage, SF), "t")
    assert stage.columns == docs.columns and sorted(r.doc_id for r in stage.collect()) == left
    # decontamination, by definition of an alignment; only documents sharing words can leak
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    grams = {tuple(w[k:k + 5]) for _, t in items for w in [[x for x in map(decontaminate.canonical, t.split()) if x]]
             for k in range(len(w) - 4)}
    near = []
    for i in left:
        w = [x for x in map(decontaminate.canonical, rows[i].text.split()) if x]
        if any(tuple(w[k:k + 5]) in grams for k in range(len(w) - 4)):
            near.append((i, rows[i].text))
    dirty = {d for d, _ in leaks_by_definition(near, items)}
    left = [i for i in left if i not in dirty]
    stage = materialize(cp.benchmark_decontamination(spark, stage, SF), "t")
    assert dirty and stage.columns == docs.columns and sorted(r.doc_id for r in stage.collect()) == left
    # secrets: every base span is gone, the rest of the text is as it was
    stage = materialize(cp.secret_scan(spark, stage, SF), "t")
    assert stage.columns == docs.columns
    got = {r.doc_id: r.text for r in stage.collect()}
    assert sorted(got) == left
    for i, t in got.items():
        assert not secrets.base_spans(t.replace("[SECRET]", " "))
        kept = [re.escape(x) for x in t.split("[SECRET]")]
        assert re.fullmatch("(?s:.+)".join(kept), rows[i].text)
    # tokens
    judge = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                              mergeable_ranks=byte_bpe.read_ranks(P.path(cp.RANKS)))
    out = {r.doc_id: r for r in cp.byte_bpe_round_trip(spark, stage, SF).collect()}
    assert all(out[i].exact and out[i].ids == judge.encode_ordinary(t) for i, t in got.items())
    # run() is the stages one after another
    assert sorted(r.doc_id for r in cp.run(spark, SF).select("doc_id").collect()) == left


def test_stages_on_edges(spark, edge, frame):
    plain = lambda df: df.toDF("doc_id", "text", "lang", "a", "b", "ids", "shard", "c0").drop("ids")
    for rows in (plain(edge), plain(frame([]))):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, rows, SF)
            assert out.columns == rows.columns, name
            assert out.count() <= rows.count()


def test_last_stage_on_edges(spark, edge):
    rows = edge.toDF("doc_id", "text", "lang", "Lang", "source", "ids", "n_tokens", "c0")
    for docs in (rows, rows.where("c0 IS NULL")):
        out = cp.byte_bpe_round_trip(spark, docs, SF)
        assert out.columns == ["doc_id", "lang", "source", "text", "ids", "n_tokens", "exact"]
        got = out.collect()
        assert len(got) == docs.count() and all(r.exact for r in got)
        assert all(r.n_tokens == 0 for r in got if not r.text)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_over_whole_tables(spark, name):
    out = queries.QUERIES[name](spark, SF)
    n = table(spark, SF, "documents").count()
    if name.startswith("op3_"):
        assert 0 < out.count() and out.where(F.col("doc_id").isNull()).count() == 0
    elif name.startswith("op13_"):
        assert out.count() == 10 * table(spark, SF, "benchmark").count()
    elif name.startswith("op7_"):
        assert out.count() == 5 * table(spark, SF, "embeddings").where("vec_id % 50 = 0").count()
    else:
        assert out.count() == n

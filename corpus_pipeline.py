"""Corpus pipeline over ``documents``: each stage calls one operator and works on what the one
before kept. All stages but the last return the columns of ``documents``.

Cases: null and empty texts have no language and go with the first stage; repeated rows are copies, of
which the second keeps one; ids may be null; long texts are used whole; an empty table stays empty.
Extra columns are kept by all stages but the last, also those whose names clash.

No SQL twin: the stages learn, hash and tokenise; ``tests/llm/test_pipeline.py`` holds the
result against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voltlens.llm import byte_bpe, decontaminate, langid, secrets, simhash
from voltlens.llm.common import materialize, pick, table

RANKS = "byte_bpe_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected (or that have no letter) go."""
    return langid.keep_identified(docs, langid.fit(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or with other slot values, go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported secret is masked in the text; all documents stay."""
    return secrets.redact(docs, scope_chars=200)


def byte_bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; ``exact`` says that decoding them gives the text's bytes."""
    path = public_tokenizers.path(RANKS)
    # by position: other columns may share a name but for case, or one of the results' names
    rows = pick(docs, {c: c for c in ("doc_id", "lang", "source", "text")})
    coded = byte_bpe.encode(rows, path, decoded=True)
    whole = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    return coded.select("doc_id", "lang", "source", "text", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        (F.col("decoded") == whole).alias("exact"))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe_round_trip),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

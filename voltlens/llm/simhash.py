"""SimHash near-duplicates by multi-index hashing.

A fingerprint bit is set when more than half of the shingle hashes (XXH64, seed 42)
have it set. Fingerprints within ``max_bits`` differing bits are linked; linked documents
form components.

Search: a fingerprint is cut into ``segments`` equal parts. Two fingerprints within
``max_bits`` agree in one part up to ``max_bits // segments`` bits (pigeonhole), so every
fingerprint enumerates the Hamming ball of that radius around each part, fetches the
table rows stored under those keys (an equi-join) and verifies the complete distance
inside the join. Of two parts that differ, only the one holding the highest differing
bit probes, so a ball is half its size and a pair is met from one side.

Scale: equal fingerprints are one row before the search (hot copies never meet in
pairs); 32-bit keys keep the buckets small; only verified links leave the join;
components come from large-star / small-star rounds written to the shared folder.

Cases: null text and text without words give fingerprint zero, linked like any other.
A text with fewer words than a shingle is one shingle. Null ids are carried; the
component id is the smallest non-null id of the component (null when it has none).
Repeated rows share a fingerprint. An empty table gives an empty result. Extra columns
are carried; those named like a result column are replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from voltlens.llm.common import annotate, materialize, pick, position
from voltlens.session import remove_scratch, scratch_path

BYTE_ONES = np.uint64(0x0101010101010101)


def fold(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes (``counts`` rows each, zero allowed).

    Eight byte-wide counters ride in one 64-bit word: for every bit position within a
    byte the masked hashes are summed over runs of at most 255 rows.
    """
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    runs = -(-counts[some] // 255)
    group_start = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
    first_run = np.concatenate([[0], np.cumsum(runs)[:-1]])
    within = np.arange(runs.sum()) - np.repeat(first_run, runs)
    starts = np.repeat(group_start, runs) + 255 * within
    half = counts[some].astype(np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & BYTE_ONES, starts)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        for byte in range(8):  # little-endian: byte b holds bits 8b to 8b+7
            on = (sums[:, byte] * 2 > half).astype(np.uint64)
            out[some] |= on << np.uint64(8 * byte + bit)
    return out


def shingle_hashes(text: str | None, width: int, digest) -> list[int]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    joined = b" ".join(words)
    if n <= width:
        return [digest(joined, 42)] if n else []
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = starts[width:] + [at]
    return [digest(joined[a:b - 1], 42) for a, b in zip(starts, ends)]


def fingerprints(df: DataFrame, text_col: str = "text", shingle_words: int = 3, keep=None) -> DataFrame:
    """Append ``simhash`` (long, the 64 bits)."""

    def make():
        from xxhash import xxh64_intdigest

        def work(texts):
            counts, parts = np.zeros(len(texts), np.int64), []
            for i, t in enumerate(texts):
                h = shingle_hashes(t, shingle_words, xxh64_intdigest)
                counts[i] = len(h)
                parts.append(np.array(h, np.uint64))
            hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            return [fold(hashes, counts).view(np.int64)]

        return work

    return annotate(df, text_col, [T.StructField("simhash", T.LongType())], make, keep)


def segment(fp: Column, i: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def links(distinct: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """Verified pairs ``(u, v)``, u < v, of the distinct ``simhash`` values."""
    if 64 % segments:
        raise ValueError("segments must divide 64")
    width, radius = 64 // segments, max_bits // segments
    # few bytes grow to many probes: keep as many tasks as a shuffle has
    distinct = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "simhash")
    fp = F.col("simhash")
    parts = F.array(*(F.struct(F.lit(i).alias("seg"), segment(fp, i, width).alias("key")) for i in range(segments)))
    cut = distinct.select(fp, F.explode(parts).alias("s")).select("simhash", "s.seg", "s.key")
    ball = [(sum(1 << b for b in bits), 1 << bits[-1] if bits else 0)
            for r in range(radius + 1) for bits in combinations(range(width), r)]
    masks = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(t).cast("long").alias("top")) for m, t in ball))
    probe_rows = cut.select(fp.alias("a"), "seg", "key", F.explode(masks).alias("m")).where(
        (F.col("m.mask") == 0) | (F.col("key").bitwiseAND(F.col("m.top")) != 0)).select(
        "a", "seg", F.col("key").bitwiseXOR(F.col("m.mask")).alias("key"))
    stored_rows = cut.select(fp.alias("b"), "seg", "key")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # Spark sizes the exploded sides by the fingerprints they come from and would broadcast the probes: both are shuffled
    found = probe_rows.hint("merge").join(
        stored_rows, (probe_rows.seg == stored_rows.seg) & (probe_rows.key == stored_rows.key) & near)
    return found.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge, root = smallest node reachable.

    Alternating large-star and small-star steps; every round is a written table that replaces
    the one before, the driver sees one row of sums per round.
    """
    spark, path = edges.sparkSession, scratch_path(edges.sparkSession, "edges")
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges", path)
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
        last, path = path, scratch_path(spark, "edges")
        e = materialize(small.where("u != v").distinct(), "edges", path)
        remove_scratch(spark, last)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == (now.n, now.s):
            roots = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
            own = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return roots.union(own)
        before = (now.n, now.s)
    raise RuntimeError("components did not settle")


def fingerprint_groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(simhash, root)`` of every distinct fingerprint."""
    distinct = fps.select("simhash").distinct()
    roots = components(links(distinct, max_bits))
    return distinct.join(roots, distinct.simhash == roots.node, "left").select(
        "simhash", F.coalesce("root", "simhash").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row."""
    rows = pick(df, {"doc_id": id_col, "text": text_col})
    fps = materialize(fingerprints(rows, "text", shingle_words, keep=["doc_id"]), "simhash")
    per_fp = fps.groupBy("simhash").agg(F.min("doc_id").alias("low"))
    groups = materialize(fingerprint_groups(fps, max_bits), "groups")
    named = per_fp.join(groups, "simhash").groupBy("root").agg(F.min("low").alias("component_id"))
    per_fp = groups.join(named, "root").select("simhash", "component_id")
    return fps.join(per_fp, "simhash").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """One input row of every component: the smallest id (nulls last), then fingerprint, then
    text hash; of fully repeated rows one stays. All input columns are kept."""
    at, text_at = position(df, id_col), position(df, text_col)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    keyed = plain.select(F.col(f"c{at}").alias("doc_id"), F.col(f"c{text_at}").alias("text"))
    fps = materialize(fingerprints(keyed.withColumn("th", F.xxhash64("text")), "text", shingle_words,
                                   keep=["doc_id", "th"]), "simhash")
    groups = materialize(fingerprint_groups(fps, max_bits), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "simhash", "th")
    best = fps.groupBy("simhash").agg(F.min(order).alias("k")).join(groups, "simhash").groupBy("root").agg(
        F.min("k").alias("k"))
    best = best.select(F.col("k.id").alias("k_id"), F.col("k.th").alias("k_th"))
    kept = plain.withColumn("th", F.xxhash64(f"c{text_at}")).join(
        best, F.col(f"c{at}").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left_semi")
    kept = kept.dropDuplicates([f"c{at}", "th"]).drop("th")
    return kept.toDF(*df.columns)

"""Exact top-k inner products by columnar branch-and-bound.

Vectors are packed into blocks in vertical layout (dimension by dimension) and written
once. Query blocks meet candidate blocks through a broadcast of at most
``QUERIES_AT_ONCE`` queries; a larger query set takes more passes over the candidates.
Within a pair of blocks a tile of queries accumulates partial products one dimension block
at a time, dimensions of most energy first. By Cauchy-Schwarz the dimensions still to come
add at most the product of the remaining norms; candidates that can reach no query's k-th
best are removed and the survivors compacted before the next dimension block. Bounds carry
a slack above the rounding error and sums are exact integers, so the result is exact. Scores
from 2^53 on are computed as integers without bounds; one that does not fit into 64 bits raises.

Cases: components become floor(scale * x); vectors that are null or hold null or non-finite
components, and rows without an id, take no part; vectors of other length do not meet;
rows of the query's own id are no candidates; ties go to the smaller id, repeated rows of
another id are separate candidates; a query with fewer candidates returns them all; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from voltlens.llm.common import materialize, pick

#: Queries sent to the tasks at once.
QUERIES_AT_ONCE = 1 << 15
EXACT, LONG = 2.0 ** 53, 2.0 ** 63
BLOCK_SCHEMA = "dim int, n int, ids binary, cells binary, narrow boolean"


def quantise(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    rows = pick(df, {"vec_id": id_col, "v": vec_col})
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed ``size`` at most to a block of one length, cells dimension-major."""

    def packed(ids: list, vectors: list) -> dict:
        m = np.array(vectors, np.int64).reshape(len(ids), -1)
        narrow = bool(m.size == 0 or np.abs(m).max() < 2 ** 31)
        return {"dim": m.shape[1], "n": len(ids), "ids": np.array(ids, "<i8").tobytes(),
                "cells": np.ascontiguousarray(m.T, "<i4" if narrow else "<i8").tobytes(), "narrow": narrow}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[list, list]] = {}
        done = []
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, vectors = open_.setdefault(len(v), ([], []))
                ids.append(i), vectors.append(v)
                if len(ids) == size:
                    done.append(packed(*open_.pop(len(v))))
            if done:
                yield to_batch(done)
                done = []
        if open_:
            yield to_batch([packed(*x) for x in open_.values()])

    def to_batch(found: list[dict]) -> pa.RecordBatch:
        types = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("cells", pa.binary()),
                           ("narrow", pa.bool_())])
        return pa.RecordBatch.from_pylist(found, types)

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def unpack(dim: int, n: int, cells: bytes, narrow: bool) -> np.ndarray:
    return np.frombuffer(cells, "<i4" if narrow else "<i8").reshape(dim, n)


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """k-th best score of every row; -inf where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, dim_block: int,
           tile: int = 16, seed_rows: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its best ``k`` of this block: (query id, candidate ids, scores). q, c: dim x n."""
    dim = len(q)
    biggest = dim * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    kind = np.float64 if biggest < EXACT else np.int64  # beyond 2^53 integers, without pruning
    order = np.argsort(-(c.astype(np.float64) ** 2).sum(axis=1), kind="stable")
    q, c = q[order].astype(kind), c[order].astype(kind)
    cuts = list(range(0, dim, dim_block)) + [dim]
    left = lambda m: [np.sqrt((m[b:].astype(np.float64) ** 2).sum(axis=0)) for b in cuts]
    q_left, c_left = left(q), left(c)
    for t in range(0, q.shape[1], tile):
        ids, part = q_ids[t:t + tile], q[:, t:t + tile]
        if kind is np.int64:
            if biggest < LONG:
                whole = part.T @ c
            else:
                exact = part.T.astype(object) @ c.astype(object)
                if exact.size and (exact.max() >= 1 << 63 or exact.min() < -(1 << 63)):
                    raise OverflowError("an inner product does not fit into 64 bits")
                whole = exact.astype(np.int64)
            alive = np.arange(len(c_ids))
            own = ids[:, None] == c_ids[None, :]
        else:
            first = part.T @ c[:, :seed_rows]
            first[ids[:, None] == c_ids[None, :seed_rows]] = -np.inf
            bar = kth(first, k)
            alive = np.arange(seed_rows, len(c_ids))
            sums = np.zeros((part.shape[1], len(alive)))
            sums[ids[:, None] == c_ids[None, alive]] = -np.inf
            for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                sums += part[lo:hi].T @ c[lo:hi, alive]
                reach = sums + q_left[b + 1][t:t + tile, None] * c_left[b + 1][None, alive] * (1 + 1e-9) + 0.5
                stays = (reach >= bar[:, None]).any(axis=0)
                if not stays.all():
                    alive, sums = alive[stays], sums[:, stays]
            whole = np.concatenate([first, sums], axis=1)
            alive = np.concatenate([np.arange(min(seed_rows, len(c_ids))), alive])
            own = whole == -np.inf
        for j, qid in enumerate(ids.tolist()):
            at = np.flatnonzero(~own[j])
            if len(at) > k:
                at = at[whole[j, at] >= kth(whole[j:j + 1, at], k)[0]]
            at = at[np.lexsort((c_ids[alive[at]], -whole[j, at]))][:k]
            yield qid, c_ids[alive[at]], whole[j, at]


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256, block_rows: int = 4096, query_rows: int = 512, dim_block: int = 16) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows where ``is_query`` (on ``vec_id``) holds."""
    rows = quantise(df, id_col, vec_col, scale)
    candidates = materialize(blocks(rows, block_rows), "candidates")
    queries = rows.where(is_query)
    passes = 1 + queries.count() // QUERIES_AT_ONCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = list(search(
                    np.frombuffer(r["q_ids"], "<i8"), unpack(r["dim"], r["q_n"], r["q_cells"], r["q_narrow"]),
                    np.frombuffer(r["ids"], "<i8"), unpack(r["dim"], r["n"], r["cells"], r["narrow"]), k, dim_block))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                    pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)),
                    pa.array(np.concatenate([f[2] for f in found]).astype(np.int64))],
                    names=["query_id", "vec_id", "score"])

    best = None
    for p in range(passes):
        part = blocks(queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p), query_rows)
        part = part.select("dim", F.col("n").alias("q_n"), F.col("ids").alias("q_ids"),
                           F.col("cells").alias("q_cells"), F.col("narrow").alias("q_narrow"))
        found = candidates.join(F.broadcast(part), "dim").mapInArrow(run, "query_id long, vec_id long, score long")
        best = found if best is None else best.union(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

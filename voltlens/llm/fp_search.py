"""Ranked lexical search of every item over all documents by a document FP-tree.

The score of a document for an item is the sum over the item's terms (repeats included)
of ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and
``m = 25 + (75 * n * N) div L``; all in 64-bit integers but for the logarithm.

1. A scan restricts every document to the terms of the items (term numbers and counts, no
   text) and writes these vectors; N, L and df are sums over all of them.
2. A task packs the vectors of its partition into trees of at most ``tree_cells`` cells. Terms
   are ordered by document frequency, the rarest first, and documents with the same first
   terms share a path. A node holds the largest tf of its term and the smallest m below it;
   a path ends where one document is left or the terms end.
3. Per item the tree is searched depth first, the most promising children first. A subtree's
   bound is the path's sum of w times the node maxima plus the most that the item's later
   terms can add at the subtree's smallest m (a path never meets a term that is rarer than its
   node's). Subtrees below the k-th best score are left out; documents that remain are scored
   exactly from their vectors.
4. The k-th best score of each item among a hashed ``1 / BAR_SHARE`` of the documents is a lower
   bound of its final k-th best; the search over all documents starts from it, so tasks
   return few rows. A window over these rows gives the ranks.

Items are searched in blocks of bounded size, one block after the other, and only one block's
terms and weights are sent to the tasks at a time.

Cases: a null or empty text has no term; documents without a term count in neither N nor L.
Items without a term, or whose terms no document holds, return nothing. Item rows are
searched one by one, repeated ones too. Repeated documents are separate candidates. Ties go to
the smaller document id, null ids last. Empty tables give no rows. Extra columns are ignored,
also those that clash in name or case. Texts of any length are used whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from voltlens.llm.common import annotate, importable, materialize, pick

#: Items and characters of items that are searched at once.
BLOCK_ITEMS, BLOCK_CHARS = 2048, 1 << 24
#: One document in so many sets the first bars.
BAR_SHARE = 32
#: Nodes expanded at once.
FRONT = 4096
NO_ID = np.iinfo(np.int64).max

#: Bytes that separate terms become spaces, A-Z small letters.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, ids, tfs`` (little-endian 32-bit numbers) of the documents with a term."""
    sent, size = docs.sparkSession.sparkContext.broadcast(vocabulary), len(vocabulary)

    def make():
        number = sent.value.get

        def work(texts):
            words = [terms(t) for t in texts]
            n = np.array([len(w) for w in words], np.int64)
            ids = np.fromiter((i for w in words for i in map(number, w, repeat(-1))), np.int64, int(n.sum()))
            at = np.repeat(np.arange(len(words)), n)
            cell, tf = np.unique((at * size + ids)[ids >= 0], return_counts=True)
            cuts = np.searchsorted(cell, np.arange(len(words) + 1) * size)
            ids, tf = (cell % max(size, 1)).astype("<u4"), tf.astype("<u4")
            parts = [(ids[a:b].tobytes(), tf[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
            return [n, [p[0] for p in parts], [p[1] for p in parts]]

        return work

    fields = [T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("tfs", T.BinaryType())]
    return annotate(docs, "text", fields, make, keep=["doc_id"]).where("n > 0")


def statistics(vecs: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of every term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                df[np.frombuffer(ids.as_py(), "<u4")] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    total = vecs.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = np.zeros(size, np.int64)
    for r in vecs.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df  # a block's terms
    return total.n, total.l, df


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """The FP-tree of some documents: ``ids`` (64-bit), ``m``, and cells (term rank, tf) by document."""

    def __init__(self, doc_ids: np.ndarray, m: np.ndarray, lens: np.ndarray, rank: np.ndarray, tf: np.ndarray):
        doc = np.repeat(np.arange(len(lens)), lens)
        order = np.lexsort((rank, doc))
        rank, tf = rank[order], tf[order]
        ends = np.cumsum(lens)
        keys = rank.astype(">u4").tobytes()
        paths = [keys[4 * a:4 * b] for a, b in zip((ends - lens).tolist(), ends.tolist())]
        order = np.array(sorted(range(len(lens)), key=paths.__getitem__), np.int64)
        take = np.repeat((ends - lens)[order] - np.concatenate([[0], np.cumsum(lens[order])[:-1]]), lens[order])
        take = take + np.arange(len(rank))
        self.ids, self.m, self.lens = doc_ids[order], m[order], lens[order]
        self.rank, self.tf = rank[take], tf[take]
        self.ptr = np.concatenate([[0], np.cumsum(self.lens)])
        self.top = np.zeros(int(rank.max(initial=-1)) + 1, np.int64)  # largest tf of a term in the tree
        np.maximum.at(self.top, self.rank, self.tf)
        self.edges = np.unique(np.quantile(self.m, np.linspace(0, 1, 17), method="lower")) if len(self.m) else self.m
        self.levels = []
        self.grow()

    def grow(self) -> None:
        n = len(self.lens)
        if not n:
            return
        short = np.minimum(self.lens[1:], self.lens[:-1])
        seg = np.concatenate([[0], np.cumsum(short)])
        step = np.arange(seg[-1]) - np.repeat(seg[:-1], short)
        one, two = np.repeat(self.ptr[:-2], short) + step, np.repeat(self.ptr[1:-1], short) + step
        differ = np.append(self.rank[one] != self.rank[two], True)
        first = np.where(differ, np.append(step, 0), np.iinfo(np.int64).max)
        lcp = np.zeros(n, np.int64)  # first terms shared with the document before
        if n > 1:
            low = np.minimum.reduceat(first, np.minimum(seg[:-1], len(first) - 1))
            lcp[1:] = np.where(short > 0, np.minimum(low, short), 0)
        act, d = np.arange(n), 0
        act = act[self.lens > 0]
        while len(act):
            starts = np.flatnonzero(lcp[act] <= d)
            size = np.diff(np.append(starts, len(act)))
            cell = self.ptr[act] + d
            lo = act[starts]
            tf = np.maximum.reduceat(self.tf[cell], starts)
            m = np.minimum.reduceat(self.m[act], starts)
            ended = np.add.reduceat((self.lens[act] == d + 1).astype(np.int64), starts)
            # a node's documents follow each other, those that end at it come first
            level = {"lo": lo, "hi": lo + size, "term": self.rank[cell[starts]], "tf": tf, "m": m,
                     "done": lo + np.where(size == 1, 1, ended)}
            level["band"] = np.searchsorted(self.edges, m, side="right") - 1
            self.levels.append(level)
            act = act[np.repeat(size > 1, size)]
            d += 1
            act = act[self.lens[act] > d]
        for above, below in zip(self.levels, self.levels[1:]):
            above["child"] = np.searchsorted(below["lo"], above["done"])
            above["child_end"] = np.searchsorted(below["lo"], above["hi"])
        if self.levels:
            last = self.levels[-1]
            last["child"] = last["child_end"] = np.zeros(len(last["lo"]), np.int64)

    def score(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        lens = self.lens[docs]
        cuts = np.concatenate([[0], np.cumsum(lens)])
        cell = np.repeat(self.ptr[docs] - cuts[:-1], lens) + np.arange(cuts[-1])
        w = weight[self.rank[cell]]
        some = np.flatnonzero(w)
        cell, doc = cell[some], np.repeat(np.arange(len(docs)), lens)[some]
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, doc, w[some] * gain(self.tf[cell], self.m[docs[doc]]))
        return out

    def search(self, ranks: np.ndarray, weights: np.ndarray, dense: np.ndarray, k: int, best: tuple, floor: int) -> tuple:
        """``best`` (scores, ids; at most k) with this tree's documents. ``ranks`` ascending, ``dense``: weight
        by rank. Documents below ``floor`` are not wanted."""
        scores, ids = best
        if not self.levels:
            return best
        top = np.where(ranks < len(self.top), self.top[np.minimum(ranks, len(self.top) - 1)], 0)
        most = weights[:, None] * np.where(top[:, None] > 0, gain(np.maximum(top, 1)[:, None], self.edges[None, :]), 0)
        rest = np.concatenate([np.cumsum(most[::-1], axis=0)[::-1], np.zeros((1, len(self.edges)), np.int64)])
        stack = [(0, np.arange(len(self.levels[0]["lo"])), np.zeros(len(self.levels[0]["lo"]), np.int64), None)]
        while stack:
            d, nodes, path, bound = stack.pop()
            bar = max(floor, int(scores[-1]) if len(scores) == k else 1, 1)
            level = self.levels[d]
            if bound is not None:
                keep = bound >= bar
                nodes, path = nodes[keep], path[keep]
            else:
                term = level["term"][nodes]
                path = path + dense[term] * gain(level["tf"][nodes], level["m"][nodes])
                bound = path + rest[np.searchsorted(ranks, term, side="right"), level["band"][nodes]]
                keep = np.flatnonzero(bound >= bar)
                keep = keep[np.argsort(-bound[keep], kind="stable")]
                nodes, path, bound = nodes[keep], path[keep], bound[keep]
                if len(nodes) > FRONT:  # the best of them first, the others may fall below a better bar
                    stack.append((d, nodes[FRONT:], path[FRONT:], bound[FRONT:]))
                    nodes, path = nodes[:FRONT], path[:FRONT]
            if not len(nodes):
                continue
            lo, done = level["lo"][nodes], level["done"][nodes]
            # documents that end here hold no later term, single ones may
            single = level["hi"][nodes] - lo == 1
            ends = (done > lo) & (single | (path >= bar))
            size = (done - lo)[ends]
            if len(size):
                docs = np.repeat(lo[ends] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                found = self.score(docs, dense)
                good = found >= bar
                if good.any():
                    scores, ids = np.concatenate([scores, found[good]]), np.concatenate([ids, self.ids[docs[good]]])
                    order = np.lexsort((ids, -scores))[:k]
                    scores, ids = scores[order], ids[order]
            first, last = level["child"][nodes], level["child_end"][nodes]
            size = np.where(single, 0, last - first)
            if size.sum():
                kids = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                stack.append((d + 1, kids, np.repeat(path, size), None))
        return scores, ids


def search_partition(batches: Iterator[pa.RecordBatch], order: np.ndarray, items: list, n: int, l: int, k: int,  # noqa: E741
                     floors: list[int], tree_cells: int) -> Iterator[pa.RecordBatch]:
    """The best of a partition's documents for every item: item number, document id, score."""
    none = np.zeros(0, np.int64)
    best = [(none, none)] * len(items)
    dense = np.zeros(len(order) + 1, np.int64)
    held: list[tuple] = []

    def flush():
        doc_ids, ns, ids, tfs = zip(*held)
        lens = np.array([len(x) for x in ids], np.int64)
        m = 25 + (75 * np.array(ns, np.int64) * n) // l
        tree = Tree(np.array(doc_ids, np.int64), m, lens, order[np.concatenate(ids)],
                    np.concatenate(tfs).astype(np.int64))
        for i, (ranks, weights) in enumerate(items):
            dense[ranks] = weights
            best[i] = tree.search(ranks, weights, dense, k, best[i], floors[i])
            dense[ranks] = 0
        held.clear()

    cells = 0
    for batch in batches:
        for doc_id, size, ids, tfs in zip(*(batch.column(i).to_pylist() for i in range(4))):
            ids = np.frombuffer(ids, "<u4")
            held.append((NO_ID if doc_id is None else doc_id, size, ids, np.frombuffer(tfs, "<u4")))
            cells += len(ids) + 1
            if cells >= tree_cells:
                flush()
                cells = 0
    if held:
        flush()
    sizes = [len(b[0]) for b in best]
    if sum(sizes):
        ids = np.concatenate([b[1] for b in best])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(items)), sizes)), pa.array(ids, mask=ids == NO_ID),
            pa.array(np.concatenate([b[0] for b in best]))], names=["item", "doc_id", "score"])


def search_block(docs: DataFrame, block: list[tuple], k: int, tree_cells: int) -> DataFrame:
    """``item, doc_id, score, rank`` for the items ``(number, text)`` of one block."""
    spark = docs.sparkSession
    wanted = [Counter(terms(text)) for _, text in block]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    vecs = materialize(vectors(docs, vocabulary), "vectors")
    n, l, df = statistics(vecs, len(vocabulary))  # noqa: E741
    order = np.empty(len(df), np.int64)
    order[np.argsort(df, kind="stable")] = np.arange(len(df))  # rarest first
    items = []
    for count in wanted:
        ids = np.array([vocabulary[t] for t in count], np.int64)
        weight = np.array([c * math.floor(1000 * math.log((2 * n + 2) / (2 * int(df[vocabulary[t]]) + 1)))
                           for t, c in count.items()], np.int64)
        at = np.argsort(order[ids])
        items.append((order[ids][at], weight[at]))

    def best(rows: DataFrame, floors: list[int]) -> DataFrame:
        sent = spark.sparkContext.broadcast((order, items, floors))

        def run(batches):
            order, items, floors = sent.value
            return search_partition(batches, order, items, n, l, k, floors, tree_cells)

        found = rows.select("doc_id", "n", "ids", "tfs").mapInArrow(run, "item long, doc_id long, score long")
        by_item = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)

    share = vecs.where(F.pmod(F.xxhash64("doc_id", "n", "ids"), F.lit(BAR_SHARE)) == 0)
    share = share.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    floors = [1] * len(items)
    for r in best(share, floors).where(F.col("rank") == k).select("item", "score").collect():  # a row an item
        floors[r["item"]] = r["score"]
    found = best(vecs, floors)
    names = spark.createDataFrame([(i, number) for i, (number, _) in enumerate(block)], "item long, number long")
    return found.join(F.broadcast(names), "item").select("number", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", tree_cells: int = 1 << 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item."""
    importable(docs.sparkSession)
    rows = pick(docs, {"doc_id": id_col, "text": text_col}).withColumn("doc_id", F.col("doc_id").cast("long"))
    numbered = materialize(pick(items, {"item_id": item_id_col, "text": item_text_col}).withColumn(
        "number", F.monotonically_increasing_id()), "items")
    size = numbered.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = 1 + max(size.n // BLOCK_ITEMS, size.chars // BLOCK_CHARS)
    out = None
    for b in range(blocks):
        block = [(r.number, r.text) for r in numbered.where(
            F.pmod(F.xxhash64("number"), F.lit(blocks)) == b).select("number", "text").collect()]
        found = search_block(rows, block, k, tree_cells)
        found = found if blocks == 1 else materialize(found, "found")
        out = found if out is None else out.union(found)
    names = numbered.select("number", "item_id")
    return out.join(names, "number").select("item_id", "rank", F.col("doc_id").alias(id_col), "score")

"""N-gram Jaccard self-join as a blocked sparse matrix product.

Rows of the incidence matrix are distinct shingle sets (copies are one row with a
multiplicity), columns are shingles (XXH64 of the words). Two rows are linked when
``100 * overlap >= percent * union``; overlaps are entries of the matrix times its transpose.

1. Bound columns. With ``o = ceil(percent * n / 100)`` a row of ``n`` shingles overlaps every
   partner in at least ``o`` columns. Its first ``n - o + l(n)`` columns in hash order,
   ``l(n) = 1 + n // EXTRA``, then share at least ``b = l(o)`` columns with each partner (the same
   bound from both sides). Only these bound columns are shuffled. A row with fewer than
   ``b`` of them in any other row has no partner. Of the others the ``r - b + 1`` rarest
   of its ``r`` repeated bound columns hold one that it shares with every partner.
2. Block-diagonal form. Rows that share such a column, directly or over others, form a
   cluster; all overlaps that can reach the bound lie inside clusters. By chance columns clusters grow with the
   corpus, so one that takes more than one block is cut again: its bound columns alone are multiplied (as in 3 and
   4, with the bound ``l(min(n_i, n_j))``), and rows that reach that bound with each other form the clusters.
3. Blocks. A cluster of at most ``block_rows`` rows and ``block_entries`` entries is one block. A
   larger one is cut by size band (sizes within ``percent`` of each other lie in one band or
   in neighbours) and each band into hash blocks; only pairs of blocks whose bands can
   link are multiplied. No task holds more than two blocks.
4. Product. Within a pair of blocks overlap counts are accumulated column block by column
   block, rarest columns first (by enumeration), frequent ones as dense products. After each
   column block a pair is discarded when its count plus the smaller number of columns still
   to come cannot reach ``percent * (n_i + n_j) / (100 + percent)``; rows without a pair leave
   the next products.
5. A pair of blocks returns the number of links of each row and a star forest of its links,
   never the pairs. Stars of all blocks are joined to components.

Sets are compared by the 64-bit hashes of their shingles. A row's key is a 64-bit hash of its
sorted columns; a second hash tells different sets of one key apart, then the keys are
drawn anew with the next seed.

Cases: null text and text without words have an empty set, are linked with nothing and are
their own component. Fewer words than a shingle are one shingle. Null ids are carried;
the component id is the smallest non-null id (null when there is none). Repeated rows
are copies like any others. An empty table gives an empty result. Extra columns
are ignored, also those that clash in name or case. Texts of any length are used whole; a
row of more than ``block_entries`` shingles is a block of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from voltlens.llm.common import annotate, materialize, pick
from voltlens.llm.simhash import components

#: One more bound column for so many shingles of a row.
EXTRA = 10
#: Columns met by more rows of a block pair are multiplied densely.
DENSE_FROM = 48
DENSE_COLUMNS = 512
#: A table of clustered rows of at most this many rows (about 200 bytes each) is broadcast.
BROADCAST_ROWS = 100_000
#: Words of the bit table that holds which rows are in a cluster (64 bits each).
FILTER_WORDS = 1 << 18


def overlap_floor(n, percent: int):
    """Least overlap of a row of ``n`` columns with any partner."""
    return -(-percent * n // 100)


def slack(n):
    return 1 + n // EXTRA


def bound_size(n, percent: int):
    """Bound columns of a row of ``n``."""
    return np.minimum(n, n - overlap_floor(n, percent) + slack(n))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        found = xxh64_digest(b" ".join(words), 42)
    else:
        joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-width].tolist()]
        found = b"".join([xxh64_digest(joined[a:b - 1], 42) for a, b in zip(starts, ends[width - 1:].tolist())])
    return np.unique(np.frombuffer(found, ">u8").astype(np.uint64))


def row_keys(columns: np.ndarray, seed: int) -> tuple[int, int]:
    from xxhash import xxh64_intdigest

    data = columns.tobytes()
    return tuple(int(np.uint64(xxh64_intdigest(data, 2 * seed + i)).view(np.int64)) for i in (0, 1))


def matrix_rows(rows: DataFrame, width: int, percent: int, seed: int) -> DataFrame:
    """``doc_id, n, key, check, bound``: size, two hashes and bound columns of each row's set. A task
    gives the bound columns of a set once; copies have null."""

    def make():
        given: set[int] = set()

        def work(texts):
            n, key, check, bound = [], [], [], []
            for t in texts:
                s = shingle_set(t, width)
                k, c = row_keys(s, seed) if len(s) else (None, None)
                b = None
                if len(s) and k not in given:
                    b = s[:bound_size(len(s), percent)].view(np.int64)
                    if len(given) >= 1 << 20:
                        given.clear()
                    given.add(k)
                n.append(len(s)), key.append(k), check.append(c), bound.append(b)
            return [n, key, check, bound]

        return work

    long = T.LongType()
    return annotate(rows, "text", [T.StructField("n", long), T.StructField("key", long), T.StructField("check", long),
                                   T.StructField("bound", T.ArrayType(long))], make, keep=["doc_id"])


def distinct_rows(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, int]:
    """The documents with their keys, one row for each distinct set, and the seed of the keys."""
    for seed in range(1, 9):
        keyed = materialize(matrix_rows(docs, width, percent, seed), "sets")
        sets = materialize(keyed.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.min("n").alias("n"),
            F.min("check").alias("c1"), F.max("check").alias("c2")), "rows")
        if sets.where("c1 != c2").isEmpty():
            return keyed, sets.select("key", "low", "copies", "n"), seed
    raise RuntimeError("no seed tells the sets apart")


def clusters(keyed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``key, root`` of every row that may have a partner."""
    cells = keyed.where(F.col("bound").isNotNull()).select("key", F.explode("bound").alias("col"))
    repeated = cells.groupBy("col").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("df"))
    # written, so the shuffle of all cells is gone before they are shuffled again
    repeated = materialize(repeated.where("low != high").select("col", "df", "low"), "columns")
    # the cells are sized by the rows they are exploded from: neither side is to be broadcast
    shared = cells.join(repeated.hint("merge"), "col").groupBy("key").agg(F.collect_set(F.struct("df", "col", "low")).alias("c"))
    floor = F.ceil(F.col("n") * percent / 100)
    least = (1 + F.floor(floor / EXTRA)).cast("int")
    able = shared.join(sets.select("key", "n"), "key").withColumn("b", least).where(F.size("c") >= F.col("b"))
    rare = F.slice(F.sort_array("c"), F.lit(1), F.size("c") - F.col("b") + 1)
    stars = materialize(able.select("key", F.array_distinct(F.transform(rare, lambda x: x["low"])).alias("lows")), "stars")
    edges = stars.select(F.col("key").alias("u"), F.explode("lows").alias("v")).where("u != v")
    roots = components(edges.distinct())
    found = stars.select("key").join(roots, F.col("key") == F.col("node")).select("key", "root")
    met = found.groupBy("root").agg(F.count("*").alias("members")).where("members > 1").select("root")
    return found.join(met, "root")


def block_pairs(clustered: DataFrame, sets: DataFrame, percent: int, block_rows: int, block_entries: int) -> DataFrame:
    """``key, low, n, copies, root, band, block, pairs, whole``: each row's block, the block pairs that the block
    takes part in with its side (0, 1), and whether the block is a whole cluster."""
    rows = materialize(clustered.join(sets, "key"), "clustered")
    size = [F.count("*").alias("rows"), F.sum("n").alias("entries")]
    need = F.ceil(F.greatest(F.col("rows") / block_rows, F.col("entries") / block_entries)).cast("int")
    whole = rows.groupBy("root").agg(*size).select("root", (need <= 1).alias("whole"))
    rows = rows.join(whole, "root")
    one = rows.where("whole").withColumns({"band": F.lit(0), "block": F.lit(0), "pairs": F.array(F.struct(
        *(F.lit(0).alias(c) for c in ("band", "i", "band2", "j", "side"))))})
    # neighbours reach a little further than the ratio, so rounding loses no pair
    step = math.log(100 / percent) * 1.0001 if percent < 100 else 1.0
    cut = rows.where("not whole").withColumn("band", F.floor(F.log("n") / step).cast("int"))
    bands = materialize(cut.groupBy("root", "band").agg(*size).select("root", "band", need.alias("k")), "bands")
    for shift, name in ((0, "k"), (-1, "k_less"), (1, "k_more")):
        side = bands.select("root", (F.col("band") - shift).alias("band"), F.col("k").alias(name))
        cut = cut.join(side, ["root", "band"], "left")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("key"), F.col("k")).cast("int"))
    b, band = F.col("block"), F.col("band")

    def each(k, make):
        places = F.filter(F.sequence(F.lit(0), F.coalesce(k, F.lit(0))), lambda x: x < F.coalesce(k, F.lit(0)))
        return F.transform(places, lambda j: F.struct(*(x.cast("int").alias(c) for x, c in zip(
            make(j), ("band", "i", "band2", "j", "side")))))

    cut = cut.withColumn("pairs", F.concat(
        each(F.col("k"), lambda j: (band, F.least(b, j), band, F.greatest(b, j), (b > j).cast("int"))),
        each(F.col("k_more"), lambda j: (band, b, band + 1, j, F.lit(0))),
        each(F.col("k_less"), lambda j: (band - 1, j, band, b, F.lit(1)))))
    names = ["key", "low", "n", "copies", "root", "band", "block", "pairs", "whole"]
    return materialize(one.select(*names).union(cut.select(*names)), "pairs")


def overlaps(col: np.ndarray, row: np.ndarray, side: np.ndarray, n: np.ndarray, percent: int, bound: bool = False) -> tuple:
    """Linked pairs of a block pair as a boolean matrix, and its row and column members.

    ``col``, ``row``: the entries (column hash, row number); ``side`` of each row: all 0 for a block with
    itself. Counts accumulate by column blocks; pairs that cannot reach their bound are dropped. With ``bound``
    the entries are bound columns, and pairs that may be linked are found.
    """
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    b = b if len(b) else a
    place_a, place_b = np.full(len(n), -1), np.full(len(n), -1)
    place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    starts = np.flatnonzero(np.concatenate([[True], col[1:] != col[:-1]])) if len(col) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(col)))
    starts, counts = starts[counts > 1], counts[counts > 1]
    met = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    left = np.bincount(row[met.astype(np.int64)], minlength=len(n))  # columns still to come, by row
    if bound:
        low, high = np.minimum(n[a][:, None], n[b][None, :]), np.maximum(n[a][:, None], n[b][None, :])
        need = np.minimum(overlap_floor(high, percent), slack(low)).astype(np.int32)
    else:
        need = (-(-percent * (n[a][:, None] + n[b][None, :]) // (100 + percent))).astype(np.int32)
    left = left.astype(np.int32)
    acc = np.zeros((len(a), len(b)), np.int32)
    alive = np.minimum(left[a][:, None], left[b][None, :]) >= need
    if bound:
        alive &= 100 * low >= percent * high
    if a is b:
        np.fill_diagonal(alive, False)

    for c in np.unique(counts[counts <= DENSE_FROM]):  # rare columns: pairs of a column one by one
        at = starts[counts == c]
        for lo in range(0, len(at), max(1, (1 << 21) // int(c * c))):
            r = row[at[lo:lo + max(1, (1 << 21) // int(c * c)), None] + np.arange(c)[None, :]]
            np.subtract.at(left, r.ravel(), 1)
            i, j = np.broadcast_arrays(place_a[r][:, :, None], place_b[r][:, None, :])
            i, j = i.ravel(), j.ravel()
            ok = (i >= 0) & (j >= 0)
            i, j = i[ok], j[ok]
            ok = alive[i, j]
            np.add.at(acc, (i[ok], j[ok]), 1)
    dense = np.flatnonzero(counts > DENSE_FROM)
    dense = dense[np.argsort(counts[dense], kind="stable")]
    for lo in range(0, len(dense) + 1, DENSE_COLUMNS):
        alive &= acc + np.minimum(left[a][:, None], left[b][None, :]) >= need
        some = dense[lo:lo + DENSE_COLUMNS]
        if not len(some) or not alive.any():
            break
        ra, rb = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        r = row[np.repeat(starts[some] - np.concatenate([[0], np.cumsum(counts[some])[:-1]]), counts[some])
                + np.arange(counts[some].sum())]
        c = np.repeat(np.arange(len(some)), counts[some])
        m = np.zeros((len(n), len(some)), np.float32)
        m[r, c] = 1
        left -= np.bincount(r, minlength=len(n)).astype(np.int32)
        acc[np.ix_(ra, rb)] += (m[a[ra]] @ m[b[rb]].T).astype(np.int32)
    return alive & (acc >= need), a, b


def forest(linked: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """A root (row number) for each row of a block pair, equal for rows that links join."""
    root, same = np.arange(size), a is b
    new_a = np.ones(len(a), bool)
    for i in range(len(a)):
        if not new_a[i]:
            continue
        front, in_b = np.array([i]), np.zeros(len(b), bool)
        new_a[i] = False
        while len(front):
            hit = linked[front].any(axis=0) & ~in_b
            in_b |= hit
            reach = hit if same else linked[:, hit].any(axis=1)
            front = np.flatnonzero(reach & new_a)
            new_a[front] = False
            root[a[front]] = a[i]
        root[b[in_b]] = a[i]
    return root


def link_block(keys: np.ndarray, n: np.ndarray, copies: np.ndarray, side: np.ndarray, columns: list,
               percent: int, bound: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``key, root key, links`` for the rows of one block pair that have links in it."""
    keys, first = np.unique(keys, return_index=True)  # repeated rows
    n, copies, side = n[first], copies[first], side[first]
    sets = [np.frombuffer(columns[i], "<u8") for i in first]
    row = np.repeat(np.arange(len(keys)), [len(s) for s in sets])
    linked, a, b = overlaps(np.concatenate(sets), row, side, n, percent, bound)
    root = forest(linked, a, b, len(keys))
    links = np.zeros(len(keys), np.int64)
    links[a] = linked @ copies[b]
    if a is not b:
        links[b] = linked.T @ copies[a]
    some = links > 0
    return keys[some], keys[root[some]], links[some]


GROUP = ["root", "band", "i", "band2", "j"]


def column_bytes(columns: pa.Array) -> list[bytes]:
    """The columns of each row, given as bytes or as an array of numbers."""
    if not pa.types.is_list(columns.type):
        return columns.to_pylist()
    ends, data = columns.offsets.to_numpy(), columns.values.to_numpy()
    return [data[lo:hi].tobytes() for lo, hi in zip(ends, ends[1:])]


def packed(sent: DataFrame) -> DataFrame:
    """One compressed record for the rows of a block that meet in a batch, for every pair of the block. Near
    copies share most columns, so a record is a small part of its rows."""
    schema = "root long, band int, i int, band2 int, j int, side int, size int, record binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in ("root", "band", "block", "key")])
            place = np.stack([t.column(c).to_numpy() for c in ("root", "band", "block")])
            cuts = [0, *(np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist(), t.num_rows]
            num = [t.column(c).to_numpy().astype("<i8") for c in ("key", "n", "copies")]
            columns, out = column_bytes(t.column("columns").combine_chunks()), []
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                raw = b"".join([*(x[lo:hi].tobytes() for x in num), *columns[lo:hi]])
                record = hi - lo, np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)
                root = int(place[0, lo])
                out += [(root, p["band"], p["i"], p["band2"], p["j"], p["side"], *record) for p in t.column("pairs")[lo].as_py()]
            kinds = [pa.int64(), *[pa.int32()] * 6, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)] if out else
                                             [pa.array([], k) for k in kinds], names=[*GROUP, "side", "size", "record"])

    return sent.select("root", "band", "block", "pairs", "key", "n", "copies", "columns").mapInArrow(run, schema)


def unpacked(size: int, record: bytes, percent: int | None = None) -> tuple[list[np.ndarray], list[bytes]]:
    """The rows of a record; with ``percent`` they hold their bound columns."""
    raw = pa.decompress(record[8:], int(np.frombuffer(record[:8], "<i8")[0]), codec="zstd", asbytes=True)
    num = np.frombuffer(raw[:24 * size], "<i8").reshape(3, size)
    held = num[1] if percent is None else bound_size(num[1], percent)
    ends = 24 * size + 8 * np.cumsum(held)
    return list(num), [raw[e - 8 * n:e] for e, n in zip(ends.tolist(), held.tolist())]


def product(sent: DataFrame, percent: int, bound: bool = False) -> DataFrame:
    """``key, star, links`` by block pair; the records of a pair follow each other in their partition. With ``bound``
    the columns are bound columns and the links are those that may be."""
    parts = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed(sent).repartition(parts, *GROUP).sortWithinPartitions(*GROUP)

    def result(group: tuple, records: list[tuple[int, int, bytes]]) -> pa.RecordBatch | None:
        across = group[1] != group[3] or group[2] != group[4]
        if across and len({side for side, _, _ in records}) < 2:
            return None  # one of the two blocks got no row
        key, n, copies, side, columns = [], [], [], [], []
        for s, size, record in records:
            num, cols = unpacked(size, record, percent if bound else None)
            key.append(num[0]), n.append(num[1]), copies.append(num[2]), side.append(np.full(size, s))
            columns += cols
        if len(columns) < 2:
            return None
        out = link_block(*(np.concatenate(x) for x in (key, n, copies, side)), columns, percent, bound)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["key", "star", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for *group, side, size, record in zip(*(c.to_pylist() for c in batch.columns)):
                if group != now:
                    if held and (out := result(now, held)) is not None:
                        yield out
                    now, held = group, []
                held.append((side, size, record))
        if held and (out := result(now, held)) is not None:
            yield out

    return dealt.mapInArrow(run, "key long, star long, links long")


def to_join(pairs: DataFrame) -> DataFrame:
    """``pairs`` broadcast if few, else shuffled: its files are much smaller than its rows."""
    size = pairs.agg(F.count("*").alias("rows"), F.sum(F.size("pairs")).alias("pairs")).first()
    return F.broadcast(pairs) if size.rows <= BROADCAST_ROWS and (size.pairs or 0) <= 2 * BROADCAST_ROWS else pairs.hint("merge")


def refined(keyed: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int, block_rows: int, block_entries: int) -> DataFrame:
    """``pairs`` with the clusters of several blocks cut into those that links of their bound columns join."""
    large = pairs.where("not whole")
    if large.isEmpty():
        return pairs
    bound = keyed.where(F.col("bound").isNotNull()).select("key", F.col("bound").alias("columns"))
    stars = materialize(product(bound.join(to_join(large), "key"), percent, bound=True), "near")
    roots = components(stars.where("key != star").select(F.col("key").alias("u"), F.col("star").alias("v")).distinct())
    again = block_pairs(roots.select(F.col("node").alias("key"), "root"), sets, percent, block_rows, block_entries)
    return pairs.where("whole").union(again)


def with_columns(docs: DataFrame, pairs: DataFrame, width: int, seed: int, percent: int) -> DataFrame:
    """The rows of ``pairs`` with their columns. Texts are hashed again where they lie; a bit table
    of fixed size keeps rows without a cluster out of the shuffle."""

    def make():
        def work(texts):
            sets = [shingle_set(t, width) for t in texts]
            return [[row_keys(s, seed)[0] if len(s) else None for s in sets], [s.tobytes() for s in sets]]

        return work

    sets = annotate(docs, "text", [T.StructField("key", T.LongType()), T.StructField("columns", T.BinaryType())],
                    make, keep=["doc_id"])
    h = F.xxhash64("key", "doc_id")
    word, bit = F.pmod(h, F.lit(FILTER_WORDS)), F.expr("shiftleft(1L, cast(pmod(shiftright(h, 32), 64) as int))")
    bits = pairs.select("key", F.col("low").alias("doc_id")).withColumn("h", h).select(
        F.pmod("h", F.lit(FILTER_WORDS)).alias("w"), bit.alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    likely = sets.where("key IS NOT NULL").withColumn("w", word).withColumn("h", h).withColumn("bit", bit).join(
        F.broadcast(bits), "w").where(F.col("bits").bitwiseAND(F.col("bit")) != 0).select("doc_id", "key", "columns")
    place = to_join(pairs.withColumnRenamed("key", "row"))
    return likely.join(place, (F.col("key") == F.col("row")) & F.col("doc_id").eqNullSafe(F.col("low")))


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                       percent: int = 90, block_rows: int = 2048, block_entries: int = 1 << 20) -> DataFrame:
    """``(id, n_shingles, component_id, n_links)`` for every row; ``n_links`` counts the other documents
    linked with it, copies included."""
    docs = pick(df, {"doc_id": id_col, "text": text_col})
    keyed, sets, seed = distinct_rows(docs, shingle_words, percent)
    pairs = block_pairs(clusters(keyed, sets, percent), sets, percent, block_rows, block_entries)
    pairs = refined(keyed, pairs, sets, percent, block_rows, block_entries)
    stars = materialize(product(with_columns(docs, pairs, shingle_words, seed, percent), percent), "stars")
    roots = components(stars.where("key != star").select(F.col("key").alias("u"), F.col("star").alias("v")).distinct())
    links = stars.groupBy(F.col("key").alias("row")).agg(F.sum("links").alias("links"))
    named = sets.join(roots, F.col("key") == F.col("node"), "left").join(links, F.col("key") == F.col("row"), "left")
    named = materialize(named.select("key", "low", F.coalesce("root", "key").alias("root"),
                                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select("key", "component_id", "n_links")
    full = keyed.where("n > 0").join(named, "key").select("doc_id", "n", "component_id", "n_links")
    empty = keyed.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(0).cast("long"))
    return full.union(empty).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                    "n_links")

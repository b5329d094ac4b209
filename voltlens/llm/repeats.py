"""Exact removal of repeated byte strings: depth-limited radix sort of suffixes.

A byte is removed when a ``length``-byte string covering it also starts in a document with a
smaller id. Suffixes are ordered only through ``length`` bytes, most significant digits
first; groups that fall to one suffix leave the sort, and the groups that are left at full
depth are exactly the repeated strings.

Which suffixes meet is arranged by anchors: among the ``GRAM``-byte strings of a window the
one of lowest hash is its anchor, so equal windows have equal anchors at equal places and
only windows of equal anchor need be compared. Neighbouring windows with one anchor are
kept together as a stretch (about 18 windows in 66 bytes), and one record stands for them.

1. First digit, the anchors: every task deals its anchors by digit into buckets; a bucket
   finds those that occur in two or more documents (six bytes a record).
2. Documents meet in chunks (by a hash of id and text). A chunk keeps the stretches whose
   anchor repeats, merges equal ones (the smallest id of a chunk stands for all) and sends
   their bytes to the bucket of the anchor.
3. A bucket merges equal stretches of all chunks and sorts the windows of those that
   differ: anchor bytes and place first, then eight bytes a pass through ``length`` bytes.
   Each window gets the smallest id that holds it; a stretch's covered windows go back to
   its chunk as a bit mask.
4. Chunks mark the covered bytes and cut them out.

Texts travel compressed; buckets and chunks are bounded in bytes, as their numbers follow
the input. A passage shared by very many documents is one record per chunk and pass. No
step pairs documents. Equality is always decided on bytes, hashes only bring rows together.

Cases: null text is empty (nothing removed); texts shorter than ``length`` stay whole; null
ids come after all ids and are never smaller; rows with equal ids are one document for the
comparison; very long texts are read in overlapping pieces; an empty table gives no rows;
extra columns are ignored, the result has the id and its own columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voltlens.llm.common import materialize, pick

GRAM = 16  # a power of two
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
PIECE_BYTES = 1 << 20
FLUSH_RECORDS = 2_000_000
PLACE_BITS = np.uint64(24)
NO_ID = np.iinfo(np.int64).max
MULT = np.uint64(0x9E3779B97F4A7C15)
MULT2 = np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes starting at every place, by doubling."""
    h, power, width = x.astype(np.uint64) + np.uint64(1), MULT, 1
    while width < GRAM:
        h = h[:-width] * power + h[width:]
        power, width = power * power, 2 * width
    h ^= h >> np.uint64(32)
    h *= MULT2
    return h ^ (h >> np.uint64(29))


def lowest(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours, by doubling."""
    width = 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    return np.minimum(keys[:len(keys) - (span - width)], keys[span - width:]) if span > width else keys


def stretches(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """Stretches of the pieces ``x[starts:ends]``: first window, windows, anchor place, anchor hash."""
    n = np.maximum(ends - starts - length + 1, 0)
    none = np.zeros(0, np.int64)
    if not n.sum():
        return none, none, none, none.astype(np.uint64)
    keys = (gram_hashes(x) >> PLACE_BITS) << PLACE_BITS | np.arange(len(x) - GRAM + 1, dtype=np.uint64)
    best = lowest(keys, length - GRAM + 1)
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    best = best[first]
    cut = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    size = np.diff(np.concatenate([cut, [len(best)]]))
    return first[cut], size, (best[cut] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64), best[cut] >> PLACE_BITS


def pieces(data: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of text pieces: joined bytes, piece starts and ends in them, document, place in it.

    A text beyond PIECE_BYTES is cut so that every window lies in one piece."""
    parts, docs, at, size = [], [], [], 0

    def made():
        n = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(n)
        return np.frombuffer(b"".join(parts), np.uint8), ends - n, ends, np.array(docs), np.array(at, np.int64)

    for d, t in enumerate(data):
        for a in range(0, max(len(t) - length + 1, 0), PIECE_BYTES):
            parts.append(t[a:a + PIECE_BYTES + length - 1])
            docs.append(d), at.append(a)
            size += len(parts[-1])
            if size >= PIECE_BYTES:
                yield made()
                parts, docs, at, size = [], [], [], 0
    if parts:
        yield made()


def digit(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an anchor hash and its 32 bits within the bucket."""
    b = np.uint64(buckets)
    return (anchor % b).astype(np.int64), ((anchor // b) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def deal(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """``(bucket, digits, chunks)``: the anchors of all documents, once a document and task.
    The top bit of a chunk says that two documents of the task and chunk have the anchor."""

    def flush(records: list) -> Iterator[pa.RecordBatch]:
        if not records:
            return
        anchor, chunk, doc = (np.concatenate(x) for x in zip(*records))
        order = np.lexsort((doc, chunk, anchor))
        anchor, chunk, doc = anchor[order], chunk[order], doc[order]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])])
        group = np.cumsum(new) - 1
        several = np.zeros(group[-1] + 1, bool)
        several[group[1:][~new[1:] & (doc[1:] != doc[:-1])]] = True
        anchor, chunk = anchor[new], chunk[new].astype(np.uint32) | (several.astype(np.uint32) << np.uint32(31))
        bucket, low = digit(anchor, buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, low, chunk = bucket[order], low[order], chunk[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[cut[:-1]].astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in zip(cut, cut[1:])]),
             pa.array([chunk[a:b].tobytes() for a, b in zip(cut, cut[1:])])], names=["bucket", "digits", "chunks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, n, base = [], 0, 0
        for batch in batches:
            chunk = batch.column(0).to_numpy(zero_copy_only=False)
            data = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
            for x, starts, ends, docs, _ in pieces(data, length):
                first, _, _, anchor = stretches(x, starts, ends, length)
                doc = docs[np.searchsorted(starts, first, "right") - 1]
                records.append((anchor, chunk[doc], doc + base))
                n += len(anchor)
                if n >= FLUSH_RECORDS:
                    yield from flush(records)
                    records, n = [], 0
            base += len(data)
        yield from flush(records)

    return rows.mapInArrow(run, "bucket int, digits binary, chunks binary")


def column_bytes(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(b, kind) for b in table.column(name).to_pylist()]


def repeated_anchors(dealt: DataFrame) -> DataFrame:
    """``(chunk, keys)``: for every chunk the anchors (bucket and digits) that two documents have."""

    def run(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        low = np.concatenate(column_bytes(group, "digits", "<u4"))
        chunk = np.concatenate(column_bytes(group, "chunks", "<u4"))
        order = np.argsort(low, kind="stable")
        low, chunk = low[order], chunk[order]
        _, place, n = np.unique(low, return_inverse=True, return_counts=True)
        several = n > 1
        several[place[chunk >> np.uint32(31) == 1]] = True
        keep = several[place]
        low, chunk = low[keep], chunk[keep] & np.uint32(0x7FFFFFFF)
        pairs = np.unique(chunk.astype(np.uint64) << np.uint64(32) | low)
        chunk, low = (pairs >> np.uint64(32)).astype(np.int32), pairs & np.uint64(0xFFFFFFFF)
        keys = low | np.uint64(key[0].as_py()) << np.uint64(32)
        cut = np.flatnonzero(np.concatenate([chunk[1:] != chunk[:-1], [True]])) + 1 if len(chunk) else []
        starts = [0, *cut[:-1]] if len(chunk) else []
        return pa.table({"chunk": pa.array([chunk[a] for a in starts], pa.int32()),
                         "keys": pa.array([keys[a:b].tobytes() for a, b in zip(starts, cut)], pa.binary())})

    return dealt.groupBy("bucket").applyInArrow(run, "chunk int, keys binary")


def equal_rows(cells: np.ndarray, order_by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of equal rows: group of every row, and per group its row of lowest ``order_by``.
    Rows of one hash but other bytes stay groups of their own."""
    h = np.zeros(len(cells), np.uint64)
    for j in range(cells.shape[1]):
        h = (h ^ cells[:, j]) * MULT
        h ^= h >> np.uint64(31)
    order = np.lexsort((order_by, h))
    sorted_h = h[order]
    new = np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]])[:len(h)]
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
    new |= ~(cells[order] == cells[lead]).all(axis=1)
    group = np.empty(len(h), np.int64)
    group[order] = np.cumsum(new) - 1
    # a stray row of another group can stand between equal ones: give those the leading group
    same = (cells[order] == cells[lead]).all(axis=1)
    group[order[same]] = group[lead[same]]
    return group, order[new]


class Chunk:
    """The stretches of a chunk's documents whose anchors repeat, equal ones merged."""

    def __init__(self, ids: np.ndarray, data: list[bytes], repeated: np.ndarray, length: int, buckets: int):
        width = -(-(2 * length - GRAM) // 8) * 8  # a stretch's bytes and padding
        found = []
        for x, starts, ends, docs, at in pieces(data, length):
            first, size, place, anchor = stretches(x, starts, ends, length)
            bucket, low = digit(anchor, buckets)
            keys = bucket.astype(np.uint64) << np.uint64(32) | low
            near = np.searchsorted(repeated, keys)
            keep = repeated[np.minimum(near, len(repeated) - 1)] == keys if len(repeated) else np.zeros(len(keys), bool)
            first, size, place, bucket = first[keep], size[keep], place[keep], bucket[keep]
            n = size + length - 1
            padded = np.concatenate([x, np.zeros(width, np.uint8)])
            cells = padded[first[:, None] + np.arange(width)]
            cells[np.arange(width) >= n[:, None]] = 0
            piece = np.searchsorted(starts, first, "right") - 1
            found.append((cells, n, place - first, bucket, docs[piece], first - starts[piece] + at[piece]))
        if found:
            self.cells, self.n, self.offset, self.bucket, self.doc, self.start = (np.concatenate(c) for c in zip(*found))
        else:
            none = np.zeros(0, np.int64)
            self.cells, self.n, self.offset, self.bucket, self.doc, self.start = np.zeros((0, width), np.uint8), *[none] * 5
        self.id = ids[self.doc] if len(self.doc) else np.zeros(0, np.int64)
        words = np.concatenate([self.cells.view("<u8"), (self.n + self.offset * 4096).astype(np.uint64)[:, None]], axis=1)
        self.group, self.lead = equal_rows(words, self.id)


def opened(rows: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids (null: after all others) and texts of a chunk, in an order that is the same each time."""
    from zstandard import ZstdDecompressor

    tool = ZstdDecompressor()
    ids = [NO_ID if i is None else i for i in rows.column("doc_id").to_pylist()]
    data = [tool.decompress(z) for z in rows.column("packed").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], data[i]))
    return np.array([ids[i] for i in order], np.int64), [data[i] for i in order]


def packed_rows(rows: DataFrame) -> DataFrame:
    """``(chunk, doc_id, packed)``: texts compressed for the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        tool = ZstdCompressor(level=3)
        for batch in batches:
            packed = [tool.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                                             names=["chunk", "doc_id", "packed"])

    return rows.mapInArrow(run, "chunk int, doc_id long, packed binary")


SENT = "bucket int, chunk int, leads binary, sizes binary, offsets binary, owners binary, text binary"


def send_stretches(packed: DataFrame, repeated: DataFrame, length: int, buckets: int) -> DataFrame:
    """Distinct stretches of every chunk, to the bucket of their anchor."""

    def run(key: tuple[pa.Scalar], rows: pa.Table, anchors: pa.Table) -> pa.Table:
        from zstandard import ZstdCompressor

        tool = ZstdCompressor(level=3)
        ids, data = opened(rows)
        known = np.sort(np.concatenate([np.zeros(0, np.uint64), *column_bytes(anchors, "keys", "<u8")]))
        c = Chunk(ids, data, known, length, buckets)
        lead = np.sort(c.lead)
        lead = lead[np.argsort(c.bucket[lead], kind="stable")]
        bucket = c.bucket[lead]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(lead) else np.zeros(1, int)
        out: dict[str, list] = {n: [] for n in ("bucket", "chunk", "leads", "sizes", "offsets", "owners", "text")}
        for a, b in zip(cut, cut[1:]):
            part = lead[a:b]
            n = c.n[part]
            text = c.cells[part][np.arange(c.cells.shape[1]) < n[:, None]].tobytes()
            for name, value in (("bucket", int(bucket[a])), ("chunk", key[0].as_py()),
                                ("leads", part.astype("<i4").tobytes()), ("sizes", n.astype(np.uint8).tobytes()),
                                ("offsets", c.offset[part].astype(np.uint8).tobytes()),
                                ("owners", c.id[part].astype("<i8").tobytes()), ("text", tool.compress(text))):
                out[name].append(value)
        return pa.table([pa.array(out["bucket"], pa.int32()), pa.array(out["chunk"], pa.int32()),
                         *(pa.array(out[n], pa.binary()) for n in ("leads", "sizes", "offsets", "owners", "text"))],
                        names=list(out))

    return packed.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(run, SENT)


def sort_windows(cells: np.ndarray, n: np.ndarray, offset: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """Smallest owner of every window (rows x windows, NO_ID where none) among distinct stretches.

    Radix passes over the windows' suffixes through ``length`` bytes, most significant digit
    first; a suffix alone in its group leaves the sort."""
    rows, width = cells.shape
    most = length - GRAM + 1
    out = np.full((rows, most), NO_ID, np.int64)
    flat = np.concatenate([np.ascontiguousarray(cells).reshape(-1), np.zeros(8, np.uint8)])
    eight = np.ndarray((len(flat) - 7,), ">u8", flat, strides=(1,))
    # the anchor's own bytes are the first digits; stretches alone with their anchor leave at once
    anchor = np.arange(rows) * width + offset
    alive, group = split(np.arange(rows), np.zeros(rows, np.int64), eight[anchor].astype(np.uint64))
    alive, group = split(alive, group, eight[anchor[alive] + 8].astype(np.uint64))
    windows = n[alive] - length + 1
    row = np.repeat(alive, windows)
    at = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    group = np.repeat(group, windows)
    index, group = split(np.arange(len(row)), group, (offset[row] - at).astype(np.uint64))
    for depth in [*range(0, length - 8, 8), length - 8]:
        if not len(index):
            break
        index, group = split(index, group, eight[row[index] * width + at[index] + depth].astype(np.uint64))
    if len(index):
        best = np.full(group.max() + 1, NO_ID, np.int64)
        np.minimum.at(best, group, owner[row[index]])
        out[row[index], at[index]] = best[group]
    return out


def split(index: np.ndarray, group: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One radix pass: groups are split by their members' next digit, members left alone go."""
    if not len(index):
        return index, group
    order = np.lexsort((digits, group))
    g, d = group[order], digits[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
    number = np.cumsum(new) - 1
    several = np.bincount(number) > 1
    keep = several[number]
    return index[order[keep]], (np.cumsum(several) - 1)[number[keep]]


def covered_windows(sent: DataFrame, length: int) -> DataFrame:
    """``(chunk, leads, masks)``: windows of the sent stretches held by a smaller id."""

    def run(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        from zstandard import ZstdDecompressor

        tool = ZstdDecompressor()
        width = -(-(2 * length - GRAM) // 8) * 8
        n = np.concatenate(column_bytes(group, "sizes", "u1")).astype(np.int64)
        offset = np.concatenate(column_bytes(group, "offsets", "u1")).astype(np.int64)
        owner = np.concatenate(column_bytes(group, "owners", "<i8"))
        lead_parts = column_bytes(group, "leads", "<i4")
        lead = np.concatenate(lead_parts)
        chunk = np.repeat(np.array(group.column("chunk").to_pylist(), np.int64), [len(p) for p in lead_parts])
        text = np.frombuffer(b"".join(tool.decompress(t) for t in group.column("text").to_pylist()), np.uint8)
        cells = np.zeros((len(n), width), np.uint8)
        cells[np.arange(width) < n[:, None]] = text
        words = np.concatenate([cells.view("<u8"), (n + offset * 4096).astype(np.uint64)[:, None]], axis=1)
        which, first = equal_rows(words, owner)
        low = np.full(len(n), NO_ID, np.int64)
        np.minimum.at(low, which, owner)
        number = np.full(len(n), -1, np.int64)  # group -> row of the distinct stretches
        number[which[first]] = np.arange(len(first))
        held = sort_windows(cells[first], n[first], offset[first], low[which[first]], length)
        windows = n - length + 1
        all_of_it = (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1)
        bits = np.uint64(1) << np.arange(held.shape[1], dtype=np.uint64)
        mask = ((held[number[which]] < owner[:, None]) * bits).sum(axis=1, dtype=np.uint64)
        mask = np.where(low[which] < owner, all_of_it, mask & all_of_it)
        some = np.flatnonzero(mask)
        some = some[np.lexsort((lead[some], chunk[some]))]
        c = chunk[some]
        cut = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1], [True]])) if len(some) else np.zeros(1, int)
        spans = list(zip(cut, cut[1:]))
        return pa.table({"chunk": pa.array([int(c[a]) for a, _ in spans], pa.int32()),
                         "leads": pa.array([lead[some[a:b]].astype("<i4").tobytes() for a, b in spans], pa.binary()),
                         "masks": pa.array([mask[some[a:b]].astype("<u8").tobytes() for a, b in spans], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, "chunk int, leads binary, masks binary")


RESULT = "doc_id long, n_bytes long, kept binary, removed array<struct<start:long,end:long>>"


def cut_out(packed: DataFrame, repeated: DataFrame, masks: DataFrame, length: int, buckets: int) -> DataFrame:
    nothing = F.lit(None).cast("binary")
    notes = repeated.select("chunk", "keys", nothing.alias("leads"), nothing.alias("masks")).union(
        masks.select("chunk", nothing.alias("keys"), "leads", "masks"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(key: tuple[pa.Scalar], rows: pa.Table, said: pa.Table) -> pa.Table:
        ids, data = opened(rows)
        get = lambda name, kind: np.concatenate(
            [np.zeros(0, kind), *(np.frombuffer(b, kind) for b in said.column(name).to_pylist() if b is not None)])
        c = Chunk(ids, data, np.sort(get("keys", "<u8")), length, buckets)
        mask = np.zeros(len(c.n), np.uint64)
        mask[get("leads", "<i4")] = get("masks", "<u8")
        sizes = np.array([len(d) for d in data], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        marks = np.zeros((int(ends[-1]) if len(ends) else 0) + 1, np.int32)
        if len(c.n):
            lead_of = np.empty(c.group.max() + 1, np.int64)
            lead_of[c.group[c.lead]] = c.lead
            lead = lead_of[c.group]
            at = begins[c.doc] + c.start
            later = c.id > c.id[lead]  # the chunk's smallest id holds the whole stretch
            np.add.at(marks, at[later], 1)
            np.add.at(marks, at[later] + c.n[later], -1)
            own = np.where(later, np.uint64(0), mask[lead])
            for w in range(length - GRAM + 1):
                on = at[np.flatnonzero(own >> np.uint64(w) & np.uint64(1))] + w
                np.add.at(marks, on, 1)
                np.add.at(marks, on + length, -1)
        gone = np.cumsum(marks[:-1]) > 0
        kept, removed = [], []
        for a, b, d in zip(begins.tolist(), ends.tolist(), data):
            g = gone[a:b]
            if not g.any():
                kept.append(d), removed.append([])
                continue
            kept.append(np.frombuffer(d, np.uint8)[~g].tobytes())
            edge = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
            removed.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
        return pa.table([pa.array([None if i == NO_ID else i for i in ids.tolist()], pa.int64()), pa.array(sizes),
                         pa.array(kept, pa.binary()), pa.array(removed, span)],
                        names=["doc_id", "n_bytes", "kept", "removed"])

    return packed.groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(run, RESULT)


def remove_repeats(df: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, kept, removed)`` for every row: bytes left and maximal removed runs."""
    if not 2 * GRAM <= length <= 62 + GRAM:
        raise ValueError(f"length must be {2 * GRAM} to {62 + GRAM} bytes")  # a stretch's mask has 63 bits
    rows = pick(df, {"doc_id": id_col, "text": text_col})
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = 1 + total // CHUNK_BYTES, 1 + total // BUCKET_BYTES
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    repeated = materialize(repeated_anchors(deal(rows, length, buckets)), "anchors")
    packed = packed_rows(rows)
    sent = send_stretches(packed, repeated, length, buckets)
    return cut_out(packed, repeated, covered_windows(sent, length), length, buckets).withColumnRenamed("doc_id", id_col)

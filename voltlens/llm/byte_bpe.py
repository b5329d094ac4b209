"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The rank file (base64 token, rank) gives the vocabulary; the merge list is derived from it:
each token's last merge is the pair left when its bytes are merged by lower ranks only.
Every match of the split pattern is mapped byte by byte to printable characters and
encoded by the library's BPE model without a pre-tokenizer. Distinct matches are encoded
once per task and kept in a table of bounded size (emptied when full, which changes no
result). Texts made of common Latin characters are split by an equivalent pattern of the
standard module; every other text is split by the library's own byte-level splitter.

Decoding reverses the byte table. A token may hold a part of a character: bytes are joined
before they are read as UTF-8, and a token's character offsets span every character it
touches.

Cases: null text is empty and has no tokens; texts of any length are whole; ids out of
range raise; an empty table gives no rows; extra columns are carried, those named like a
result column are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from voltlens.llm.common import annotate, arrow_type, importable, position

#: Distinct matches kept per task.
KEPT_MATCHES = 150_000

# Characters on which the standard module's classes equal the pattern's: ASCII without
# 1C-1F, Latin letters, common punctuation.
OTHER = re.compile("[^\t-\r -~¡§«·»¿-ɏ–—‘-”…€]")
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def byte_characters() -> list[str]:
    """The public byte-to-character table: printable bytes stand for themselves, the others
    follow from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, extra = [], 0
    for b in range(256):
        table.append(chr(b) if b in own else chr(256 + extra))
        extra += b not in own
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def last_merge(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        pairs = [(ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        best, i = min(pairs)
        if best >= rank:
            raise ValueError("the rank file is not a merge order")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class Codec:
    """Encoder and byte table of one rank file, built once per Python worker."""

    _built: dict[str, "Codec"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        chars = byte_characters()
        show = lambda b: "".join(chars[x] for x in b)
        merges = [last_merge(t, r, ranks) for t, r in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
        self.model = Tokenizer(models.BPE(vocab={show(t): r for t, r in ranks.items()},
                                          merges=[(show(a), show(b)) for a, b in merges]))
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.to_chars = {b: c for b, c in enumerate(chars)}
        self.to_byte = {c: b for b, c in enumerate(chars)}
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for t, r in ranks.items():
            self.tokens[r] = t
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.known: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> "Codec":
        if path not in cls._built:
            cls._built[path] = cls(path)
        return cls._built[path]

    def matches(self, text: str) -> list[str]:
        """The pattern's matches; outside the common characters, as the library splits them."""
        if OTHER.search(text) is None:
            return SPLIT.findall(text)
        return [bytes(map(self.to_byte.__getitem__, piece)).decode("utf-8")
                for piece, _ in self.splitter.pre_tokenize_str(text)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.matches(t) if t else [] for t in texts]
        if len(self.known) > KEPT_MATCHES:
            self.known.clear()
        new = list({w for words in split for w in words}.difference(self.known))
        shown = [w.encode("utf-8").decode("latin-1").translate(self.to_chars) for w in new]
        for w, e in zip(new, self.model.encode_batch(shown, add_special_tokens=False)):
            self.known[w] = np.array(e.ids, "<i4").tobytes()
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4") for words in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character start and end of every token; a split character belongs to each of its tokens."""
        data = np.frombuffer(self.decode(ids), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        return char[ends - self.lengths[ids]].astype(np.int32), (char[ends - 1] + 1).astype(np.int32)


def lists(parts: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.int32)))


def encode(df: DataFrame, ranks_path: str, text_col: str = "text", keep=None, offsets: bool = False,
           decoded: bool = False) -> DataFrame:
    """Append ``ids`` (array of int); with ``offsets`` also ``starts`` and ``ends`` in characters;
    with ``decoded`` also the bytes that ``decode`` gives for the ids, in the same pass (a second
    pass would keep a second Python worker beside each task)."""
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField(n, ints) for n in (["ids", "starts", "ends"] if offsets else ["ids"])]
    fields += [T.StructField("decoded", T.BinaryType())] if decoded else []

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        codec = Codec.load(ranks_path)

        def work(texts):
            ids = codec.encode(texts)
            out = [lists(ids)]
            if offsets:
                spans = [codec.offsets(x) for x in ids]
                out += [lists([s for s, _ in spans]), lists([e for _, e in spans])]
            return out + ([[codec.decode(x) for x in ids]] if decoded else [])

        return work

    return annotate(df, text_col, fields, make, keep)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Append ``decoded`` (binary, the joined token bytes); null ids give empty bytes."""
    importable(df.sparkSession)
    carried = [i for i, c in enumerate(df.columns) if c.lower() != "decoded"]
    at = position(df, ids_col)
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names).select(*(names[i] for i in carried))
    at = carried.index(at)
    out_type = arrow_type(T.BinaryType())
    out_names = [names[i] for i in carried] + ["decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(ranks_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                col = part.column(at)
                values = [b"" if not s.is_valid else codec.decode(s.values.to_numpy(zero_copy_only=False)) for s in col]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, out_type)], names=out_names)

    schema = T.StructType([*plain.schema.fields, T.StructField("decoded", T.BinaryType())])
    return plain.mapInArrow(run, schema).toDF(*(df.columns[i] for i in carried), "decoded")


def read_text(data: bytes) -> str:
    """Token bytes as text: a character whose other part is missing becomes U+FFFD."""
    return data.decode("utf-8", errors="replace")

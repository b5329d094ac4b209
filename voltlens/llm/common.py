"""Helpers shared by the operators: column handling, Arrow stages, written tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from voltlens.session import FREE_SHUFFLES, scratch_path, settings

#: Texts of about this many bytes are handed to a vectorised function at once.
SLICE_BYTES = 1 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has it in. A cluster
    whose executors lack that folder gets the package by ``--py-files`` or an installation."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def position(df: DataFrame, name: str) -> int:
    """Index of the column with exactly this name; else the only one equal without case."""
    if name in df.columns:
        return df.columns.index(name)
    near = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(near) != 1:
        raise ValueError(f"column {name!r} not found (or ambiguous) in {df.columns}")
    return near[0]


def pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``{new name: input name}`` as a projection; extra columns may clash in name or case."""
    importable(df.sparkSession)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{position(df, src)}").alias(new) for new, src in columns.items()))


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a table into the shared scratch folder and read it back: cuts the lineage and
    survives lost executors. Its shuffles go when it is written. ``path``: where, for a caller
    that removes the table."""
    path = path or scratch_path(df.sparkSession, name)
    with settings(df.sparkSession, FREE_SHUFFLES):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(sizes: Sequence[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` bytes, at least one text each."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def text_sizes(texts: pa.Array) -> list[int]:
    """Bytes of every text, 0 for null; the texts themselves are not read."""
    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()


def annotate(df: DataFrame, text_col: str, fields: list[T.StructField],
             make: Callable[[], Callable[[list[str | None]], list]], keep: Sequence[str] | None = None,
             limit: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from a text column, Arrow batch by Arrow batch.

    ``make()`` runs once per task and returns a function from a list of texts (of about
    ``limit`` bytes together, one text at least) to one list of values per new field. ``keep``: input columns to carry (default: all).
    Input columns whose names equal a new field (without case) are replaced by it.
    """
    importable(df.sparkSession)
    new = {f.name.lower() for f in fields}
    carried = [i for i, c in enumerate(df.columns) if c.lower() not in new]
    if keep is not None:
        wanted = [position(df, c) for c in keep]
        carried = [i for i in wanted if i in carried]
    text_at = position(df, text_col)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    types = {i: df.schema.fields[i].dataType for i in carried}
    needed = plain.select(*(f"c{i}" for i in carried), F.col(f"c{text_at}").cast("string").alias("text_in"))
    schema = T.StructType([T.StructField(f"c{i}", types[i]) for i in carried] + list(fields))
    arrow_types = [arrow_type(f.dataType) for f in fields]
    n = len(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = batch.column(n)
            for lo, hi in slices(text_sizes(texts), limit):
                part = batch.slice(lo, hi - lo)
                values = work(part.column(n).to_pylist())
                arrays = [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, type=t)
                          for v, t in zip(values, arrow_types)]
                yield pa.RecordBatch.from_arrays(
                    list(part.columns[:n]) + arrays, names=[f"c{i}" for i in carried] + [f.name for f in fields])
            pa.default_memory_pool().release_unused()  # the worker lives on for other tasks

    out = needed.mapInArrow(run, schema)
    return out.toDF(*(df.columns[i] for i in carried), *(f.name for f in fields))


def arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

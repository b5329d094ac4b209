"""Schema-level helpers: tolerant projection, conform, rename, checks."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def q(name: str) -> str:
    """Back-quote a column name (names may hold spaces, dots or accents)."""
    return "`" + name.replace("`", "``") + "`"


def require_columns(df: DataFrame, cols) -> None:
    """Raise listing every missing column, before anything is planned."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing required columns: {missing}")


def select_existing(df: DataFrame, cols) -> DataFrame:
    """Keep the listed columns that exist, warn about the rest."""
    keep = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        log.warning("columns not present, skipped: %s", missing)
    return df.select(*[q(c) for c in keep])


def conform(df: DataFrame, schema: T.StructType, lenient: bool = True) -> DataFrame:
    """Exactly the target columns, in order, with the target types; absent
    columns come as typed NULLs. ``lenient`` uses try_cast."""
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(q(f.name))
            c = c.try_cast(f.dataType) if lenient else c.cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def rename_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P5: rename the columns that exist; absent names are ignored."""
    m = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(m) if m else df


def drop_present(df: DataFrame, *cols) -> DataFrame:
    """Drop, ignoring absent columns."""
    return df.drop(*[c for c in cols if c in df.columns])


def columns_of_type(df: DataFrame, *types) -> list[str]:
    """``select_dtypes``: names of columns whose type is one of ``types``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def reject_duplicate_names(cols) -> None:
    """Duplicated output names are an error instead of a silent 'x.1'."""
    seen, dups = set(), []
    for c in cols:
        if c in seen:
            dups.append(c)
        seen.add(c)
    if dups:
        raise ValueError(f"duplicated column names: {dups}")


def parse_ddl(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)

"""Sorts, limits, samples and top-1 selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def limit_read(df: DataFrame, order_col: str, n: int = 1000) -> DataFrame:
    """L1: the first ``n`` rows by a key (TakeOrderedAndProject: per-partition
    top-n, then one small merge)."""
    return df.orderBy(F.col(order_col).asc_nulls_last()).limit(n)


def head(df: DataFrame, n: int, order_cols) -> DataFrame:
    """L3: ``head(n)`` made repeatable by an explicit order."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return df.orderBy(*order_cols).limit(n)


def sample_n(df: DataFrame, n: int, key: Column | None = None, seed: int = 42, id_col: str | None = None) -> DataFrame:
    """L4: ``sample(n)``: the ``n`` rows with the smallest seeded hash of the row
    key, i.e. a uniform sample without replacement that is repeatable."""
    if key is None:
        cols = [F.col(id_col)] if id_col else [F.col(c) for c in df.columns]
        key = F.xxhash64(F.lit(seed), *cols)
    return df.withColumn("_vl_h", key).orderBy("_vl_h", *(df.columns if id_col is None else [id_col])) \
             .limit(n).drop("_vl_h")


def top1(df: DataFrame, value_col: str, metric: Column, by=None, smallest: bool = False,
         tie_break: Column | None = None) -> DataFrame:
    """The value with the best metric (per group); ties go to the
    smallest ``tie_break`` (default the value itself)."""
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    tb = tie_break if tie_break is not None else F.col(value_col)
    if smallest:
        pick = F.min_by(F.col(value_col), F.struct(metric, tb))
    else:
        pick = F.min_by(F.col(value_col), F.struct(-metric, tb))
    best = F.min(metric) if smallest else F.max(metric)
    return df.groupBy(*by).agg(pick.alias(value_col), best.alias("best"))

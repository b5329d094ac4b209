"""Criteria filters of the repository read side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlens.functions.schema import q


def find_by_criteria(df: DataFrame, criteria: dict, unknown: str = "raise") -> DataFrame:
    """AND of equalities. Unknown fields raise (D1) or, with
    ``unknown='ignore'``, are skipped like the reference does."""
    bad = [k for k in criteria if k not in df.columns]
    if bad and unknown == "raise":
        raise KeyError(f"unknown criteria fields: {bad}")
    cond = F.lit(True)
    for k, v in criteria.items():
        if k in df.columns:
            cond = cond & (F.col(q(k)).isNull() if v is None else F.col(q(k)) == F.lit(v))
    return df.where(cond)


def find_by_id(df: DataFrame, id_value, id_col: str = "id") -> DataFrame:
    """Rows with the given id."""
    return df.where(F.col(q(id_col)) == F.lit(id_value))


def find_by_year(df: DataFrame, year: int, year_col: str = "año", date_col: str | None = None) -> DataFrame:
    """Filter on the real year column (or the year of a date column)."""
    if year_col in df.columns:
        return df.where(F.col(q(year_col)) == F.lit(year))
    if date_col is None:
        raise KeyError(f"no column {year_col!r} and no date column given")
    return df.where(F.year(F.col(q(date_col))) == F.lit(year))

"""Null tokens and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text tokens the source tables use for a missing value.
NULL_TOKENS = ["nan", "<NA>", "None"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_tokens_to_null(col, tokens=NULL_TOKENS) -> Column:
    """F8: the text tokens for 'missing' become a real NULL."""
    s = _c(col).cast("string")
    return F.when(s.isin(*tokens), F.lit(None).cast("string")).otherwise(s)


def nan_to_null(col) -> Column:
    """Spark keeps NaN apart from NULL; the reference treats both as missing."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def lenient_double(col) -> Column:
    """``to_numeric(errors='coerce')`` -> NULL on text that is not a number."""
    c = _c(col)
    return nan_to_null(F.trim(c.cast("string")).try_cast("double"))


def nullable_long(col) -> Column:
    """text/number -> BIGINT, exactly; a fraction or an out-of-range value gives NULL.

    Whole numbers go straight to BIGINT. Text such as '12.0' (NULL under
    ``try_cast`` to BIGINT) goes through DECIMAL(38,18): no double on the way,
    so ids above 2^53 keep every digit.
    """
    s = F.trim(_c(col).cast("string"))
    d = s.try_cast("decimal(38,18)")
    return F.coalesce(s.try_cast("bigint"), F.when(d == F.floor(d), d.try_cast("bigint")))


def is_fractional(col) -> Column:
    """True where a numeric text carries a fraction (the reference raises there)."""
    d = F.trim(_c(col).cast("string")).try_cast("decimal(38,18)")
    return d.isNotNull() & (d != F.floor(d))


def text(col) -> Column:
    """``astype(str)`` with NULL kept as NULL."""
    return _c(col).cast("string")


def text_to_date(col) -> Column:
    """lenient text -> DATE; unparseable text gives NULL."""
    c = _c(col)
    s = c.cast("string")
    return F.coalesce(
        F.try_to_timestamp(s).cast("date"),
        F.try_to_timestamp(s, F.lit("dd/MM/yyyy")).cast("date"),
        F.try_to_timestamp(s, F.lit("yyyy/MM/dd")).cast("date"),
    )


def parse_bool(col) -> Column:
    """TRUE/SI -> true, FALSE/NO -> false, anything else NULL."""
    u = F.upper(F.trim(_c(col).cast("string")))
    return (F.when(u.isin("TRUE", "SI"), F.lit(True))
             .when(u.isin("FALSE", "NO"), F.lit(False)))


def cast_by_name(col, type_name: str) -> Column:
    """Lenient cast used by the type map."""
    t = type_name.lower()
    if t in ("long", "bigint", "int64", "int"):
        return nullable_long(col)
    if t in ("double", "float", "float64"):
        return lenient_double(col)
    if t in ("bool", "boolean"):
        return parse_bool(col)
    if t in ("date",):
        return text_to_date(col)
    if t in ("string", "str", "object"):
        return null_tokens_to_null(col)
    raise ValueError(f"unknown type name {type_name!r}")


def apply_type_map(df: DataFrame, type_map: dict[str, str], default: str | None = None) -> DataFrame:
    """one ``select`` of lenient casts; columns absent from the map keep
    their type unless ``default`` is given. Never aborts: bad values become NULL."""
    out = []
    for name in df.columns:
        t = type_map.get(name, default)
        out.append(cast_by_name(name, t).alias(name) if t else F.col(f"`{name}`"))
    return df.select(*out)


def cast_rejects(df: DataFrame, col: str, type_name: str) -> Column:
    """Predicate: value present but lost by the lenient cast (counted, not raised)."""
    return F.col(col).isNotNull() & cast_by_name(col, type_name).isNull()

"""Row-level expressions used by the pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_trim(col, sep: str = "/") -> Column:
    """F1 + F3: split on a literal separator and trim every element.

    The lambda is required: passing ``F.trim`` directly would hand it the
    element index as the trim-character argument.
    """
    return F.transform(F.split(_c(col).cast("string"), _regex_literal(sep)), lambda x: F.trim(x))


def explode_codes(col, sep: str = "/") -> Column:
    """one row per code; a NULL code yields one row with a NULL code."""
    return F.explode_outer(split_trim(col, sep))


def _regex_literal(s: str) -> str:
    import re

    return re.escape(s)


def trim_upper(col) -> Column:
    """F3."""
    return F.upper(F.trim(_c(col)))


def is_missing_text(col) -> Column:
    """NULL or the text 'nan' in any case."""
    c = _c(col)
    return c.isNull() | (F.lower(c.cast("string")) == "nan")


def replace_values(col, mapping: dict) -> Column:
    """dictionary replace; unmapped values are kept. A ``None`` key maps NULLs."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        cond = c.isNull() if k is None else (c == F.lit(k))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return c if expr is None else expr.otherwise(c)


def fill_default(col, default) -> Column:
    """NULL (and NaN for numbers) -> default, after a cast to text when the
    default is text (D6)."""
    c = _c(col)
    s = c.cast("string")
    missing = s.isNull() | (s == "NaN")  # a NaN of any numeric type renders so
    return F.when(missing, F.lit(default)).otherwise(s if isinstance(default, str) else c)


def year_of(col) -> Column:
    """year from a date/timestamp, else parsed text, else the first 4-digit run."""
    c = _c(col)
    s = c.cast("string")
    return F.coalesce(
        F.year(F.try_to_timestamp(s)),
        F.regexp_extract(s, r"(\d{4})", 1).try_cast("int"),
    ).cast("long")


def anomaly_label(col, positive: str = "Anomalia", negative: str = "No anomalia",
                  marker: str = "Solo odt") -> Column:
    """'Solo odt' -> "No anomalia", everything else (NULL too) -> "Anomalia"."""
    c = _c(col)
    return F.when(c == F.lit(marker), F.lit(negative)).otherwise(F.lit(positive))


def concat_key(*cols, sep: str = "_") -> Column:
    """``a + '_' + b`` as text."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def row_uuid(*natural_key) -> Column:
    """a row id. With a natural key it is repeatable (sha2 of the key);
    without one it is a random UUID like the reference."""
    if natural_key:
        return F.sha2(F.concat_ws("\u0001", *[_c(c).cast("string") for c in natural_key]), 256).substr(1, 32)
    return F.expr("replace(uuid(), '-', '')")


def load_timestamp(run_ts) -> Column:
    """'YYYY-MM-DD HH:MM:SS' text for the run time (one value per job)."""
    return F.date_format(F.lit(run_ts).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def rounded_pct(num, den, digits: int = 2) -> Column:
    """round(num / den * 100, 2); 0 when the denominator is 0 or NULL."""
    n, d = _c(num), _c(den)
    return F.coalesce(F.round(F.try_divide(n * F.lit(100.0), d), digits), F.lit(0.0))


def defaults_when_absent(struct_col: str, present_keys_col: str, defaults: dict) -> list[Column]:
    """default a record field only when its key is absent; a present NULL stays NULL."""
    out = []
    for name, value in defaults.items():
        field = F.col(f"{struct_col}.{name}")
        absent = ~F.array_contains(F.col(present_keys_col), F.lit(name))
        out.append(F.when(absent, F.lit(value)).otherwise(field).alias(name))
    return out

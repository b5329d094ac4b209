"""Counts, frequencies, quantiles and reports.

Everything is an aggregation with map-side combine. Exact quantiles avoid the
``percentile`` aggregate (it buffers every distinct value of a group in one
task): values are counted per distinct value, ranked with the scalable running
sum, and the two neighbours of each target rank are picked by a second
aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlens.functions.schema import q
from voltlens.operators.prefix import running_sum, with_group_values

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _by(by):
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """A4: one row per column: (column, nulls, total, null_pct)."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(q(c)).isNull().cast("long")).alias(f"_z{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _z{i}" for i, c in enumerate(cols))
    out = agg.selectExpr("_n", f"stack({len(cols)}, {stack}) AS (column, nulls)")
    return out.select("column", F.coalesce(F.col("nulls"), F.lit(0)).cast("long").alias("nulls"),
                      F.col("_n").alias("total"),
                      F.coalesce(F.round(F.try_divide(F.col("nulls") * 100.0, F.col("_n")), 2),
                                 F.lit(0.0)).alias("null_pct"))


def value_counts(df: DataFrame, col: str, by=None, dropna: bool = True) -> DataFrame:
    """A5: (by..., value, count, pct) with pct = count / group total * 100."""
    by = _by(by)
    src = df.where(F.col(q(col)).isNotNull()) if dropna else df
    c = src.groupBy(*by, F.col(q(col)).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    tot = c.groupBy(*by).agg(F.sum("count").alias("_tot"))
    c = with_group_values(c, tot, by)
    return c.select(*by, "value", "count", F.round(F.col("count") * 100.0 / F.col("_tot"), 2).alias("pct"))


def distinct_count(df: DataFrame, col: str, by=None, approx: bool = False) -> DataFrame:
    """Number of distinct non-null values (``approx`` uses HyperLogLog++)."""
    by = _by(by)
    f = F.approx_count_distinct(q(col)) if approx else F.count_distinct(F.col(q(col)))
    return df.groupBy(*by).agg(f.alias("n_distinct"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values (``unique()``), NULL excluded."""
    return df.select(F.col(q(col)).alias("value")).where(F.col("value").isNotNull()).distinct()


def value_ranks(df: DataFrame, col: str, by=None) -> DataFrame:
    """Counts per distinct value with inclusive cumulative counts and group size."""
    by = _by(by)
    c = (df.where(F.col(q(col)).isNotNull() & ~F.isnan(F.col(q(col)).cast("double")))
           .groupBy(*by, F.col(q(col)).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("cnt")))
    return running_sum(c, ["v"], ["cnt"], by=by, totals=True).withColumnRenamed("cnt_total", "n")


def exact_quantiles(df: DataFrame, col: str, probs, by=None, names=None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / DuckDB ``quantile_cont``).

    Returns one row per group with one column per probability (``q_<p>`` or
    ``names``) plus ``n``.
    """
    by = _by(by)
    names = names or [f"q_{str(p).replace('.', '_')}" for p in probs]
    r = value_ranks(df, col, by)
    g = by
    aggs = [F.first("n").alias("n")]
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs.append(F.min(F.when(F.col("cnt_cum") > lo, F.col("v"))).alias(f"_lo{i}"))
        aggs.append(F.min(F.when(F.col("cnt_cum") > hi, F.col("v"))).alias(f"_hi{i}"))
        aggs.append(F.first(pos - lo).alias(f"_fr{i}"))
    a = r.groupBy(*g).agg(*aggs)
    outs = [F.col(c) for c in by] + [F.col("n")]
    for i, nm in enumerate(names):
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}")).alias(nm))
    return a.select(*outs)


def approx_quantiles(df: DataFrame, col: str, probs, by=None, accuracy: int = 10000, names=None) -> DataFrame:
    """A14 option for huge groups: Greenwald-Khanna sketch, bounded memory."""
    by = _by(by)
    names = names or [f"q_{str(p).replace('.', '_')}" for p in probs]
    a = df.groupBy(*by).agg(F.percentile_approx(F.col(q(col)).cast("double"), list(probs), accuracy).alias("_q"),
                            F.count(F.col(q(col))).alias("n"))
    return a.select(*by, "n", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])


def percentile_filter(df: DataFrame, col: str, p: float = 0.95, by=None, keep_below: bool = True) -> DataFrame:
    """Keep rows with ``col <= quantile(p)`` (per group when ``by``)."""
    by = _by(by)
    qt = exact_quantiles(df, col, [p], by, names=["_vl_cut"]).drop("n")
    j = with_group_values(df, qt, by)
    cond = F.col(q(col)) <= F.col("_vl_cut") if keep_below else F.col(q(col)) > F.col("_vl_cut")
    return j.where(cond).drop("_vl_cut")


def mode_of(df: DataFrame, col: str, by=None, name: str | None = None) -> DataFrame:
    """Most frequent non-null value per group; the smallest wins ties."""
    by = _by(by)
    c = (df.where(F.col(q(col)).isNotNull())
           .groupBy(*by, F.col(q(col)).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    return c.groupBy(*by).agg(F.min_by("_v", F.struct(-F.col("_c"), F.col("_v"))).alias(name or col))


def mean_of(df: DataFrame, cols, by=None) -> DataFrame:
    """Mean per group of each column (NULL and NaN ignored)."""
    by = _by(by)
    return df.groupBy(*by).agg(*[F.avg(F.when(~F.isnan(F.col(q(c))), F.col(q(c)))).alias(c) for c in cols])


def drop_nulls(df: DataFrame, subset) -> DataFrame:
    """P10: ``dropna(subset)``: rows where any listed column is NULL (or NaN) go."""
    subset = [subset] if isinstance(subset, str) else list(subset)
    cond = None
    for c in subset:
        dt = df.schema[c].dataType
        ok = F.col(q(c)).isNotNull()
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(F.col(q(c)))
        cond = ok if cond is None else cond & ok
    return df.where(cond)


def any_null(cols) -> "F.Column":
    """True when any of ``cols`` is NULL."""
    cond = None
    for c in cols:
        x = F.col(q(c)).isNull()
        cond = x if cond is None else cond | x
    return cond


def numeric_profile(df: DataFrame, cols) -> DataFrame:
    """A10 numeric part: per column n, nulls, min, q1, median, q3, max, mean."""
    stack = ", ".join(f"'{c}', CAST({q(c)} AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) AS (column, value)")
    base = long.groupBy("column").agg(F.count("value").alias("n"),
                                      F.sum(F.col("value").isNull().cast("long")).alias("nulls"),
                                      F.min("value").alias("min"), F.max("value").alias("max"),
                                      F.avg("value").alias("mean"))
    qs = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by="column", names=["q1", "median", "q3"]).drop("n")
    return base.join(qs, on="column", how="left").select("column", "n", "nulls", "min", "q1", "median", "q3",
                                                          "max", "mean")


def text_profile(df: DataFrame, cols) -> DataFrame:
    """A10 text part: per column n, nulls, distinct, mode (smallest on ties), mode count."""
    stack = ", ".join(f"'{c}', CAST({q(c)} AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) AS (column, value)")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    nn = counts.where(F.col("value").isNotNull())
    return (counts.groupBy("column").agg(
                F.sum(F.when(F.col("value").isNotNull(), F.col("c"))).alias("n"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("c"))), F.lit(0)).alias("nulls"))
            .join(nn.groupBy("column").agg(
                F.count(F.lit(1)).alias("n_distinct"),
                F.min_by("value", F.struct(-F.col("c"), F.col("value"))).alias("mode"),
                F.max("c").alias("mode_count")), on="column", how="left"))


def shape_report(df: DataFrame, label: str) -> DataFrame:
    """A11/A12 building block: (stage, rows, cols)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("stage"), "rows",
                                                          F.lit(len(df.columns)).cast("long").alias("cols"))


def cleaning_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """rows/cols before and after, reductions and percentages (2 digits,
    0 when the denominator is 0)."""
    s = shape_report(before, "before").unionByName(shape_report(after, "after"))
    a = s.agg(*[F.max(F.when(F.col("stage") == st, F.col(m))).alias(f"{m}_{st}")
                for st in ("before", "after") for m in ("rows", "cols")])
    rr = F.col("rows_before") - F.col("rows_after")
    cr = F.col("cols_before") - F.col("cols_after")
    from voltlens.functions.scalars import rounded_pct
    return a.select("rows_before", "rows_after", "cols_before", "cols_after",
                    rr.alias("rows_reduction"), rounded_pct(rr, "rows_before").alias("rows_reduction_pct"),
                    cr.alias("cols_reduction"), rounded_pct(cr, "cols_before").alias("cols_reduction_pct"))


def _missing(df: DataFrame, c: str):
    bad = F.col(q(c)).isNull()
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        bad = bad | F.isnan(F.col(q(c)))
    return bad


def _lines(row: DataFrame, entries) -> DataFrame:
    """(section, name, value, n) rows from one aggregate row; entries: (section, name, value, n)."""
    typed = [F.struct(F.lit(s).alias("section"), F.lit(n).cast("string").alias("name"),
                      F.lit(v).cast("string").alias("value"), k.cast("double").alias("n")) for s, n, v, k in entries]
    return row.select(F.inline(F.array(*typed)))


def processed_report(df: DataFrame, n_items: int) -> DataFrame:
    """A11, processed part: rows, columns, missing values and their percentage, columns per
    type with their names, and the number of items, as (section, name, value, n).
    One aggregation over the table."""
    per_type: dict[str, list] = {}
    for f in df.schema.fields:
        per_type.setdefault(f.dataType.simpleString(), []).append(f.name)
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 sum((F.coalesce(F.sum(_missing(df, c).cast("long")), F.lit(0)) for c in df.columns), F.lit(0)).alias("missing"))
    pct = F.coalesce(F.round(F.try_divide(F.col("missing") * 100.0, F.col("rows") * len(df.columns)), 2), F.lit(0.0))
    return _lines(row, [("rows", None, None, F.col("rows")), ("columns", None, None, F.lit(len(df.columns))),
                        ("missing_values", None, None, F.col("missing")), ("missing_percentage", None, None, pct),
                        *[("data_types", t, ", ".join(cs), F.lit(len(cs))) for t, cs in sorted(per_type.items())],
                        ("item_columns_count", None, None, F.lit(n_items))])


def cleaning_details(before: DataFrame, after: DataFrame, duplicate_keys=("orden", "odt")) -> DataFrame:
    """A12, details: missing values per column, types and duplicated rows before; missing
    values, types and the frequencies of text columns after; as (section, name, value, n).
    One aggregation per side, one for the duplicates and one for all frequencies."""
    from voltlens.operators.dedupe import duplicate_count

    out = None
    for side, df in (("before", before), ("after", after)):
        row = df.agg(*[F.coalesce(F.sum(_missing(df, c).cast("long")), F.lit(0)).alias(f"m{i}")
                       for i, c in enumerate(df.columns)])
        part = _lines(row, [(f"missing_{side}", c, None, F.col(f"m{i}")) for i, c in enumerate(df.columns)]
                      + [(f"type_{side}", f.name, f.dataType.simpleString(), F.lit(None)) for f in df.schema.fields])
        out = part if out is None else out.unionByName(part)
    keys = [k for k in duplicate_keys if k in before.columns]
    if keys:
        dup = duplicate_count(before, keys)
        out = out.unionByName(_lines(dup, [("duplicates_before", "_".join(keys), None, F.col("duplicate_rows"))]))
    text = [f.name for f in after.schema.fields if isinstance(f.dataType, T.StringType)]
    if text:
        stack = ", ".join(f"'{c}', {q(c)}" for c in text)
        freq = after.selectExpr(f"stack({len(text)}, {stack}) AS (name, value)").where(F.col("value").isNotNull())
        out = out.unionByName(freq.groupBy("name", "value").agg(F.count(F.lit(1)).cast("double").alias("n")).select(
            F.lit("frequency_after").alias("section"), "name", "value", "n"))
    return out


def class_balance(df: DataFrame, col: str, positive, by=None) -> DataFrame:
    """Counts and percentages of positive / other values."""
    by = _by(by)
    is_pos = F.col(q(col)) == F.lit(positive)
    a = df.groupBy(*by).agg(F.sum(is_pos.cast("long")).alias("positive"),
                            F.sum((~is_pos | F.col(q(col)).isNull()).cast("long")).alias("negative"),
                            F.count(F.lit(1)).alias("total"))
    from voltlens.functions.scalars import rounded_pct
    return a.select(*by, "positive", "negative", "total", rounded_pct("positive", "total").alias("positive_pct"))

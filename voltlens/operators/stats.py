"""Exploratory statistics: rank correlation, Kendall tau, box plots, reconciliation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlens.functions.schema import q


def reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts of two builds and rows only in one (multiset difference)."""
    only_a = a.exceptAll(b)
    only_b = b.exceptAll(a)
    parts = [a.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit("rows_a")),
             b.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit("rows_b")),
             only_a.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit("only_a")),
             only_b.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit("only_b"))]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.max(F.when(F.col("k") == k, F.col("n"))).cast("long").alias(k)
                   for k in ("rows_a", "rows_b", "only_a", "only_b")])


def reconcile_by_key(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """X6 by key: what differs between two builds with the same columns. One row per key that does:
    ``status`` (added, removed or changed), the rows only in ``a`` and only in ``b`` and, where one
    row stands against one, the sorted names of its ``changed`` columns.

    Both builds meet in one signed count (a row +1 in ``a``, -1 in ``b``): equal rows
    cancel in a hash aggregation, copies by their number, and only what is left is
    grouped by key. NULL keys and values are equal.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in a.columns if c not in keys]
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"builds differ in columns: {a.columns} and {b.columns}")
    both = a.withColumn("_vl_sign", F.lit(1)).unionByName(b.withColumn("_vl_sign", F.lit(-1)))
    left = both.groupBy(*[q(c) for c in a.columns]).agg(F.sum("_vl_sign").alias("_vl_d")).where("_vl_d != 0")
    hashes = F.array(*[F.struct(F.lit(c).alias("c"), F.xxhash64(F.col(q(c))).alias("h"), F.col(q(c)).isNull().alias("z"))
                       for c in sorted(others)]) if others else F.array().cast("array<struct<c:string,h:bigint,z:boolean>>")
    row = left.select(*[F.col(q(k)) for k in keys], "_vl_d", hashes.alias("_vl_h"))
    out = row.groupBy(*[q(k) for k in keys]).agg(
        F.sum(F.when(F.col("_vl_d") > 0, F.col("_vl_d")).otherwise(0)).alias("rows_a"),
        F.sum(F.when(F.col("_vl_d") < 0, -F.col("_vl_d")).otherwise(0)).alias("rows_b"),
        # one of each side; a key with more has no single row to compare
        F.max(F.when(F.col("_vl_d") > 0, F.col("_vl_h"))).alias("_ha"), F.max(F.when(F.col("_vl_d") < 0, F.col("_vl_h"))).alias("_hb"))
    status = F.when(F.col("rows_b") == 0, "removed").when(F.col("rows_a") == 0, "added").otherwise("changed")
    single = (F.col("rows_a") == 1) & (F.col("rows_b") == 1)
    differ = F.filter(F.zip_with("_ha", "_hb", lambda x, y: F.when((x["h"] != y["h"]) | (x["z"] != y["z"]), x["c"])), lambda c: c.isNotNull())
    return out.select(*[q(k) for k in keys], status.alias("status"), "rows_a", "rows_b", F.when(single, differ).alias("changed"))


def _by(by):
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def average_rank(df: DataFrame, col: str, by=None, name: str | None = None) -> DataFrame:
    """1-based rank with ties averaged (scipy ``rankdata``), per group.

    Ranks come from counts per distinct value and a ranged running sum, then
    join back on the value: by a broadcast where the distinct values are few (a hot
    value then moves no row), by a shuffle beyond, whose skewed partitions adaptive
    execution splits."""
    from voltlens.operators.prefix import broadcast_checked, running_sum

    by = _by(by)
    name = name or f"{col}_rank"
    c = df.groupBy(*by, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    c = c.where(F.col("_v").isNotNull())
    r = running_sum(c, ["_v"], ["_c"], by=by)
    r = r.select(*[F.col(b).alias(f"_rb{i}") for i, b in enumerate(by)], "_v",
                 (F.col("_c_cum") - (F.col("_c") - 1) / 2.0).alias(name))
    cond = [F.col(col) == F.col("_v")] + [F.col(b).eqNullSafe(F.col(f"_rb{i}")) for i, b in enumerate(by)]
    return df.join(broadcast_checked(r), on=cond, how="left").drop("_v", *[f"_rb{i}" for i in range(len(by))])


def spearman(df: DataFrame, x: str, y: str, by=None, min_n: int = 0) -> DataFrame:
    """Spearman rho = Pearson correlation of average ranks, per group;
    groups with ``n <= min_n`` are left out.

    Works on distinct (x, y) pairs with their counts: ranks belong to distinct values, are
    joined to the pairs (broadcast when few) and enter weighted sums around their mean, which
    is (n + 1) / 2. Rows are never joined on a value."""
    from voltlens.operators.prefix import broadcast_checked, materialize, running_sum

    by = _by(by)
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = [F.col(b).alias(f"_g{i}") for i, b in enumerate(by)]
    names = [f"_g{i}" for i in range(len(by))]
    pairs = materialize(d.groupBy(*g, F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_c")))
    out = pairs
    for v in ("_x", "_y"):
        counts = pairs.groupBy(*names, v).agg(F.sum("_c").alias("_k"))
        ranks = running_sum(counts, [v], ["_k"], by=names, totals=True).select(
            *[F.col(n).alias(f"{v}{n}") for n in names], F.col(v).alias(f"{v}_v"),
            # distance of the average rank from the mean rank
            (F.col("_k_cum") - (F.col("_k") - 1) / 2.0 - (F.col("_k_total") + 1) / 2.0).alias(f"_d{v}"))
        cond = F.col(v) == F.col(f"{v}_v")
        for n in names:
            cond = cond & F.col(n).eqNullSafe(F.col(f"{v}{n}"))
        out = out.join(broadcast_checked(ranks), cond).drop(f"{v}_v", *[f"{v}{n}" for n in names])
    c, a, b = F.col("_c"), F.col("_d_x"), F.col("_d_y")
    sums = out.groupBy(*names).agg(F.sum(c * a * b).alias("_ab"), F.sum(c * a * a).alias("_aa"), F.sum(c * b * b).alias("_bb"),
                                   F.coalesce(F.sum(c), F.lit(0)).alias("n"))
    rho = F.try_divide(F.col("_ab"), F.sqrt(F.col("_aa") * F.col("_bb")))
    out = sums.select(*[F.col(n).alias(b_) for n, b_ in zip(names, by)], rho.alias("rho"), "n")
    return out.where(F.col("n") > min_n) if min_n else out


#: Nodes of the Gauss-Legendre rule used for p-values.
_NODES = 64


def correlation_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation ``r`` of ``n`` pairs (Student t, n-2
    degrees of freedom), as a column expression.

    With sin(a) = |r| the t distribution's tail is the share of
    cos(x)^(n-3) over [a, pi/2] in [0, pi/2]. Both integrals are taken over at
    most 14 / sqrt(n-3) (what lies beyond is below 1e-40) by a fixed
    Gauss-Legendre rule; the power is exp((n-3)/2 * log1p(-sin^2 x)), which keeps
    its precision for small x, so large n cost nothing. NULL without a
    correlation or below three pairs."""
    from numpy.polynomial.legendre import leggauss

    k = n.cast("double") - 3
    start = F.asin(F.least(F.abs(r), F.lit(1.0)))
    rule = F.array(*[F.struct(F.lit((x + 1) / 2).alias("x"), F.lit(w / 2).alias("w"))
                     for x, w in zip(*(v.tolist() for v in leggauss(_NODES)))])

    def integral(a: Column) -> Column:
        width = F.least(F.lit(math.pi / 2) - a, F.lit(14.0) / F.sqrt(F.greatest(k, F.lit(1.0))))
        point = lambda x: F.sin(a + width * x)
        return width * F.aggregate(rule, F.lit(0.0), lambda acc, g: acc + g["w"] * F.exp(
            k / 2 * F.log1p(-point(g["x"]) * point(g["x"]))))

    p = F.least(integral(start) / integral(F.lit(0.0)), F.lit(1.0))
    return F.when((n >= 3) & r.isNotNull() & ~F.isnan(r), F.when(F.abs(r) >= 1, F.lit(0.0)).otherwise(p))


def kendall_tau_b(df: DataFrame, level: str, value: str, levels, by=None) -> DataFrame:
    """Kendall tau-b between a variable with few levels and any numeric
    value, without pairing rows: counts per (value, level) with running sums
    over the value give concordant minus discordant pairs exactly."""
    from voltlens.operators.prefix import running_sum

    by = _by(by)
    levels = list(levels)
    L = len(levels)
    d = df.where(F.col(level).isNotNull() & F.col(value).isNotNull())
    cn = [f"_n{i}" for i in range(L)]
    # one row per distinct value with a count per level (conditional sums: a
    # single aggregation, where pivot would add a second shuffle)
    w = d.groupBy(*by, F.col(value).cast("double").alias("_y")).agg(
        *[F.sum((F.col(level) == F.lit(lv)).cast("long")).alias(cn[i]) for i, lv in enumerate(levels)])
    r = running_sum(w, ["_y"], cn, by=by, totals=True)
    # products of counts are taken as doubles: they exceed BIGINT from about 3e9 rows a level
    r = r.withColumns({c: F.col(c).cast("double") for n in cn for c in (n, f"{n}_cum", f"{n}_total")})
    r = r.withColumnsRenamed({f"{c}_total": f"_tot{i}" for i, c in enumerate(cn)})
    g = by
    s = None
    for b_ in range(1, L):
        inner = None
        for a_ in range(b_):
            below = F.col(f"{cn[a_]}_cum") - F.col(cn[a_])
            above = F.col(f"_tot{a_}") - F.col(f"{cn[a_]}_cum")
            t = below - above
            inner = t if inner is None else inner + t
        term = F.col(cn[b_]) * inner
        s = term if s is None else s + term
    ty = None
    tj = None
    for c in cn:
        ty = F.col(c) if ty is None else ty + F.col(c)
        t = F.col(c) * (F.col(c) - 1) / 2
        tj = t if tj is None else tj + t
    a = r.groupBy(*g).agg(F.sum(s).alias("_s"), F.sum(ty * (ty - 1) / 2).alias("_n2"),
                          F.first(F.array(*[F.col(f"_tot{i}") for i in range(L)])).alias("_Ns"))
    nsum = F.aggregate("_Ns", F.lit(0.0), lambda acc, v: acc + v)
    n1 = F.aggregate("_Ns", F.lit(0.0), lambda acc, v: acc + v * (v - 1) / 2)
    n0 = nsum * (nsum - 1) / 2
    tau = F.try_divide(F.col("_s"), F.sqrt((n0 - n1) * (n0 - F.col("_n2"))))
    return a.select(*by, tau.alias("tau_b"), nsum.cast("long").alias("n"))


def box_stats(df: DataFrame, value: str, by=None) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers (the most extreme values inside the
    fences) per group."""
    from voltlens.operators.profile import exact_quantiles

    by = _by(by)
    from voltlens.operators.prefix import with_group_values

    qs = exact_quantiles(df, value, [0.25, 0.5, 0.75], by=by, names=["q1", "median", "q3"])
    g = by
    j = with_group_values(df, qs, by)
    iqr = F.col("q3") - F.col("q1")
    v = F.col(value)
    a = j.groupBy(*g).agg(F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
                          F.first("q3").alias("q3"),
                          F.min(F.when(v >= F.col("q1") - 1.5 * iqr, v)).alias("whisker_low"),
                          F.max(F.when(v <= F.col("q3") + 1.5 * iqr, v)).alias("whisker_high"),
                          F.sum(F.when((v < F.col("q1") - 1.5 * iqr) | (v > F.col("q3") + 1.5 * iqr), 1)
                                .otherwise(0)).alias("outliers"))
    return a


def group_sum(df: DataFrame, by, value: str, name: str = "total") -> DataFrame:
    """Sum per group."""
    return df.groupBy(*_by(by)).agg(F.sum(value).alias(name))


def pivot_count(df: DataFrame, row: str, col: str, values) -> DataFrame:
    """Counts of ``row`` x ``col`` with a fixed column list, missing = 0."""
    p = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1))).na.fill(0)
    return p.select(row, *[F.col(f"`{v}`").cast("long").alias(f"{col}_{v}") for v in values])


def composition(df: DataFrame, zone: str, cluster: str, score: str, value: str, levels) -> DataFrame:
    """Per (zone, cluster) score mix (counts per level) and value total."""
    levels = list(levels)
    p = (df.groupBy(zone, cluster).pivot(score, levels)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("v")).na.fill(0, [f"{lv}_n" for lv in levels]))
    cols = [zone, cluster] + [F.col(f"`{lv}_n`").cast("long").alias(f"n_{lv}") for lv in levels]
    tot = None
    for lv in levels:
        t = F.coalesce(F.col(f"`{lv}_v`"), F.lit(0.0))
        tot = t if tot is None else tot + t
    return p.select(*cols, tot.alias(f"{value}_total"))


def with_pvalues(corr: DataFrame, r_col: str = "rho", n_col: str = "n", alpha: float = 0.05) -> DataFrame:
    """Two-sided p-values of correlations (Student t, n-2 degrees of
    freedom) and a significance flag (false without a p-value)."""
    p = correlation_pvalue(F.col(r_col), F.col(n_col))
    return corr.withColumn("p_value", p).withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))

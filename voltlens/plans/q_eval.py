"""Catalog entries: evaluation metrics (E1-E11) and statistics.

Scored analogue: ``labels`` x ``documents``; y = quality, score = n_chars,
probability = n_chars / (n_chars + 1000); a four-class label
quality + 2 * toxic with a length-band prediction and per-class scores.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voltlens.operators import metrics as MT
from voltlens.operators import stats as ST
from voltlens.plans import analogues as A
from voltlens.plans.catalog import register

_SCORED_SQL = """scored AS (
  SELECT l.doc_id, l.quality AS y, CAST(d.n_chars AS DOUBLE) AS score,
         d.n_chars / (d.n_chars + 1000.0) AS prob, l.quality + 2 * l.toxic AS ymc,
         CASE WHEN d.n_chars < 500 THEN 0 WHEN d.n_chars < 2000 THEN 1 WHEN d.n_chars < 8000 THEN 2 ELSE 3 END AS pred,
         1.0 / (1.0 + abs(ln(d.n_chars + 1.0) - 5.0)) AS p0, 1.0 / (1.0 + abs(ln(d.n_chars + 1.0) - 6.5)) AS p1,
         1.0 / (1.0 + abs(ln(d.n_chars + 1.0) - 8.0)) AS p2, 1.0 / (1.0 + abs(ln(d.n_chars + 1.0) - 9.5)) AS p3
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _scored(spark, sf_dir):
    lab = A.read(spark, sf_dir, "labels")
    doc = A.read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    n = F.col("n_chars")
    ln = F.log(n + 1.0)
    return j.select(
        "doc_id", F.col("quality").alias("y"), n.cast("double").alias("score"), (n / (n + 1000.0)).alias("prob"),
        (F.col("quality") + 2 * F.col("toxic")).alias("ymc"),
        F.when(n < 500, 0).when(n < 2000, 1).when(n < 8000, 2).otherwise(3).alias("pred"),
        *[(F.lit(1.0) / (F.lit(1.0) + F.abs(ln - c))).alias(f"p{i}") for i, c in enumerate([5.0, 6.5, 8.0, 9.5])])


def W(body):
    return "WITH " + _SCORED_SQL + ",\n" + body.strip()[5:] if body.strip().upper().startswith("WITH ") \
        else "WITH " + _SCORED_SQL + "\n" + body


_PER_CLASS = """
WITH cf AS (SELECT ymc AS label, pred, count(*) AS n FROM scored GROUP BY ymc, pred),
cls AS (SELECT label AS c FROM cf UNION SELECT pred FROM cf),
pc AS (SELECT c AS class,
         COALESCE((SELECT sum(n) FROM cf WHERE label = c AND pred = c), 0) AS tp,
         COALESCE((SELECT sum(n) FROM cf WHERE label = c), 0) AS support,
         COALESCE((SELECT sum(n) FROM cf WHERE pred = c), 0) AS predicted FROM cls),
pr AS (SELECT class, tp, support, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM pc),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
      FROM pr)
"""


@register("e11_classification_report", W(_PER_CLASS + """
SELECT class, precision, recall, f1, CAST(support AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp FROM f"""))
def e11_classification_report(spark, sf_dir):
    return MT.per_class(_scored(spark, sf_dir), "ymc", "pred")


@register("e1_weighted_f1", W(_PER_CLASS + """
SELECT sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision_weighted,
       sum(recall * support) / sum(support) AS recall_weighted, sum(f1 * support) / sum(support) AS f1_weighted,
       avg(f1) AS f1_macro FROM f"""))
def e1_weighted_f1(spark, sf_dir):
    return MT.summary(_scored(spark, sf_dir), "ymc", "pred")


def _auc_sql(src, by):
    """Rank-sum AUC with averaged ties; ``src`` has columns (by, y, s)."""
    gb = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
    (SELECT {gb}sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc,
            CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
     FROM (SELECT *, COALESCE(sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                       AS below
           FROM (SELECT {gb}s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
                        sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg FROM ({src}) GROUP BY {gb}s))
     {'GROUP BY ' + by if by else ''})"""


_OVR = " UNION ALL ".join(f"SELECT {c} AS class, CAST(ymc = {c} AS INTEGER) AS y, p{c} AS s FROM scored"
                          for c in range(4))


@register("e3_per_class_auc", W("SELECT * FROM " + _auc_sql(_OVR, "class")))
def e3_per_class_auc(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return MT.auc(MT.one_vs_rest(s, "ymc", {c: f"p{c}" for c in range(4)}), "y", "p", by="class")


@register("e2_weighted_ovr_auc", W("SELECT sum(auc * positives) / sum(positives) AS auc_weighted, "
                                   "avg(auc) AS auc_macro FROM " + _auc_sql(_OVR, "class")))
def e2_weighted_ovr_auc(spark, sf_dir):
    return MT.weighted_ovr_auc(_scored(spark, sf_dir), "ymc", {c: f"p{c}" for c in range(4)})


@register("e2_binary_auc", W("SELECT * FROM " + _auc_sql("SELECT y, score AS s FROM scored", None)))
def e2_binary_auc(spark, sf_dir):
    return MT.auc(_scored(spark, sf_dir), "y", "score")


def _curve_sql(src, by=None):
    gb = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
    (SELECT {gb}s AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / P AS tpr, fp / N AS fpr,
            tp / (tp + fp) AS precision, tp / P AS recall
     FROM (SELECT *, sum(pos) OVER ({part}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
                  sum(neg) OVER ({part}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
                  sum(pos) OVER ({part.strip()}) AS P, sum(neg) OVER ({part.strip()}) AS N
           FROM (SELECT {gb}s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
                        sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg FROM ({src}) GROUP BY {gb}s)))"""


_BIN = "SELECT y, score AS s FROM scored"


@register("e4_roc_curve", W("SELECT threshold, tp, fp, tpr, fpr FROM " + _curve_sql(_BIN)))
def e4_roc_curve(spark, sf_dir):
    return MT.curve(_scored(spark, sf_dir), "y", "score").select("threshold", "tp", "fp", "tpr", "fpr")


@register("e8_pr_curve", W("SELECT threshold, precision, recall FROM " + _curve_sql(_BIN)))
def e8_pr_curve(spark, sf_dir):
    return MT.curve(_scored(spark, sf_dir), "y", "score").select("threshold", "precision", "recall")


@register("e5_micro_roc", W("SELECT threshold, tp, fp, tpr, fpr FROM " + _curve_sql(
    "SELECT y, s FROM (" + _OVR + ")")))
def e5_micro_roc(spark, sf_dir):
    s = _scored(spark, sf_dir)
    flat = MT.one_vs_rest(s, "ymc", {c: f"p{c}" for c in range(4)})
    return MT.curve(flat, "y", "p").select("threshold", "tp", "fp", "tpr", "fpr")


@register("e6_binarize", W("SELECT doc_id, ymc, " + ", ".join(
    f"CAST(ymc = {c} AS INTEGER) AS y_{c}" for c in range(4)) + " FROM scored"))
def e6_binarize(spark, sf_dir):
    return MT.binarize(_scored(spark, sf_dir).select("doc_id", "ymc"), "ymc", range(4))


@register("e9_best_f1_threshold", W("""
SELECT arg_min(threshold, (-f1, threshold)) AS threshold, max(f1) AS f1 FROM (
  SELECT threshold, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM """ + _curve_sql(_BIN) + ")"))
def e9_best_f1_threshold(spark, sf_dir):
    return MT.best_f1_threshold(MT.curve(_scored(spark, sf_dir), "y", "score"))


@register("e10_equal_pr_threshold", W("""
SELECT arg_min(threshold, (gap, threshold)) AS threshold, min(gap) AS gap FROM (
  SELECT threshold, abs(precision - recall) AS gap FROM """ + _curve_sql(_BIN) + ")"))
def e10_equal_pr_threshold(spark, sf_dir):
    return MT.equal_pr_threshold(MT.curve(_scored(spark, sf_dir), "y", "score"))


_EDGES = ", ".join(f"quantile_cont(prob, {i / 10}) AS e{i}" for i in range(1, 10))


@register("e7_calibration", W(f"""
SELECT CAST(bin AS BIGINT) AS bin, avg(CAST(y AS DOUBLE)) AS prob_true, avg(prob) AS prob_pred,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT s.*, {' + '.join(f'CASE WHEN e.e{i} < s.prob THEN 1 ELSE 0 END' for i in range(1, 10))} AS bin
      FROM scored s, (SELECT {_EDGES} FROM scored) e)
GROUP BY bin"""))
def e7_calibration(spark, sf_dir):
    return MT.calibration(_scored(spark, sf_dir), "y", "prob", 10)


# ----------------------------------------------------------------------------- statistics

def _rank_sql(col, by=None):
    part = f"PARTITION BY {by} " if by else ""
    return (f"(rank() OVER ({part}ORDER BY {col}) + count(*) OVER ({part}ORDER BY {col} "
            f"RANGE BETWEEN CURRENT ROW AND CURRENT ROW) / 2.0 - 0.5)")


@register("w4_average_rank", f"""
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
       {_rank_sql('l_extendedprice', 'l_returnflag')} AS price_rank FROM lineitem""")
def w4_average_rank(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return ST.average_rank(li, "l_extendedprice", by="l_returnflag", name="price_rank")


@register("x1_spearman", f"""
SELECT corr(rx, ry) AS rho, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT {_rank_sql('l_linenumber')} AS rx, {_rank_sql('l_extendedprice')} AS ry FROM lineitem)""")
def x1_spearman(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    return ST.spearman(li, "l_linenumber", "l_extendedprice")


@register("x2_spearman_by_zone", f"""
SELECT l_returnflag, corr(rx, ry) AS rho, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT l_returnflag, {_rank_sql('l_quantity', 'l_returnflag')} AS rx,
         {_rank_sql('l_extendedprice', 'l_returnflag')} AS ry FROM lineitem)
GROUP BY l_returnflag HAVING count(*) > 5""")
def x2_spearman_by_zone(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    return ST.spearman(li, "l_quantity", "l_extendedprice", by="l_returnflag", min_n=5)


_KT_LEVELS = list(range(1, 8))
_KT_SQL = f"""
WITH c AS (SELECT l_extendedprice AS y, {', '.join(f'sum(CASE WHEN l_linenumber = {lv} THEN 1 ELSE 0 END) AS n{lv}' for lv in _KT_LEVELS)}
           FROM lineitem GROUP BY l_extendedprice),
r AS (SELECT *, {', '.join(f'sum(n{lv}) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum{lv}, sum(n{lv}) OVER () AS tot{lv}' for lv in _KT_LEVELS)} FROM c),
s AS (SELECT sum({' + '.join(f'n{b} * (' + ' + '.join(f'((cum{a} - n{a}) - (tot{a} - cum{a}))' for a in _KT_LEVELS if a < b) + ')' for b in _KT_LEVELS if b > 1)}) AS s,
             sum(({' + '.join(f'n{lv}' for lv in _KT_LEVELS)}) * ({' + '.join(f'n{lv}' for lv in _KT_LEVELS)} - 1) / 2) AS n2,
             {', '.join(f'max(tot{lv}) AS T{lv}' for lv in _KT_LEVELS)} FROM r),
t AS (SELECT s, n2, {' + '.join(f'T{lv}' for lv in _KT_LEVELS)} AS n,
             {' + '.join(f'T{lv} * (T{lv} - 1) / 2' for lv in _KT_LEVELS)} AS n1 FROM s)
SELECT s / sqrt((n * (n - 1) / 2 - n1) * (n * (n - 1) / 2 - n2)) AS tau_b, CAST(n AS BIGINT) AS n FROM t"""


@register("x3_kendall_tau", _KT_SQL)
def x3_kendall_tau(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    return ST.kendall_tau_b(li, "l_linenumber", "l_extendedprice", _KT_LEVELS)


@register("x4_box_stats", """
WITH q AS (SELECT l_linenumber, CAST(count(*) AS BIGINT) AS n, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY l_linenumber)
SELECT q.l_linenumber, q.n, q.q1, q.median, q.q3,
       min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS whisker_low,
       max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high,
       CAST(sum(CASE WHEN v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS outliers
FROM q JOIN (SELECT l_linenumber, l_extendedprice AS v FROM lineitem) d ON q.l_linenumber = d.l_linenumber
GROUP BY q.l_linenumber, q.n, q.q1, q.median, q.q3""")
def x4_box_stats(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    return ST.box_stats(li, "l_extendedprice", by="l_linenumber")


@register("x5_composition", """
SELECT l_returnflag, l_linestatus, """ + ", ".join(
    f"CAST(sum(CASE WHEN l_linenumber = {lv} THEN 1 ELSE 0 END) AS BIGINT) AS n_{lv}" for lv in _KT_LEVELS) + """,
       round(sum(l_quantity), 2) AS l_quantity_total
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def x5_composition(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    out = ST.composition(li, "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", _KT_LEVELS)
    return out.withColumn("l_quantity_total", F.round("l_quantity_total", 2))


@register("a6_group_sum", """
SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total FROM lineitem
GROUP BY l_returnflag, l_linestatus""")
def a6_group_sum(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    return ST.group_sum(li, ["l_returnflag", "l_linestatus"], "l_extendedprice").withColumn(
        "total", F.round("total", 2))


@register("a7_pivot_count", """
SELECT l_linestatus, CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS BIGINT) AS l_returnflag_A,
       CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS BIGINT) AS l_returnflag_N,
       CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS l_returnflag_R
FROM lineitem GROUP BY l_linestatus""")
def a7_pivot_count(spark, sf_dir):
    return ST.pivot_count(A.read(spark, sf_dir, "lineitem"), "l_linestatus", "l_returnflag", ["A", "N", "R"])


@register("a8_pivot_levels", "SELECT l_returnflag, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE l_linenumber = {lv}) AS BIGINT) AS l_linenumber_{lv}" for lv in range(1, 9))
    + " FROM lineitem GROUP BY l_returnflag")
def a8_pivot_levels(spark, sf_dir):
    return ST.pivot_count(A.read(spark, sf_dir, "lineitem"), "l_returnflag", "l_linenumber", list(range(1, 9)))


def _pvalue_sql(rho_sql: str) -> str:
    """p-value of (rho, n): the t distribution's tail is the share of cos(x)^(n-3) over
    [asin |rho|, pi/2] in [0, pi/2]; midpoint rule with 20000 steps over 14 / sqrt(n-3)."""
    def integral(start):
        width = f"least(pi() / 2 - {start}, 14.0 / sqrt(greatest(n - 3, 1)))"
        angle = f"({start} + {width} * (i + 0.5) / 20000)"
        return (f"({width} / 20000 * (SELECT sum(exp((n - 3) / 2.0 * ln(1 - sin{angle} * sin{angle}))) "
                f"FROM range(20000) t(i)))")
    p = f"{integral('asin(abs(rho))')} / {integral('0.0')}"
    return (f"SELECT *, CASE WHEN n >= 3 THEN round({p}, 8) END AS p_value, "
            f"COALESCE(n >= 3 AND {p} < 0.05, false) AS significant FROM ({rho_sql})")


_X1_RHO = f"""
SELECT corr(rx, ry) AS rho, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT {_rank_sql('l_linenumber')} AS rx, {_rank_sql('l_extendedprice')} AS ry FROM lineitem)"""
_X2_RHO = f"""
SELECT l_returnflag, corr(rx, ry) AS rho, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT l_returnflag, {_rank_sql('l_quantity', 'l_returnflag')} AS rx,
         {_rank_sql('l_extendedprice', 'l_returnflag')} AS ry FROM lineitem)
GROUP BY l_returnflag HAVING count(*) > 5"""


@register("x2_spearman_significance", _pvalue_sql(_X2_RHO))
def x2_spearman_significance(spark, sf_dir):
    """Per-zone rho with p-value (eight digits) and the 5% significance flag."""
    li = A.read(spark, sf_dir, "lineitem")
    out = ST.with_pvalues(ST.spearman(li, "l_quantity", "l_extendedprice", by="l_returnflag", min_n=5))
    return out.withColumn("p_value", F.round("p_value", 8))


@register("x1_spearman_pvalue", _pvalue_sql(_X1_RHO))
def x1_spearman_pvalue(spark, sf_dir):
    """Global rho with its two-sided p-value (eight digits)."""
    li = A.read(spark, sf_dir, "lineitem")
    out = ST.with_pvalues(ST.spearman(li, "l_linenumber", "l_extendedprice"))
    return out.withColumn("p_value", F.round("p_value", 8))


# ----------------------------------------------------------------------------- reconciliation by key, sketches

_BUILD_B = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 21 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 13 = 0"""


@register("x6_reconcile_by_key", f"""
WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders), b AS ({_BUILD_B}),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderkey AS ka, b.o_orderkey AS kb,
             a.o_totalprice IS DISTINCT FROM b.o_totalprice AS dp, a.o_orderpriority IS DISTINCT FROM b.o_orderpriority AS dq
      FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, CASE WHEN kb IS NULL THEN 'removed' WHEN ka IS NULL THEN 'added' ELSE 'changed' END AS status,
       CAST(CASE WHEN ka IS NULL THEN 0 ELSE 1 END AS BIGINT) AS rows_a, CAST(CASE WHEN kb IS NULL THEN 0 ELSE 1 END AS BIGINT) AS rows_b,
       CASE WHEN ka IS NOT NULL AND kb IS NOT NULL THEN concat_ws(',', CASE WHEN dq THEN 'o_orderpriority' END,
            CASE WHEN dp THEN 'o_totalprice' END) END AS changed
FROM j WHERE ka IS NULL OR kb IS NULL OR dp OR dq""")
def x6_reconcile_by_key(spark, sf_dir):
    """Added, removed and changed keys between two builds of the orders, with the changed columns."""
    a = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    b = a.where(k % 11 != 0).withColumns({
        "o_totalprice": F.when(k % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(k % 21 != 0, F.col("o_orderpriority"))})
    b = b.unionByName(a.where(k % 13 == 0).withColumn("o_orderkey", -k))
    return ST.reconcile_by_key(a, b, "o_orderkey").withColumn("changed", F.concat_ws(",", "changed")).withColumn(
        "changed", F.when(F.col("status") == "changed", F.col("changed")))


@register("a9_a14_merged_sketches", """
WITH o AS (SELECT o_orderstatus, o_custkey, o_totalprice FROM orders)
SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, true AS distinct_within, true AS median_within
FROM o GROUP BY o_orderstatus""")
def a9_a14_merged_sketches(spark, sf_dir):
    """Sketches stored by status and year, merged over the years without a rescan; the estimates lie within
    five standard errors of the exact count and within 2 % of the rank of the exact median."""
    from voltlens.operators import sketches as SK
    from voltlens.operators.prefix import materialize
    o = A.read(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    stored = materialize(SK.sketch_table(o, ["o_orderstatus", "year"], ["o_custkey"], ["o_totalprice"]))
    merged = SK.estimates(SK.merge(stored, "o_orderstatus"), [0.5]).withColumnRenamed("o_orderstatus", "_s")
    exact = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").alias("customers"))
    below = o.join(F.broadcast(merged.select("_s", F.col("`o_totalprice_q0.5`").alias("_m"))), F.col("o_orderstatus") == F.col("_s")).groupBy(
        F.col("o_orderstatus").alias("_b")).agg(F.avg((F.col("o_totalprice") <= F.col("_m")).cast("double")).alias("share"))
    out = exact.join(merged, F.col("o_orderstatus") == F.col("_s")).join(below, F.col("o_orderstatus") == F.col("_b"))
    near = F.abs(F.col("o_custkey_distinct") - F.col("customers")) <= 5 * SK.distinct_error() * F.col("customers") + 1
    return out.select("o_orderstatus", "n", "customers", near.alias("distinct_within"),
                      (F.abs(F.col("share") - 0.5) <= 0.02 + 1 / F.col("n")).alias("median_within"))

"""Classification metrics (E1-E11) as aggregations over distinct scores.

Curves and AUC never sort the full table in one task: rows are first counted
per (class, distinct score), then cumulative counts come from the ranged
running sum in ``prefix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlens.functions.schema import q
from voltlens.operators.prefix import running_sum, with_group_values


def _by(by):
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def score_counts(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """(by..., score, pos, neg) with label 1 = positive; rows without a score (NULL or NaN) are left out."""
    by = _by(by)
    y = F.col(q(label)).cast("int")
    return (df.where(F.col(q(score)).isNotNull() & ~F.isnan(F.col(q(score)).cast("double")))
              .groupBy(*by, F.col(q(score)).cast("double").alias("score"))
              .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("pos"),
                   F.sum(F.when(y == 1, 0).otherwise(1)).cast("long").alias("neg")))


def curve(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """One point per distinct threshold (descending): tp, fp, tpr, fpr,
    precision, recall. All thresholds are kept (no collinear-point pruning)."""
    by = _by(by)
    c = score_counts(df, label, score, by)
    r = running_sum(c, ["score"], ["pos", "neg"], by=by, descending=True, totals=True)
    r = r.withColumnsRenamed({"pos_total": "P", "neg_total": "N"})
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    return r.select(*by, F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    F.try_divide(tp, F.col("P")).alias("tpr"), F.try_divide(fp, F.col("N")).alias("fpr"),
                    F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, F.col("P")).alias("recall"))


def auc(df: DataFrame, label: str, score: str, by=None) -> DataFrame:
    """ROC AUC = P(score+ > score-) + 0.5 P(tie), i.e. the rank-sum
    statistic with averaged ties (equals the trapezoid under the full curve)."""
    by = _by(by)
    c = score_counts(df, label, score, by)
    r = running_sum(c, ["score"], ["neg"], by=by)  # ascending, inclusive
    g = by
    below = (F.col("neg_cum") - F.col("neg")).cast("double")
    a = r.groupBy(*g).agg(F.sum(F.col("pos") * (below + F.col("neg") * 0.5)).alias("_s"),
                          F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # counts are multiplied as doubles: P * N of a few billion each exceeds BIGINT
    return a.select(*by, F.try_divide(F.col("_s"), F.col("P").cast("double") * F.col("N")).alias("auc"),
                    F.col("P").alias("positives"), F.col("N").alias("negatives"))


def one_vs_rest(df: DataFrame, label: str, prob_cols: dict) -> DataFrame:
    """Long table (class, y, p): one row per input row and class."""
    parts = ", ".join(f"{k!r}, CAST({q(label)} = {k!r} AS INT), CAST({q(c)} AS DOUBLE)"
                      if isinstance(k, str) else
                      f"{k}, CAST({q(label)} = {k} AS INT), CAST({q(c)} AS DOUBLE)"
                      for k, c in prob_cols.items())
    return df.selectExpr(f"stack({len(prob_cols)}, {parts}) AS (class, y, p)")


def weighted_ovr_auc(df: DataFrame, label: str, prob_cols: dict) -> DataFrame:
    """Support-weighted mean of per-class one-vs-rest AUC."""
    per = auc(one_vs_rest(df, label, prob_cols), "y", "p", by="class")
    return per.agg((F.sum(F.col("auc") * F.col("positives")) / F.sum("positives")).alias("auc_weighted"),
                   F.avg("auc").alias("auc_macro"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, pred, n) counts."""
    return df.groupBy(F.col(q(label)).alias("label"), F.col(q(pred)).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision, recall, f1, support (zero division -> 0)."""
    cf = confusion(df, label, pred)
    a = cf.select(F.col("label").alias("class"), F.when(F.col("label") == F.col("pred"), F.col("n")).alias("tp"),
                  F.col("n").alias("support"), F.lit(0).alias("predicted"))
    b = cf.select(F.col("pred").alias("class"), F.lit(None).cast("long").alias("tp"), F.lit(0).cast("long")
                  .alias("support"), F.col("n").alias("predicted"))
    u = a.unionByName(b).groupBy("class").agg(F.coalesce(F.sum("tp"), F.lit(0)).alias("tp"),
                                               F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    u = u.withColumns({"precision": prec, "recall": rec})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return u.withColumn("f1", f1).select("class", "precision", "recall", "f1", F.col("support").cast("long"),
                                         F.col("tp").cast("long"))


def summary(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy and weighted / macro precision, recall, F1."""
    pc = per_class(df, label, pred)
    n = F.sum("support")
    return pc.agg((F.sum("tp") / n).alias("accuracy"),
                  (F.sum(F.col("precision") * F.col("support")) / n).alias("precision_weighted"),
                  (F.sum(F.col("recall") * F.col("support")) / n).alias("recall_weighted"),
                  (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
                  F.avg("f1").alias("f1_macro"))


def best_f1_threshold(curve_df: DataFrame, by=None) -> DataFrame:
    """Threshold maximising 2PR/(P+R+1e-9); the smallest threshold wins ties."""
    by = _by(by)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-9))
    c = curve_df.withColumn("f1", f1)
    return c.groupBy(*by).agg(F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("threshold"),
                              F.max("f1").alias("f1"))


def equal_pr_threshold(curve_df: DataFrame, by=None) -> DataFrame:
    """Threshold minimising |precision - recall| (smallest on ties)."""
    by = _by(by)
    gap = F.abs(F.col("precision") - F.col("recall"))
    c = curve_df.withColumn("gap", gap)
    return c.groupBy(*by).agg(F.min_by("threshold", F.struct(F.col("gap"), F.col("threshold"))).alias("threshold"),
                              F.min("gap").alias("gap"))


def calibration(df: DataFrame, label: str, prob: str, n_bins: int = 10, by=None) -> DataFrame:
    """Quantile-binned reliability curve: bin edges are the exact
    quantiles of the probabilities, a row's bin is the number of inner edges
    strictly below it, empty bins are absent."""
    from voltlens.operators.profile import exact_quantiles

    by = _by(by)
    probs = [i / n_bins for i in range(1, n_bins)]
    names = [f"_e{i}" for i in range(1, n_bins)]
    edges = exact_quantiles(df, prob, probs, by=by, names=names).drop("n")
    j = with_group_values(df, edges, by)
    b = None
    for nm in names:
        t = F.when(F.col(nm) < F.col(q(prob)), 1).otherwise(0)
        b = t if b is None else b + t
    j = j.withColumn("bin", b.cast("long"))
    return j.groupBy(*by, "bin").agg(F.avg(F.col(q(label)).cast("double")).alias("prob_true"),
                                      F.avg(F.col(q(prob)).cast("double")).alias("prob_pred"),
                                      F.count(F.lit(1)).alias("n"))


def binarize(df: DataFrame, label: str, classes, prefix: str = "y_") -> DataFrame:
    """One 0/1 column per class."""
    return df.withColumns({f"{prefix}{c}": (F.col(q(label)) == F.lit(c)).cast("int") for c in classes})

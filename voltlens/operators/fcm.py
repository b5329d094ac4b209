"""Fuzzy c-means for every zone in one distributed job per iteration.

Bezdek's alternating updates with fuzzifier m:

    u_ik = 1 / sum_j (d2_ik / d2_jk) ** (1 / (m - 1))        (memberships)
    c_k  = sum_i u_ik^m x_i / sum_i u_ik^m                     (centres)

The zone is a grouping key. Each iteration joins the current centres (a
zones x K x d table built from driver-side numbers, so lineage never grows)
onto the cached feature rows, computes memberships with unrolled column
arithmetic (whole-stage codegen, no arrays or UDFs) and aggregates the new
centres with one ``groupBy(zone)`` whose partial aggregation makes a zone that
holds a third of all rows no harder than any other. A row sitting exactly on
centres shares membership 1 among them (ANSI mode would raise on 0/0).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _d2(k: int, d: int, x="f", c="c") -> Column:
    s = None
    for j in range(d):
        t = (F.col(f"{x}{j}") - F.col(f"{c}{k}_{j}"))
        t = t * t
        s = t if s is None else s + t
    return s


def add_memberships(df: DataFrame, K: int, d: int, m: float, x="f", c="c", out="u") -> DataFrame:
    """Add ``u0..u{K-1}`` from features ``x*`` and centre columns ``c{k}_{j}``.

    Squared distances are projected first and referenced by name, so the
    membership expressions stay small enough for whole-stage codegen (one
    inlined tree would repeat every distance K^2 times).
    """
    df = df.withColumns({f"_d{k}": _d2(k, d, x, c) for k in range(K)})
    zeros = None
    for k in range(K):
        z = F.when(F.col(f"_d{k}") == 0, 1).otherwise(0)
        zeros = z if zeros is None else zeros + z
    df = df.withColumn("_nz", zeros)
    p = 1.0 / (m - 1.0)
    cols = {}
    for k in range(K):
        s = None
        for j in range(K):
            r = F.col(f"_d{k}") / F.col(f"_d{j}")
            t = r if p == 1.0 else F.pow(r, F.lit(p))
            s = t if s is None else s + t
        cols[f"{out}{k}"] = F.when(F.col("_nz") > 0, F.when(F.col(f"_d{k}") == 0, F.lit(1.0) / F.col("_nz"))
                                   .otherwise(F.lit(0.0))).otherwise(F.lit(1.0) / s)
    return df.withColumns(cols).drop(*[f"_d{k}" for k in range(K)], "_nz")


def centre_aggs(K: int, d: int, m: float, x="f", u="u") -> list:
    aggs = []
    for k in range(K):
        w = F.pow(F.col(f"{u}{k}"), F.lit(float(m))) if m != 2.0 else F.col(f"{u}{k}") * F.col(f"{u}{k}")
        aggs.append(F.sum(w).alias(f"_w{k}"))
        for j in range(d):
            aggs.append(F.sum(w * F.col(f"{x}{j}")).alias(f"_s{k}_{j}"))
    return aggs


def default_init(K: int, seed: int, cols) -> list:
    """Initial weights per cluster from a seeded hash of the row's features."""
    return [(F.abs(F.xxhash64(F.lit(seed), F.lit(k), *[F.col(c) for c in cols])) % 1000003 + 1).cast("double")
            for k in range(K)]


@dataclass
class FcmModel:
    zone_col: str
    K: int
    d: int
    m: float
    centres: dict          # zone -> list of K lists of d floats, sorted
    iterations: int
    converged: bool | None = None   # the last centre move was below the tolerance
    shift: float = math.inf         # the largest move of a centre coordinate in the last update

    def centres_df(self, spark: SparkSession, prefix: str = "c") -> DataFrame:
        """One row per zone with columns ``c{k}_{j}``: a table whose size is
        zones x K x d, known on the driver."""
        from pyspark.sql import types as T
        fields = [T.StructField(self.zone_col, T.StringType())] + [
            T.StructField(f"{prefix}{k}_{j}", T.DoubleType()) for k in range(self.K) for j in range(self.d)]
        rows = [[z] + [float(v) for cen in cs for v in cen] for z, cs in self.centres.items()]
        return spark.createDataFrame(rows, T.StructType(fields))

    def centres_long(self, spark: SparkSession) -> DataFrame:
        """(zone, cluster, x0..x{d-1}) for reporting and the model store."""
        from pyspark.sql import types as T
        fields = [T.StructField(self.zone_col, T.StringType()), T.StructField("cluster", T.LongType())] + [
            T.StructField(f"x{j}", T.DoubleType()) for j in range(self.d)]
        rows = [[z, k] + [float(v) for v in cen] for z, cs in self.centres.items() for k, cen in enumerate(cs)]
        return spark.createDataFrame(rows, T.StructType(fields))


# largest centre table (zones x K x d numbers) sent as a broadcast: 4M doubles = 32 MB
BROADCAST_NUMBERS = 4_000_000


def _attach_model(feats: DataFrame, model: "FcmModel", prefix: str = "c") -> DataFrame:
    """Add centre columns ``c{k}_{j}`` for each row's zone; rows of zones
    without a model are dropped (inner semantics, J10).

    The centres are a broadcast table (zones x K x d numbers, size known on
    the driver). Passing them as data rather than literals keeps the generated
    code identical between iterations, so it is compiled once.
    """
    cdf = model.centres_df(feats.sparkSession, prefix)
    if len(model.centres) * model.K * model.d <= BROADCAST_NUMBERS:
        cdf = F.broadcast(cdf)
    # beyond the bound (very many zones) the centres table is joined by a shuffle
    return feats.join(cdf, on=model.zone_col, how="inner")


def fit(feats: DataFrame, zone_col: str, d: int, K: int = 3, m: float = 2.0, max_iter: int = 150,
        tol: float = 1e-5, init: list | None = None, seed: int = 42, x: str = "f") -> FcmModel:
    """K7: fit all zones at once on ``feats`` (zone, f0..f{d-1}), rows already
    distinct per zone (D11). ``init`` gives K positive weight expressions
    (default: seeded hash of the features). Stops when the largest centre move
    is below ``tol`` or after ``max_iter`` centre updates; the model says which
    (``converged``) and how far the centres moved last (``shift``)."""
    fcols = [f"{x}{j}" for j in range(d)]
    w = init or default_init(K, seed, fcols)
    # one cached pass over the features: the start weights ride along, so the
    # feature pipeline below is computed once for the whole fit
    base = feats.select(zone_col, *fcols, *[e.cast("double").alias(f"_w{k}") for k, e in enumerate(w)]).persist()
    tot = None
    for k in range(K):
        tot = F.col(f"_w{k}") if tot is None else tot + F.col(f"_w{k}")
    u0 = base.select(zone_col, *fcols, *[(F.col(f"_w{k}") / tot).alias(f"u{k}") for k in range(K)])
    centres = _collect_centres(u0.groupBy(zone_col).agg(*centre_aggs(K, d, m, x)), zone_col, K, d)
    it, shift, converged = 1, math.inf, False
    while it < max_iter:
        model = FcmModel(zone_col, K, d, m, centres, it)
        j = add_memberships(_attach_model(base.select(zone_col, *fcols), model), K, d, m, x)
        new = _collect_centres(j.groupBy(zone_col).agg(*centre_aggs(K, d, m, x)), zone_col, K, d)
        it += 1
        shift = max((abs(a - b) for z in new for ca, cb in zip(new[z], centres.get(z, new[z]))
                     for a, b in zip(ca, cb)), default=0.0)
        centres = new
        if shift < tol:
            converged = True
            break
    base.unpersist()
    sorted_centres = {z: sorted(cs) for z, cs in centres.items()}
    return FcmModel(zone_col, K, d, m, sorted_centres, it, converged, shift)


def _collect_centres(agg: DataFrame, zone_col: str, K: int, d: int) -> dict:
    """zones x K x d numbers to the driver (bounded by the zone count)."""
    out = {}
    for r in agg.collect():
        cs = []
        for k in range(K):
            wk = r[f"_w{k}"]
            cs.append([(r[f"_s{k}_{j}"] / wk) if wk else math.nan for j in range(d)])
        out[r[zone_col]] = cs
    return out


def predict(feats: DataFrame, model: FcmModel, x: str = "f", keep_centres: bool = False) -> DataFrame:
    """Memberships ``cluster_0..K-1`` and the hard label ``cluster_id``
    (first maximum); rows of zones without a model are dropped."""
    j = add_memberships(_attach_model(feats, model), model.K, model.d, model.m, x, out="cluster_")
    best = None
    for k in range(model.K - 1, -1, -1):
        cond = None
        for o in range(model.K):
            if o == k:
                continue
            c = F.col(f"cluster_{k}") > F.col(f"cluster_{o}") if o < k else F.col(f"cluster_{k}") >= F.col(f"cluster_{o}")
            cond = c if cond is None else cond & c
        best = F.when(cond, F.lit(k)) if best is None else F.when(cond, F.lit(k)).otherwise(best)
    j = j.withColumn("cluster_id", best.cast("long"))
    if not keep_centres:
        j = j.drop(*[f"c{k}_{i}" for k in range(model.K) for i in range(model.d)])
    return j


def partition_scores(pred: DataFrame, model: FcmModel) -> DataFrame:
    """K9: per zone PC = mean_i sum_k u^2 and PEC = mean_i -sum_k u ln u
    (Bezdek 1981, natural log)."""
    pc = None
    pe = None
    for k in range(model.K):
        u = F.col(f"cluster_{k}")
        a = u * u
        b = F.when(u > 0, -u * F.log(u)).otherwise(F.lit(0.0))
        pc = a if pc is None else pc + a
        pe = b if pe is None else pe + b
    return pred.groupBy(model.zone_col).agg(F.avg(pc).alias("PC"), F.avg(pe).alias("PEC"))


def silhouette_sq(pred: DataFrame, zone_col: str, d: int, K: int, label: str = "cluster_id",
                  x: str = "f") -> DataFrame:
    """K10 (re-aimed): exact silhouette per zone with squared Euclidean distance.

    The mean squared distance from a row to cluster C is
    ||x||^2 - 2 x.mean_C + mean_C ||y||^2, so one aggregation per (zone,
    cluster) replaces the all-pairs distance matrix (the Euclidean version
    needs every pair and is not offered at scale). a(i) excludes the row
    itself (factor n_C / (n_C - 1)); a row alone in its cluster scores 0; a
    zone with a single non-empty cluster gets NULL.
    """
    from voltlens.operators.prefix import broadcast_checked, materialize

    norm = None
    for j in range(d):
        t = F.col(f"{x}{j}") * F.col(f"{x}{j}")
        norm = t if norm is None else norm + t
    p = pred.select(zone_col, F.col(label).cast("long").alias("_cl"), *[F.col(f"{x}{j}") for j in range(d)],
                    norm.alias("_nx"))
    p = materialize(p)  # the prediction runs once; statistics and scores read the table
    stats = p.groupBy(zone_col).pivot("_cl", list(range(K))).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_nx").alias("mn"), *[F.avg(f"{x}{j}").alias(f"m{j}") for j in range(d)])
    j = p.join(broadcast_checked(stats, 100_000), on=zone_col, how="inner")
    md = {}
    for k in range(K):
        dot = None
        for i in range(d):
            t = F.col(f"{x}{i}") * F.col(f"{k}_m{i}")
            dot = t if dot is None else dot + t
        md[k] = F.col("_nx") - 2 * dot + F.col(f"{k}_mn")
    a = None
    n_own = None
    b = None
    for k in range(K):
        own = F.col("_cl") == k
        a_k = F.try_divide(md[k] * F.col(f"{k}_n"), F.col(f"{k}_n") - 1)
        a = F.when(own, a_k) if a is None else a.when(own, a_k)
        n_own = F.when(own, F.col(f"{k}_n")) if n_own is None else n_own.when(own, F.col(f"{k}_n"))
        other = F.when(~own & (F.coalesce(F.col(f"{k}_n"), F.lit(0)) > 0), md[k])
        b = other if b is None else F.least(b, other)
    s_i = (F.when(n_own <= 1, F.lit(0.0))
            .when(b.isNull(), F.lit(None).cast("double"))
            .otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))))
    return j.groupBy(zone_col).agg(F.avg(s_i).alias("silhouette"), F.count(F.lit(1)).alias("n"))

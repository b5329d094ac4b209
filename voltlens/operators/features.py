"""Per-zone feature preparation.

All statistics are grouped aggregations keyed by zone, so every zone is fitted
in the same job: mean imputation, population standard deviation (MLlib's
StandardScaler uses the sample one, so it is not used), mode imputation with
the smallest value on ties, and ordinal dictionaries in sorted order with -1
for categories not seen at fit time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlens.functions.schema import q
from voltlens.operators.prefix import dense_codes


@dataclass
class ZonePrep:
    """Fitted preprocessing: small DataFrames keyed by zone."""

    zone_col: str
    num_cols: list
    cat_cols: list
    num_stats: DataFrame      # zone, <c>__mean, <c>__scale for numeric c
    modes: DataFrame          # zone, <c> (mode) for categorical c
    dictionary: DataFrame     # zone, column, value, code

    def materialize(self):
        """Write the fitted tables to the shared checkpoint folder (reliable
        checkpoint): later jobs read them without recomputing the fit, and a
        lost executor does not lose them."""
        from voltlens.session import checkpoint_dir

        checkpoint_dir(self.num_stats.sparkSession)

        def cut(df):
            # cached while the checkpoint job runs, so the table is computed once
            c = df.persist()
            out = c.checkpoint()
            c.unpersist()
            return out

        self.num_stats, self.modes, self.dictionary = cut(self.num_stats), cut(self.modes), cut(self.dictionary)
        return self


def _by(zone_col):
    return [zone_col] if zone_col else []


def fit_zone_prep(df: DataFrame, zone_col: str | None, num_cols, cat_cols) -> ZonePrep:
    """K1-K4 fit on ``df`` (already restricted to the fit rows)."""
    by = _by(zone_col)
    g = by or ["_vl_g"]
    src = df if by else df.withColumn("_vl_g", F.lit(0))
    aggs = []
    for c in num_cols:
        x = F.when(~F.isnan(F.col(q(c))), F.col(q(c)))
        aggs += [F.avg(x).alias(f"{c}__mean"), F.var_pop(x).alias(f"_v_{c}"), F.count(x).alias(f"_n_{c}")]
    aggs.append(F.count(F.lit(1)).alias("_n"))
    st = src.groupBy(*g).agg(*aggs)
    cols = [F.col(k) for k in g]
    for c in num_cols:
        # population std of the mean-imputed column: imputed rows add zero deviation
        var_imp = F.col(f"_v_{c}") * F.col(f"_n_{c}") / F.col("_n")
        sd = F.sqrt(var_imp)
        cols += [F.col(f"{c}__mean"), F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd).alias(f"{c}__scale")]
    num_stats = st.select(*cols)

    # categorical columns as one long table: (zone, column, value) counts serve
    # both the modes and the dictionaries in a single shuffle
    stack = ", ".join(f"'{c}', CAST({q(c)} AS STRING)" for c in cat_cols)
    long = src.select(*g, F.expr(f"stack({len(cat_cols)}, {stack}) AS (column, value)"))
    counts = (long.where(F.col("value").isNotNull())
                  .groupBy(*g, "column", "value").agg(F.count(F.lit(1)).alias("_c"))).persist()
    modes_long = counts.groupBy(*g, "column").agg(
        F.min_by("value", F.struct(-F.col("_c"), F.col("value"))).alias("mode"))
    wide = modes_long.groupBy(*g).pivot("column", list(cat_cols)).agg(F.first("mode"))
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    modes = wide.select(*g, *[F.col(q(c)).cast(types[c]).alias(c) for c in cat_cols])
    # imputing with the mode adds no new value, so the dictionary is the sorted
    # distinct non-null values per (zone, column)
    dicts = dense_codes(counts.select(*g, "column", "value"), "value", by=[*g, "column"], name="code")
    dicts = dicts.select(*g, "column", "value", "code")
    prep = ZonePrep(zone_col or "_vl_g", list(num_cols), list(cat_cols), num_stats, modes, dicts).materialize()
    counts.unpersist()
    return prep


def impute_modes(df: DataFrame, modes: DataFrame, keys, cat_cols) -> DataFrame:
    m = modes.select(*keys, *[F.col(q(c)).alias(f"_mode_{c}") for c in cat_cols])
    j = df.join(m, on=keys, how="left")
    return j.withColumns({c: F.coalesce(F.col(q(c)), F.col(f"_mode_{c}")) for c in cat_cols}) \
            .drop(*[f"_mode_{c}" for c in cat_cols])


def transform_zone_prep(df: DataFrame, prep: ZonePrep, out_prefix: str = "f", inner: bool = True) -> DataFrame:
    """Apply K1-K4: adds ``f0..f{d-1}`` (scaled numerics, then codes). Rows of
    zones without a fitted model are dropped when ``inner`` (J10)."""
    zc = prep.zone_col
    src = df if zc in df.columns else df.withColumn(zc, F.lit(0))
    j = src.join(prep.num_stats, on=zc, how="inner" if inner else "left")
    j = impute_modes(j, prep.modes, [zc], prep.cat_cols)
    feats = {}
    for i, c in enumerate(prep.num_cols):
        x = F.when(~F.isnan(F.col(q(c))), F.col(q(c)))
        filled = F.coalesce(x, F.col(f"{c}__mean"))
        feats[f"{out_prefix}{i}"] = (filled - F.col(f"{c}__mean")) / F.col(f"{c}__scale")
    j = j.withColumns(feats).drop(*[f"{c}__mean" for c in prep.num_cols], *[f"{c}__scale" for c in prep.num_cols])
    base = len(prep.num_cols)
    for i, c in enumerate(prep.cat_cols):
        d = (prep.dictionary.where(F.col("column") == c)
             .select(F.col(zc).alias("_dz"), F.col("value").alias("_dv"), F.col("code").alias("_dc")))
        j = j.join(d, (j[zc] == d["_dz"]) & (j[q(c)].cast("string") == d["_dv"]), "left")
        j = j.withColumn(f"{out_prefix}{base + i}", F.coalesce(F.col("_dc"), F.lit(-1)).cast("double")) \
             .drop("_dz", "_dv", "_dc")
    return j


def label_codes(df: DataFrame, col: str, by=None) -> DataFrame:
    """K5/M2: global (or per group) dictionary, sorted values -> 0..n-1; callers
    map NULL to -1 with a left join + coalesce."""
    return dense_codes(df, col, by=by, name="code")


def encode_with(df: DataFrame, dictionary: DataFrame, col: str, out: str, unknown: int = -1) -> DataFrame:
    """Left join a (value, code) dictionary; NULL and unseen values -> ``unknown``."""
    d = dictionary.select(F.col(col).alias("_dv"), F.col("code").alias("_dc"))
    j = df.join(d, df[q(col)] == d["_dv"], "left")
    return j.withColumn(out, F.coalesce(F.col("_dc"), F.lit(unknown))).drop("_dv", "_dc")


def one_hot(df: DataFrame, cols, out_col: str = "onehot"):
    """K6: one-hot with unknown categories as all zeros (StringIndexer keeps an
    extra index for them and OneHotEncoder drops that last slot)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__oh" for c in cols],
                        dropLast=True, handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}__oh" for c in cols], outputCol=out_col)
    return Pipeline(stages=[*idx, ohe, asm])

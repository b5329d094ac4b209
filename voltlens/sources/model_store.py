"""Model store (S15, S16): fitted zone models as Parquet tables keyed by zone,
classifiers through MLlib's own writer."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def save_zone_models(spark: SparkSession, prep, model, path: str) -> None:
    """One folder with four tables; every table is keyed by zone, so a
    new zone is a new key, not a new file."""
    prep.num_stats.write.mode("overwrite").parquet(f"{path}/num_stats")
    prep.modes.write.mode("overwrite").parquet(f"{path}/modes")
    prep.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
    model.centres_long(spark).write.mode("overwrite").parquet(f"{path}/centres")
    meta = {"zone_col": prep.zone_col, "num_cols": prep.num_cols, "cat_cols": prep.cat_cols, "K": model.K,
            "d": model.d, "m": model.m, "iterations": model.iterations, "converged": model.converged,
            "shift": model.shift}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_zone_models(spark: SparkSession, path: str):
    """Load (prep, model); the zones are whatever keys the tables hold."""
    from voltlens.operators.fcm import FcmModel
    from voltlens.operators.features import ZonePrep

    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    prep = ZonePrep(meta["zone_col"], meta["num_cols"], meta["cat_cols"], spark.read.parquet(f"{path}/num_stats"),
                    spark.read.parquet(f"{path}/modes"), spark.read.parquet(f"{path}/dictionary"))
    K, d = meta["K"], meta["d"]
    rows = spark.read.parquet(f"{path}/centres").orderBy(meta["zone_col"], "cluster").collect()
    centres: dict = {}
    for r in rows:
        centres.setdefault(r[meta["zone_col"]], []).append([r[f"x{j}"] for j in range(d)])
    return prep, FcmModel(meta["zone_col"], K, d, meta["m"], centres, meta["iterations"],
                          meta.get("converged"), meta.get("shift", float("inf")))


def save_classifier(model, path: str) -> None:
    """The trees as a table (one row per node), the category statistics as a table,
    bounds and labels beside them."""
    spark, stats, boost = SparkSession.getActiveSession(), model.stats, model.boost
    boost.to_table(spark).write.mode("overwrite").parquet(f"{path}/trees")
    stats.sums.write.mode("overwrite").parquet(f"{path}/statistics")
    meta = {"classes": boost.classes, "features": boost.features, "cuts": boost.cuts, "start": boost.start,
            "cat_cols": stats.cat_cols, "prior_weight": stats.prior_weight, "prior": stats.prior}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_classifier(spark: SparkSession, path: str):
    """Load a saved classifier; a missing store gives None (logged), like the reference."""
    import logging

    from voltlens.operators.boost import BoostModel
    from voltlens.operators.severity import SeverityModel
    from voltlens.operators.target_stats import TargetStatistics

    try:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    except Exception as e:  # noqa: BLE001 - absent store
        logging.getLogger(__name__).error("classifier store not readable at %s: %s", path, e)
        return None
    trees = BoostModel.trees_from(spark.read.parquet(f"{path}/trees").collect())  # the model
    stats = TargetStatistics(meta["cat_cols"], meta["prior_weight"], spark.read.parquet(f"{path}/statistics"), meta["prior"])
    return SeverityModel(stats, BoostModel(meta["classes"], meta["features"], meta["cuts"], meta["start"], trees))

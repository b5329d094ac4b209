"""File and warehouse sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlens.functions.schema import conform, reject_duplicate_names


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, **options) -> None:
    """Write a table; CSV only at the edges (header on)."""
    reject_duplicate_names(df.columns)
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def write_snapshot(df: DataFrame, path: str, run_ts: str, fmt: str = "parquet") -> None:
    """Append a run snapshot under ``run_ts=<time>`` (one folder per run)."""
    write_table(df.withColumn("run_ts", F.lit(run_ts)), path, fmt, mode="append", partition_by="run_ts")


def load_enforced(df: DataFrame, schema: T.StructType, path: str, fmt: str = "parquet",
                  mode: str = "overwrite") -> int:
    """Conform to the target schema, write (truncate-load with
    ``overwrite``) and report the number of rows written, counted while
    writing (``observe``) instead of by a second scan."""
    obs = Observation("load")
    out = conform(df, schema).observe(obs, F.count(F.lit(1)).alias("rows"))
    write_table(out, path, fmt, mode)
    return int(obs.get["rows"])


def write_dictionary(spark: SparkSession, mapping_df: DataFrame, path: str) -> None:
    """Category dictionary as a long table (column, code, label) in JSON."""
    mapping_df.select("column", F.col("code").cast("long"), F.col("label").cast("string")) \
        .write.mode("overwrite").json(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column STRING, code BIGINT, label STRING").json(path)


def write_duplicates(df: DataFrame, keys, path: str, fmt: str = "csv") -> int:
    """Write only rows of key groups with more than one row, if any;
    returns the number written (nothing is written when it is zero)."""
    from voltlens.operators.dedupe import duplicated_flag
    from voltlens.operators.prefix import materialize

    dups = materialize(duplicated_flag(df, keys, "_vl_dup").where(F.col("_vl_dup")).drop("_vl_dup"))
    n = dups.count()
    if n:
        write_table(dups, path, fmt)
    return n


def split_rejects(df: DataFrame, required, good_path: str, bad_path: str, fmt: str = "parquet") -> tuple[int, int]:
    """Rows missing any required field go to ``bad_path``, the rest to
    ``good_path``. The input is computed once, into a table of the shared folder;
    both writes read that table."""
    from voltlens.operators.prefix import materialize
    from voltlens.operators.profile import any_null

    flagged = materialize(df.withColumn("_vl_bad", any_null(required)))
    ob_g, ob_b = Observation("good"), Observation("bad")
    write_table(flagged.where(~F.col("_vl_bad")).drop("_vl_bad").observe(ob_g, F.count(F.lit(1)).alias("n")),
                good_path, fmt)
    write_table(flagged.where(F.col("_vl_bad")).drop("_vl_bad").observe(ob_b, F.count(F.lit(1)).alias("n")),
                bad_path, fmt)
    return int(ob_g.get["n"]), int(ob_b.get["n"])


def write_metrics(df: DataFrame, path: str) -> None:
    """Small metric tables as one CSV file."""
    write_table(df.coalesce(1), path, "csv")

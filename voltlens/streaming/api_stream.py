"""C9 as a file stream: newly landed API record files (JSON lines) are
validated and appended to the sink; the checkpoint records which files were
processed, so a restarted query (or a lost executor) neither drops nor
duplicates a batch. ``availableNow`` processes everything present and stops,
which suits a scheduled run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlens.sources import api_json


@dataclass
class Running:
    """The queries of one stream (accepted and rejected records)."""

    queries: list

    def awaitTermination(self) -> None:
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def _append(path: str):
    def batch(df: DataFrame, epoch: int) -> None:
        # idempotent per epoch: a replayed batch overwrites its own partition
        (df.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(path))
    return batch


def start(spark: SparkSession, landing: str, sink: str, checkpoint: str, run_year: int, run_ts: str,
          reject_sink: str | None = None, available_now: bool = True, max_files_per_trigger: int = 1000,
          dedupe_window: str | None = None) -> Running:
    """Accepted records go to ``sink``, rejected ones with their reason to ``reject_sink`` (default:
    ``<sink>_rejects``), each by a query with a checkpoint of its own.

    With ``dedupe_window`` an accepted (odt, orden) that an earlier batch or file of that span brought is dropped: the
    pairs are state, kept by the checkpoint over restarts, and forgotten once the files' modification time is
    further on than the window. Rejected records never take the place of a later accepted one."""
    lines = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
             .load(landing).select("value", F.col("_metadata.file_modification_time").alias("_seen")))
    records = lines.where(F.trim("value") != "").select(F.try_parse_json("value").alias("r"), F.col("value").alias("raw"), "_seen")
    if dedupe_window:
        records = records.withWatermark("_seen", dedupe_window)
    ok, bad = api_json.validate(records, run_year, run_ts, ["_seen"])
    if dedupe_window:
        ok = ok.dropDuplicatesWithinWatermark(["odt", "orden"])
    queries = []
    for rows, path, name in ((ok.drop("_seen"), sink, checkpoint), (bad, reject_sink or f"{sink.rstrip('/')}_rejects", f"{checkpoint.rstrip('/')}_rejects")):
        w = rows.writeStream.foreachBatch(_append(path)).option("checkpointLocation", name)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        queries.append(w.start())
    return Running(queries)

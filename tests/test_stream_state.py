"""The record stream: pairs seen before are dropped over files and restarts, rejects are kept."""

import json

from voltlens.session import scratch_path
from voltlens.streaming import api_stream


def record(odt, orden, lat=1.5):
    return json.dumps({"odt": odt, "orden": orden, "LATI_USU": lat, "LONG_USU": -77.0, "PLAN_COMERCIAL": "P", "ZONA": "Z"})


def land(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_repeated_records_restart_and_rejects(spark):
    landing, sink, ck = (scratch_path(spark, n) for n in ("land", "sink", "ck"))

    def run(window="7 days"):
        api_stream.start(spark, landing, sink, ck, 2024, "2024-01-01 00:00:00", dedupe_window=window).awaitTermination()
        return sorted((r.odt, r.orden) for r in spark.read.parquet(sink).collect())

    # (3, 4) comes without a latitude first: rejected, and no reason to drop the good one
    land(spark, landing, [record(1, 2), record(1, 2), record(3, 4, None), "not json", ""])
    assert run() == [(1, 2)]
    land(spark, landing, [record(1, 2), record(3, 4), record(5, 6)])
    assert run() == [(1, 2), (3, 4), (5, 6)]  # a new query on the same checkpoint
    assert run() == [(1, 2), (3, 4), (5, 6)]  # nothing new
    bad = spark.read.parquet(f"{sink}_rejects").collect()
    assert sorted(r.reason for r in bad) == ["not JSON", "value does not cast"]

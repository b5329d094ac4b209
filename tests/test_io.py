"""Sources and sinks: CSV modes, JDBC round trip, model store, stream vs batch."""

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlens.session import scratch_path
from voltlens.sources import api_json, files, jdbc, sinks

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])


def test_csv_permissive_keeps_corrupt_line(spark):
    path = scratch_path(spark, "csv-test")
    spark.createDataFrame([("a,b",), ("1,2.5",), ("x,3",)], "value string").coalesce(1).write.text(path)
    df = files.read_csv(spark, path, SCHEMA, corrupt_col="_bad").collect()
    good = [r for r in df if r._bad is None]
    bad = [r for r in df if r._bad is not None]
    assert [(r.a, r.b) for r in good] == [(1, 2.5)]
    assert bad[0]._bad == "x,3"


def test_optional_and_mandatory_sources(spark):
    import pytest

    assert files.optional_source(spark, "/nonexistent/x.parquet") is None
    with pytest.raises(FileNotFoundError):
        files.optional_source(spark, "/nonexistent/x.parquet", mandatory=True)


def test_jdbc_round_trip_and_count(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    df = spark.range(0, 2500).select(F.col("id").alias("ID"), (F.col("id") * 0.5).alias("V"))
    assert jdbc.append(df, url, "T", batch_size=1000) == 2500
    back = jdbc.read_table(spark, url, "T", partition_column="ID", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.agg(F.sum("V")).first()[0] == df.agg(F.sum("V")).first()[0]


def test_enforced_load_and_rejects(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 1.0), (3, "z", 2.0)], "k long, s string, d double")
    target = T.StructType([T.StructField("k", T.LongType()), T.StructField("d", T.DoubleType()),
                           T.StructField("extra", T.StringType())])
    path = scratch_path(spark, "load")
    assert sinks.load_enforced(df, target, path) == 3
    assert spark.read.parquet(path).columns == ["k", "d", "extra"]
    good, bad = scratch_path(spark, "g"), scratch_path(spark, "b")
    assert sinks.split_rejects(df, ["s", "d"], good, bad) == (1, 2)


def test_zone_model_store_round_trip(spark):
    from voltlens.plans import pipelines as P
    from voltlens.sources import model_store

    rows = [(f"Z{i % 2}", float(i), float(i % 5), f"T{i % 3}", "A", "P", "S") for i in range(40)]
    df = spark.createDataFrame(rows, "ZONA string, LATI_USU double, LONG_USU double, TRAFO_OPEN string, "
                                     "AREA string, PLAN_COMERCIAL string, SUB_CATEGORIA string")
    prep, model, _ = P.train_zones(df, max_iter=5)
    path = scratch_path(spark, "store")
    model_store.save_zone_models(spark, prep, model, path)
    prep2, model2 = model_store.load_zone_models(spark, path)
    assert model2.centres == model.centres
    a = P.predict_zones(df, prep, model).select("LATI_USU", "cluster_id").orderBy("LATI_USU").collect()
    b = P.predict_zones(df, prep2, model2).select("LATI_USU", "cluster_id").orderBy("LATI_USU").collect()
    assert a == b


def test_stream_equals_batch(spark):
    from voltlens.streaming import api_stream

    land = scratch_path(spark, "land")
    recs = [{"odt": i, "orden": i + 1, "LATI_USU": 1.0 + i, "LONG_USU": -77.0, "PLAN_COMERCIAL": "P", "ZONA": "Z"}
            for i in range(20)] + [{"odt": 99, "orden": 1}]
    spark.createDataFrame([(json.dumps(r),) for r in recs], "value string").repartition(3).write.text(land)
    sink = scratch_path(spark, "sink")
    q = api_stream.start(spark, land, sink, scratch_path(spark, "ck"), 2024, "2024-01-01 00:00:00")
    q.awaitTermination()
    streamed = spark.read.parquet(sink).drop("_epoch")
    batch, _ = api_json.validate(api_json.read_records(spark, land, json_lines=True), 2024, "2024-01-01 00:00:00")
    assert streamed.count() == 20
    assert sorted(streamed.select("odt").collect()) == sorted(batch.select("odt").collect())


def test_ingest_ordinal_follows_file_order_across_splits(spark):
    path = scratch_path(spark, "ord-csv")
    lines = ["k,v"] + [f"{i % 7},{i}" for i in range(5000)]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_csv(spark, path, "k long, v long", ordinal="_ord")
        assert df.rdd.getNumPartitions() > 1
        ordered = [r.v for r in df.orderBy("_ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ordered == list(range(5000))


def test_large_ids_do_not_meet(spark):
    from voltlens.functions.casts import is_fractional, nullable_long
    from voltlens.operators import joins

    a, b = 9007199254740993, 9007199254740992
    rows = [(str(a), a), (f" {a}.0 ", a), ("12.0", 12), ("1.2E1", 12), ("12.5", None), ("x", None), ("NaN", None),
            (None, None), ("-7", -7), ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None)]
    df = spark.createDataFrame(rows, "t string, want long")
    for r in df.select("*", nullable_long("t").alias("got"), is_fractional("t").alias("f")).collect():
        assert r.got == r.want and r.f == (r.t == "12.5") , r
    left, right = spark.createDataFrame([(a,)], "k long"), spark.createDataFrame([(b, "no")], "ok long, v string")
    assert joins.left_join_mixed_keys(left, right, "k", "ok").first().v is None
    d = spark.createDataFrame([(12.0,), (2.5,), (float("nan"),), (1e300,)], "d double")
    assert [r[0] for r in d.select(nullable_long("d")).collect()] == [12, None, None, None]


def test_not_json_is_rejected_and_the_rest_loads(spark):
    good = json.dumps({"odt": 1, "orden": 2, "LATI_USU": 1.0, "LONG_USU": -77.0, "PLAN_COMERCIAL": "P", "ZONA": "Z"})
    path = scratch_path(spark, "bad-lines")
    spark.createDataFrame([(good,), ("{broken",), ("[1, 2",), ("  ",), ("null",)], "value string").write.text(path)
    ok, bad = api_json.validate(api_json.read_records(spark, path, json_lines=True), 2024, "t")
    assert [r.odt for r in ok.collect()] == [1]
    assert sorted((r.record, r.reason) for r in bad.collect()) == [
        ("[1, 2", "not JSON"), ("null", "missing required field"), ("{broken", "not JSON")]


def test_limit_read_sends_the_query(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    jdbc.append(spark.range(0, 500).select(F.col("id").alias("ID")), url, "T")
    df = jdbc.limit_read(spark, url, "T", "ID", 7)
    assert sorted(r.ID for r in df.collect()) == list(range(7))
    assert "TakeOrdered" not in df._jdf.queryExecution().executedPlan().toString()

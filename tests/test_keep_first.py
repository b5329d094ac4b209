"""Keep-first and widening by a BIGINT ordinal: results, ties, and plans without sort aggregates."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from voltlens.operators import dedupe, eav
from voltlens.session import scratch_path
from voltlens.sources import files

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["a2_keep_first", "w3_first_row_per_key", "j5_lookup_join", "j9_eav_widen", "c1_process_data",
                                  "c2_clean"])
def test_no_sort_aggregate(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_null_keys_repeated_keys_and_names(spark):
    df = spark.createDataFrame([(1, None, "a", 5), (2, None, "b", 3), (3, "k", "c", 9), (4, "k", "d", 8), (5, "z", None, 1)],
                               "n long, key string, `v.x` string, _ord long")
    got = sorted((tuple(r) for r in dedupe.keep_first(df, "key").collect()), key=str)
    assert got == [(2, None, "b", 3), (4, "k", "d", 8), (5, "z", None, 1)]
    assert dedupe.keep_first(df, ["key"], keep_order=False).columns == ["n", "key", "v.x"]
    assert dedupe.keep_first(df.where("n > 9"), "key").collect() == []


def test_shared_ordinals_are_settled_by_the_row(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", "b", 1), ("k", "b", 1), ("q", "x", 2), ("q", "x", 2)], "key string, v string, _ord long")
    one = dedupe.keep_first(df, "key", unique=False).collect()
    two = dedupe.keep_first(df.repartition(5), "key", unique=False).collect()
    assert sorted(one) == sorted(two) and sorted(r.key for r in one) == ["k", "q"]
    plain = dedupe.keep_first(df.drop("_ord"), "key", order_col=None)
    assert plain.columns == ["key", "v"] and plain.count() == 2


def test_widen_takes_first_values(spark):
    rows = [(1, 10, "late", 7), (1, 10, "first", 2), (1, 11, None, 3), (1, 11, "x", 4), (2, 11, "y", 5), (3, 99, "other", 6)]
    df = spark.createDataFrame(rows, "odt long, id int, value string, _ord long")
    got = {r.odt: (r.item_10, r.item_11, r.item_12) for r in eav.widen(df, [10, 11, 12]).collect()}
    assert got == {1: ("first", None, None), 2: (None, "y", None)}


def test_ordinals_are_unique_and_follow_the_files(spark):
    path = scratch_path(spark, "ord-parquet")
    spark.range(1000).repartitionByRange(4, "id").write.parquet(path)
    df = files.read_table(spark, path, ordinal="_ord")
    assert dict(df.dtypes)["_ord"] == "bigint" and df.select("_ord").distinct().count() == 1000
    by_file = df.withColumn("f", F.shiftright("_ord", files.ROW_BITS)).groupBy("f").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).orderBy("f").collect()
    assert [r.f for r in by_file] == [0, 1, 2, 3] and all(r.hi - r.lo + 1 == r.n for r in by_file)

import pytest
from pyspark.errors import AnalysisException

from voltlens.session import scratch_path
from voltlens.sources import sinks


def test_nothing_is_written_without_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k long, v string")
    path = scratch_path(spark, "dups")
    assert sinks.write_duplicates(df.where("v IN ('a', 'c')"), "k", path, "parquet") == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    assert sinks.write_duplicates(df, "k", path, "parquet") == 4
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["a", "b", "d", "e"]

"""Splits, folds and the API record rules (FIXTURES.md section 9)."""

import json

from pyspark.sql import functions as F

from voltlens.operators import classify as CL
from voltlens.session import scratch_path
from voltlens.sources import api_json


def test_split_disjoint_and_proportional(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("s"))
    out = CL.stratified_split(df, ["s"], CL.hash_key(["id"]), ["id"], 0.2)
    counts = {(r.s, r.is_test): r["count"] for r in out.groupBy("s", "is_test").count().collect()}
    for s in range(3):
        n = counts[(s, True)] + counts[(s, False)]
        assert counts[(s, True)] == round(n * 0.2)
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000


def test_folds_balanced(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("y"))
    out = CL.stratified_folds(df, "y", CL.hash_key(["id"]), ["id"], k=5)
    sizes = [r["count"] for r in out.groupBy("y", "fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_api_rules(spark):
    recs = [
        {"odt": 1, "orden": 2, "LATI_USU": 1.5, "LONG_USU": -77.0, "PLAN_COMERCIAL": None, "ZONA": "Z"},  # kept
        {"odt": 3, "orden": 4, "LATI_USU": 1.0, "LONG_USU": -77.0, "ZONA": "Z"},                    # missing field
        {"odt": 5, "orden": 6, "LATI_USU": None, "LONG_USU": -77.0, "PLAN_COMERCIAL": "P", "ZONA": "Z"},  # null lat
        {"odt": "x", "orden": 6, "LATI_USU": 1.0, "LONG_USU": -77.0, "PLAN_COMERCIAL": "P", "ZONA": "Z"},  # no cast
        {"odt": 7, "orden": 8.9, "LATI_USU": "2.5", "LONG_USU": -77.0, "PLAN_COMERCIAL": "P", "ZONA": "Z",
         "unknown": 1, "item_23": None},                                                           # kept
    ]
    path = scratch_path(spark, "api-test")
    spark.createDataFrame([(json.dumps({"anomalias": recs}),)], "value string").coalesce(1).write.text(path + "/a")
    spark.createDataFrame([(json.dumps({"other": []}),)], "value string").coalesce(1).write.text(path + "/b")
    rec = api_json.read_records(spark, path + "/*")
    ok, bad = api_json.validate(rec, 2024, "2024-01-01 00:00:00")
    rows = {r.odt: r for r in ok.collect()}
    assert set(rows) == {1, 7}
    assert rows[1].PLAN_COMERCIAL is None and rows[1].NIVEL == 0.0 and rows[1].item_23 == "NO"
    assert rows[7].orden == 8 and rows[7].LATI_USU == 2.5 and rows[7].item_23 is None
    assert "unknown" not in ok.columns
    assert sorted(r.reason for r in bad.collect()) == ["missing required field", "value does not cast",
                                                       "value does not cast"]


def test_records_are_parsed_once(spark, tmp_path):
    """A filter on the fields does not repeat the parsing; a broken document or line is rejected with its text."""
    good = '{"odt": 1, "orden": 2, "LATI_USU": 1.50, "LONG_USU": -7, "PLAN_COMERCIAL": "p", "ZONA": "z"}'
    for name, text, lines in (("docs", '{"anomalias": [' + good + ', {"odt": 3}]}', False), ("lines", good + '\n{"odt": 3}\n', True)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.json").write_text(text)
        (folder / "b.json").write_text('{"odt": 4')
        rec = api_json.read_records(spark, str(folder), json_lines=lines)
        ok, bad = api_json.validate(rec, 2024, "2024-05-06 07:08:09")
        assert [(r.odt, r.orden, r.LATI_USU) for r in ok.collect()] == [(1, 2, 1.5)]
        assert sorted((r.reason, r.record) for r in bad.collect()) == [("missing required field", '{"odt": 3}'),
                                                                       ("not JSON", '{"odt": 4')]
        for part in (ok, bad):
            plan = part._jdf.queryExecution().optimizedPlan().toString().lower()
            assert "parse" in plan and not any("filter" in line and "parse" in line for line in plan.splitlines())

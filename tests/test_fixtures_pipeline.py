"""The tiny fixtures of FIXTURES.md: EAV widening, anomalies cleaning, dataset build."""

import datetime as dt

from pyspark.sql import functions as F

from voltlens.functions.casts import nullable_long
from voltlens.functions.scalars import explode_codes, year_of
from voltlens.operators import dedupe, eav
from voltlens.plans import pipelines as P

PLAIN = [(10, 1, "PACIFICO"), (10, 288, "501"), (10, 288, "999"), (11, 1, "CENTRO"), (12, 1, "SUR"),
         (12, 288, "abc"), (10, 237, "TRUE"), (10, 33, None), (10, 33, "7.5"), (10, 43, "12.0")]


def plain(spark):
    rows = [(o, i, v, n) for n, (o, i, v) in enumerate(PLAIN)]
    return spark.createDataFrame(rows, "odt long, id int, value string, _ord long")


def test_widen_keeps_first_value_and_null_column(spark):
    w = eav.widen(plain(spark), [288, 33, 43, 237, 999]).orderBy("odt").collect()
    r10 = w[0].asDict()
    assert r10["item_288"] == "501"          # duplicate ignored (keep first)
    assert r10["item_33"] is None            # a NULL first value stays NULL
    assert r10["item_43"] == "12.0"
    assert r10["item_999"] is None           # id without data -> NULL column


def test_lookup_drops_non_numeric_and_missing(spark):
    p = plain(spark)
    zones = p.where(F.col("id") == 1).select("odt")
    z = eav.lookup_join(zones, p, 288, "item_288")
    z = z.withColumn("item_288", nullable_long("item_288")).where(F.col("item_288").isNotNull())
    assert [(r.odt, r.item_288) for r in z.collect()] == [(10, 501)]


def test_decimal_text_to_long(spark):
    df = spark.createDataFrame([("12.0",), ("12.5",), ("abc",), (None,), (" 7 ",)], "v string")
    assert [r.x for r in df.select(nullable_long("v").alias("x")).collect()] == [12, None, None, None, 7]


def test_codes_split_trim_and_null(spark):
    df = spark.createDataFrame([(1, "A1/ B2"), (3, None), (4, "C/")], "Orden long, Codigo string")
    out = sorted((r.Orden, r.c) for r in df.select("Orden", explode_codes("Codigo").alias("c")).collect())
    assert out == [(1, "A1"), (1, "B2"), (3, None), (4, ""), (4, "C")]


def test_unrevised_duplicates_and_year(spark):
    rows = [(1, "x", "2022-03-01"), (2, None, "2022-05-02"), (2, "r", "2022-05-02"), (3, None, "2022 sin fecha"),
            (4, "r", "31-31-2022"), (5, "r", "2023-01-01")]
    df = spark.createDataFrame(rows, "Orden long, Revision string, Ejecucion string")
    kept = dedupe.drop_unrevised_duplicates(df, "Orden", "Revision")
    assert sorted((r.Orden, r.Revision) for r in kept.collect()) == [
        (1, "x"), (2, "r"), (3, None), (4, "r"), (5, "r")]
    years = {r.Orden: r.y for r in df.select("Orden", year_of("Ejecucion").alias("y")).distinct().collect()}
    assert years == {1: 2022, 2: 2022, 3: 2022, 4: 2022, 5: 2023}


def test_clean_flags_defaults_and_labels(spark):
    rows = [(1, 10, 501, 1.0, "Solo odt", "TRUE", None, None),
            (1, 10, 501, 1.0, "x", "FALSE", "TRUE", "a"),     # duplicate (orden, odt): first kept
            (2, 11, 501, None, "y", None, None, None),        # NULL coordinate: dropped
            (3, 12, 777, 2.0, None, "maybe", "FALSE", None)]
    df = spark.createDataFrame(rows, "orden long, odt long, item_288 long, LATI_USU double, Descripcion string, "
                                     "item_237 string, item_23 string, item_33 string")
    df = df.withColumn("_ord", F.monotonically_increasing_id())
    out = {r.orden: r.asDict() for r in P.clean(df, order_col="_ord").collect()}
    assert set(out) == {1, 3}
    assert out[1]["item_237"] is True and out[3]["item_237"] is False    # unknown text -> NULL -> false
    assert out[1]["item_23"] == "NO" and out[3]["item_23"] == "NO"       # NULL -> NO, FALSE -> NO
    assert out[1]["item_33"] == "NO INDICA"
    assert out[1]["Anomalia_conf"] == "No anomalia"
    assert out[3]["Anomalia_conf"] == "No anomalia"                      # NULL filled with 'Solo odt' (D3)
    assert out[1]["reincidente"] == "NO" and out[3]["reincidente"] == "NO"


def test_merge_and_clean_small(spark):
    an = spark.createDataFrame(
        [(1, 100, dt.date(2022, 3, 1), "A1/ B2", "fraude", "m", 1.0), (2, 200, dt.date(2022, 5, 2), "A1", "x", "m", 2.0)],
        "Orden long, Usuario long, Ejecucion date, Codigo string, Descripcion string, Motivo string, kWh_Rec double")
    sev = spark.createDataFrame([("A1", 1.0, "n1", 3), ("B2", 2.0, "n2", 5)],
                                "Item string, id double, Nombre string, puntaje int")
    cols = P.USER_COLS
    u = spark.createDataFrame([(100, 100, "U", "P", "T1", 1.0, 1.0, "C", "S", "Z1", 1.0, 2.0, 1.0, 2.0),
                               (200, 200, "U", "P", "T1", 1.0, 1.0, "C", "S", None, 1.0, 2.0, 1.0, 2.0)],
                              ", ".join(f"{c} {'long' if c in ('CLIENTE', 'PRODUCTO') else 'double' if c in ('FASES', 'KVA', 'LATI_USU', 'LONG_USU', 'LATI_TRAFO', 'LONG_TRAFO') else 'string'}" for c in cols))
    out = P.merge_and_clean(an, u, sev).collect()
    assert sorted((r.Orden, r.Codigo, r.puntaje) for r in out) == [(1, "A1", 3), (1, "B2", 5)]


def test_process_data_fixture(spark):
    """FIXTURES sections 1-4: zone row without customer number dropped, non-numeric number dropped,
    uid with two orden fans out, anomalies of the year joined, items widened and typed."""
    p = plain(spark)
    users = spark.createDataFrame([(501, "U", "P1", 1.0, 1.2, -77.0, "PACIFICO")],
                                  "PRODUCTO long, AREA string, PLAN_COMERCIAL string, NIVEL double, "
                                  "LATI_USU double, LONG_USU double, ZONA string")
    uid = spark.createDataFrame([(10, 1000), (10, 1001), (None, 5)], "uid long, orden long")
    an = spark.createDataFrame([(1000, "fraude", "r", dt.date(2022, 3, 1)), (1001, "x", "r", dt.date(2023, 1, 1))],
                               "Orden long, Descripcion string, Revision string, Ejecucion date")
    out = P.process_data(an, users, p, uid, target_year=2022, item_ids=[33, 43, 237],
                         item_types={"item_43": "double", "item_237": "bool"}).orderBy("orden").collect()
    assert [(r.odt, r.orden, r.item_288, r.Descripcion) for r in out] == [(10, 1000, 501, "fraude"),
                                                                          (10, 1001, 501, None)]
    assert out[0].item_43 == 12.0 and out[0].item_237 is True and out[0].item_33 is None
    assert out[0]["año"] == 2022


def test_salted_group_sizes_equal_plain(spark):
    df = spark.createDataFrame([(1 if i % 3 else None, i) for i in range(300)], "k long, v long")
    a = sorted((r.v, r.k, r._vl_n) for r in dedupe.group_sizes(df, ["k"]).collect())
    b = sorted((r.v, r.k, r._vl_n) for r in dedupe.group_sizes(df, ["k"], salt=7).collect())
    assert a == b and {r[2] for r in a} == {100, 200}


def test_declared_items_are_the_default(spark):
    """Without a map, process_data widens the 47 declared items with their declared types."""
    from voltlens.plans import pipelines as P

    assert len(P.ITEM_TYPES) == 47
    plain = spark.createDataFrame([(10, 1, "PACIFICO", 0), (10, 288, "501", 1), (10, 33, "7.5", 2), (10, 237, "TRUE", 3),
                                   (10, 33, "9", 4)], "odt long, id int, value string, _ord long")
    users = spark.createDataFrame([(501, "U", "P", 1.0, 1.5, -77.0, "Z")], "PRODUCTO long, AREA string, PLAN_COMERCIAL string, "
                                  "NIVEL double, LATI_USU double, LONG_USU double, ZONA string")
    uid = spark.createDataFrame([(10, 99)], "uid long, orden long")
    an = spark.createDataFrame([(99, "x", 2023)], "Orden long, Descripcion string, `año` long")
    out = P.process_data(an, users, plain, uid, 2023)
    types = dict(out.dtypes)
    assert all(types[f"item_{i}"] == t for i, t in P.ITEM_TYPES.items())
    row = out.first()
    assert row["item_33"] == 7.5 and row["item_237"] == "TRUE" and row["item_1442"] is None


def test_null_keys_on_both_sides_are_refused(spark):
    import pytest

    from voltlens.operators.joins import join_renamed

    a = spark.createDataFrame([(None,), (None,), (1,)], "a long")
    b = spark.createDataFrame([(None, "x"), (1, "y")], "b long, v string")
    out = join_renamed(a, b, "a", "b", "left", null_keys_match=True)
    assert sorted(r.v for r in out.collect()) == ["x", "x", "y"]
    with pytest.raises(ValueError):
        join_renamed(a, b.union(b), "a", "b", "left", null_keys_match=True)


def _dataset_sides(spark):
    an = spark.createDataFrame(
        [(1, 100, dt.date(2022, 3, 1), "A1/ A1", "f", "m", 1.0), (1, 100, dt.date(2022, 3, 1), "A1", "f", "m", 1.0),
         (2, None, None, "B2", None, None, None), (2, None, None, "B2", None, None, None),
         (3, 300, None, None, None, None, -0.0), (3, 300, None, None, None, None, 0.0)],
        "Orden long, Usuario long, Ejecucion date, Codigo string, Descripcion string, Motivo string, kWh_Rec double")
    sev = spark.createDataFrame([("A1", 1.0, "n1", 3), ("A1", 1.0, "n1", 3), ("A1", 2.0, "n2", 5), (None, 9.0, "n", 1)],
                                "Item string, id double, Nombre string, puntaje int")
    num = ("FASES", "KVA", "LATI_USU", "LONG_USU", "LATI_TRAFO", "LONG_TRAFO")
    u = [(7, 100, "U", None, "T", 1.0, 1.0, "C", "S", "Z", 1.0, 2.0, 1.0, 2.0)]
    u += [(8, *u[0][1:]), u[0], (9, 300, *u[0][2:]), (5, 500, *u[0][2:]), (5, 500, *u[0][2:]), (4, None, *u[0][2:])]
    users = spark.createDataFrame(u, ", ".join(
        f"{c} {'long' if c in ('CLIENTE', 'PRODUCTO') else 'double' if c in num else 'string'}" for c in P.USER_COLS))
    return an, users, sev


def test_datasets_are_distinct_without_a_wide_distinct(spark):
    """Repeats in every side, equal codes of one order and -0.0: the joins of the distinct sides are the distinct joins."""
    from collections import Counter

    from voltlens.operators import joins
    an, users, sev = _dataset_sides(spark)
    for build, how, cols in ((P.merge_and_clean, "left", P.TRAIN_COLS), (P.inference_dataset, "right", None)):
        out = build(an, users, sev)
        a = P.with_severity(P.expand_codes(an), sev)
        j = joins.join_renamed(a, users, "Usuario", "PRODUCTO", how, drop_right_key=False)
        want = j.select(*(cols or j.columns)).distinct().na.drop(subset=["ZONA"])
        assert out.columns == want.columns
        assert Counter(map(str, out.collect())) == Counter(map(str, want.collect()))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("Aggregate")  # below the joins, on the narrow sides


def test_distinct_spread_deals_rows_before_it_combines_them(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None)], "k long, v string")
    out = dedupe.distinct_spread(df)
    assert sorted(map(str, out.collect())) == ["Row(k=1, v='a')", "Row(k=None, v=None)"]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.rindex("HashAggregate") < plan.index("Exchange")


def test_unrevised_duplicates_move_missing_rows_only(spark):
    rows = [(1, "r", 1), (1, None, 2), (2, None, 3), (3, "nan", 4), (3, "NaN", 5), (4, "r", 6), (4, "r", 7),
            (None, None, 8), (None, "r", 9), (5, "r", 10)]
    df = spark.createDataFrame(rows, "Orden long, Revision string, v long")
    out = dedupe.drop_unrevised_duplicates(df)
    assert sorted(r.v for r in out.collect()) == [1, 3, 6, 7, 9, 10] and out.columns == df.columns
    one = spark.createDataFrame([(None, None, 1)], df.schema)
    assert dedupe.drop_unrevised_duplicates(one).count() == 1  # a single NULL key is no duplicate
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftSemi" in plan and "LeftOuter" not in plan

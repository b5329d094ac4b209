"""Catalog entries: cleaning (C2), duplicates, profiles, projections, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltlens.functions import scalars as S
from voltlens.functions import schema as SC
from voltlens.operators import dedupe as D
from voltlens.operators import profile as PR
from voltlens.plans import analogues as A
from voltlens.plans import pipelines as P
from voltlens.plans.analogues import with_views as V
from voltlens.plans.catalog import register
from voltlens.plans.q_core import _C1_SQL, c1_process_data

# ----------------------------------------------------------------------------- C2

def _c2_derived_spark():
    return {
        "item_237": F.when(F.col("item_4") % 4 == 0, "TRUE").when(F.col("item_4") % 4 == 1, "no")
                     .when(F.col("item_4") % 4 == 2, "x"),
        "item_74": F.when(F.col("item_4") > 25, F.lit("SI")),
        "item_68": F.col("item_99"),
        "item_33": F.when(F.col("item_4") % 3 != 0, F.col("item_5")),
        "item_601": F.when(F.col("item_4") % 2 == 0, F.lit("A")),
        "item_23": F.when(F.col("item_4") % 3 == 0, "TRUE").when(F.col("item_4") % 3 == 1, "FALSE"),
        "item_24": F.when(F.col("item_4") % 5 == 0, F.lit("TRUE")),
    }
_C2_DERIVED_SQL = """
  CASE WHEN item_4 % 4 = 0 THEN 'TRUE' WHEN item_4 % 4 = 1 THEN 'no' WHEN item_4 % 4 = 2 THEN 'x' END AS item_237,
  CASE WHEN item_4 > 25 THEN 'SI' END AS item_74, item_99 AS item_68,
  CASE WHEN item_4 % 3 <> 0 THEN item_5 END AS item_33, CASE WHEN item_4 % 2 = 0 THEN 'A' END AS item_601,
  CASE WHEN item_4 % 3 = 0 THEN 'TRUE' WHEN item_4 % 3 = 1 THEN 'FALSE' END AS item_23,
  CASE WHEN item_4 % 5 = 0 THEN 'TRUE' END AS item_24"""
_C1_OUT = ["item_288", "PLAN_COMERCIAL", "NIVEL", "LATI_USU", "LONG_USU", "AREA", "ZONA", "Descripcion", "odt",
           "orden", "item_3", "item_4", "item_5", "item_6", "item_7", "item_99", "año"]
_C2_SRC = _C1_OUT + ["item_237", "item_74", "item_68", "item_33", "item_601", "item_23", "item_24"]
# columns of the cleaned output in this analogue (the rest of the sink schema is absent)
CLEAN_KEEP_PRESENT = ["AREA", "item_288", "odt", "orden", "PLAN_COMERCIAL", "Descripcion", "reincidente",
                      "Anomalia_conf", "ZONA", "año", "LATI_USU", "LONG_USU", "NIVEL", "item_68", "item_74",
                      "item_237", "item_33", "item_601", "item_24", "item_23"]


def _bool_sql(x):
    return (f"COALESCE(CASE WHEN upper(trim({x})) IN ('TRUE','SI') THEN true "
            f"WHEN upper(trim({x})) IN ('FALSE','NO') THEN false END, false) AS {x}")


_C2_SQL = f"""
WITH c1 AS ({_C1_SQL.strip()}),
src AS (SELECT *, {_C2_DERIVED_SQL} FROM c1),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY orden, odt ORDER BY
        {', '.join(f'"{c}" NULLS FIRST' for c in _C2_SRC if c not in ('orden', 'odt'))}) AS rn FROM src)
      WHERE rn = 1 AND "LATI_USU" IS NOT NULL AND NOT isnan("LATI_USU")),
t AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY item_288) > 1 THEN 'SI' ELSE 'NO' END AS reincidente FROM k)
SELECT "AREA", item_288, odt, orden, "PLAN_COMERCIAL", "Descripcion", reincidente,
       CASE WHEN COALESCE("Descripcion", 'Solo odt') = 'Solo odt' THEN 'No anomalia' ELSE 'Anomalia' END
         AS "Anomalia_conf",
       "ZONA", "año", "LATI_USU", "LONG_USU", "NIVEL", {_bool_sql('item_68')}, {_bool_sql('item_74')},
       {_bool_sql('item_237')}, COALESCE(CAST(item_33 AS VARCHAR), 'NO INDICA') AS item_33,
       COALESCE(CAST(item_601 AS VARCHAR), 'NOAPL') AS item_601,
       CASE WHEN item_24 IS NULL THEN 'NO' WHEN item_24 = 'TRUE' THEN 'SI' WHEN item_24 = 'FALSE' THEN 'NO'
            ELSE item_24 END AS item_24,
       CASE WHEN item_23 IS NULL THEN 'NO' WHEN item_23 = 'TRUE' THEN 'SI' WHEN item_23 = 'FALSE' THEN 'NO'
            ELSE item_23 END AS item_23
FROM t
"""


def c2_input(spark, sf_dir):
    """The yearly dataset with the zone rows' ingest ordinal."""
    built = c1_process_data(spark, sf_dir, keep_order=True)
    return built.withColumns(_c2_derived_spark()).select(*[SC.q(c) for c in _C2_SRC], "_ord")


@register("c2_clean", V(_C2_SQL, "anomalies", "users", "plain", "uid_conversion"))
def c2_clean(spark, sf_dir):
    return P.clean(c2_input(spark, sf_dir), order_col="_ord")


# ----------------------------------------------------------------------------- duplicates

@register("a1_distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def a1_distinct_rows(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return D.distinct_rows(li)


@register("a2_keep_first", V("""
SELECT odt, id, value FROM (SELECT odt, id, value, row_number() OVER (PARTITION BY odt, id ORDER BY ord) AS rn
                            FROM plain) WHERE rn = 1""", "plain"))
def a2_keep_first(spark, sf_dir):
    return D.keep_first(A.plain(spark, sf_dir), ["odt", "id"], "_ord", keep_order=False)


@register("a3_duplicate_count", """
SELECT CAST(COALESCE(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows,
       CAST(COALESCE(sum(CASE WHEN n > 1 THEN 1 END), 0) AS BIGINT) AS duplicate_groups
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def a3_duplicate_count(spark, sf_dir):
    return D.duplicate_count(A.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("w1_duplicated_flag", """
SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_dup
FROM lineitem""")
def w1_duplicated_flag(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return D.duplicated_flag(li, ["l_orderkey", "l_linenumber"])


@register("w2_recurrence_flag", """
SELECT o_orderkey, o_custkey AS item_288,
       CASE WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN 'SI' ELSE 'NO' END AS reincidente
FROM (SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders)""")
def w2_recurrence_flag(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("long"))
                       .otherwise(F.col("o_custkey")).alias("item_288"))
    return D.recurrence_flag(o, "item_288")


@register("p12_unrevised_duplicates", """
SELECT "Orden", l_linenumber, "Revision" FROM (
  SELECT l_orderkey AS "Orden", l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS "Revision",
         count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
WHERE NOT (n > 1 AND ("Revision" IS NULL OR lower("Revision") = 'nan'))""")
def p12_unrevised_duplicates(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("Orden"), "l_linenumber",
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string")).otherwise(F.col("l_returnflag"))
         .alias("Revision"))
    return D.drop_unrevised_duplicates(li, "Orden", "Revision")


# ----------------------------------------------------------------------------- null handling

@register("p10_drop_nulls", V('SELECT * FROM users WHERE "ZONA" IS NOT NULL AND "LATI_USU" IS NOT NULL', "users"))
def p10_drop_nulls(spark, sf_dir):
    return PR.drop_nulls(A.users(spark, sf_dir), ["ZONA", "LATI_USU"])


@register("p11_any_null_flag", V('''
SELECT "CLIENTE", ("ZONA" IS NULL OR "LATI_USU" IS NULL OR "AREA" IS NULL) AS rejected FROM users''', "users"))
def p11_any_null_flag(spark, sf_dir):
    u = A.users(spark, sf_dir)
    return u.select("CLIENTE", PR.any_null(["ZONA", "LATI_USU", "AREA"]).alias("rejected"))


_USER_COLS = ["CLIENTE", "AREA", "ZONA", "LATI_USU", "LONG_USU"]


@register("a4_null_counts", V(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
        CAST(count(*) AS BIGINT) AS total,
        round(sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS null_pct FROM users"""
    for c in _USER_COLS), "users"))
def a4_null_counts(spark, sf_dir):
    return PR.null_counts(A.users(spark, sf_dir), _USER_COLS)


@register("a5_value_counts", """
SELECT o_orderstatus, o_orderpriority AS value, CAST(count(*) AS BIGINT) AS count,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY o_orderstatus), 2) AS pct
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def a5_value_counts(spark, sf_dir):
    return PR.value_counts(A.read(spark, sf_dir, "orders"), "o_orderpriority", by="o_orderstatus")


@register("a5_value_counts_total", """
SELECT l_returnflag AS value, CAST(count(*) AS BIGINT) AS count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM lineitem GROUP BY l_returnflag""")
def a5_value_counts_total(spark, sf_dir):
    return PR.value_counts(A.read(spark, sf_dir, "lineitem"), "l_returnflag")


@register("a9_distinct_count", """
SELECT l_returnflag, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_distinct FROM lineitem GROUP BY l_returnflag""")
def a9_distinct_count(spark, sf_dir):
    return PR.distinct_count(A.read(spark, sf_dir, "lineitem"), "l_partkey", by="l_returnflag")


@register("a9_distinct_values", "SELECT DISTINCT c_mktsegment AS value FROM customer")
def a9_distinct_values(spark, sf_dir):
    return PR.distinct_values(A.read(spark, sf_dir, "customer"), "c_mktsegment")


_PROF_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("a10_numeric_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n,
        CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls, min({c}) AS min,
        quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3,
        max({c}) AS max, avg({c}) AS mean FROM lineitem""" for c in _PROF_COLS))
def a10_numeric_profile(spark, sf_dir):
    return PR.numeric_profile(A.read(spark, sf_dir, "lineitem"), _PROF_COLS)


_TEXT_COLS = ["AREA", "PLAN_COMERCIAL", "ZONA"]


@register("a10_text_profile", V(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count("{c}") AS BIGINT) AS n,
        CAST(sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
        CAST(count(DISTINCT "{c}") AS BIGINT) AS n_distinct,
        (SELECT "{c}" FROM users WHERE "{c}" IS NOT NULL GROUP BY "{c}" ORDER BY count(*) DESC, "{c}" LIMIT 1) AS mode,
        (SELECT CAST(count(*) AS BIGINT) FROM users WHERE "{c}" IS NOT NULL GROUP BY "{c}" ORDER BY count(*) DESC LIMIT 1)
          AS mode_count FROM users""" for c in _TEXT_COLS), "users"))
def a10_text_profile(spark, sf_dir):
    return PR.text_profile(A.users(spark, sf_dir), _TEXT_COLS)


@register("a12_cleaning_report", V("""
SELECT CAST(b AS BIGINT) AS rows_before, CAST(a AS BIGINT) AS rows_after, CAST(15 AS BIGINT) AS cols_before,
       CAST(5 AS BIGINT) AS cols_after, CAST(b - a AS BIGINT) AS rows_reduction,
       COALESCE(round((b - a) * 100.0 / b, 2), 0.0) AS rows_reduction_pct, CAST(10 AS BIGINT) AS cols_reduction,
       round(10 * 100.0 / 15, 2) AS cols_reduction_pct
FROM (SELECT count(*) AS b, count(*) FILTER (WHERE "ZONA" IS NOT NULL AND "LATI_USU" IS NOT NULL) AS a FROM users)""",
                                       "users"))
def a12_cleaning_report(spark, sf_dir):
    u = A.users(spark, sf_dir)
    after = PR.drop_nulls(u, ["ZONA", "LATI_USU"]).select("CLIENTE", "AREA", "ZONA", "LATI_USU", "LONG_USU")
    return PR.cleaning_report(u, after)


@register("a11_processed_report", """
WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
                  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer),
m AS (SELECT count(*) AS rows, count(*) FILTER (WHERE c_mktsegment IS NULL) + count(*) FILTER (WHERE c_acctbal IS NULL)
             AS missing FROM t)
SELECT 'rows' AS section, NULL::VARCHAR AS name, NULL::VARCHAR AS value, rows::DOUBLE AS n FROM m
UNION ALL SELECT 'columns', NULL, NULL, 3 UNION ALL SELECT 'missing_values', NULL, NULL, missing FROM m
UNION ALL SELECT 'missing_percentage', NULL, NULL, round(missing * 100.0 / (rows * 3), 2) FROM m
UNION ALL SELECT 'data_types', 'bigint', 'c_custkey', 1 UNION ALL SELECT 'data_types', 'double', 'c_acctbal', 1
UNION ALL SELECT 'data_types', 'string', 'c_mktsegment', 1 UNION ALL SELECT 'item_columns_count', NULL, NULL, 47""")
def a11_processed_report(spark, sf_dir):
    """Processed statistics: NaN and NULL count as missing, 47 declared items."""
    k = F.col("c_custkey")
    t = A.read(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(k % 10 == 0, F.lit(float("nan"))).when(k % 5 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    return PR.processed_report(t, len(P.ITEM_TYPES))


@register("a12_cleaning_details", """
WITH b AS (SELECT c_custkey, c_nationkey AS orden, CAST(c_custkey % 9 AS BIGINT) AS odt,
                  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
a AS (SELECT c_custkey, seg FROM b WHERE seg IS NOT NULL),
d AS (SELECT sum(n) AS n FROM (SELECT count(*) AS n FROM b GROUP BY orden, odt HAVING count(*) > 1))
SELECT 'missing_before' AS section, 'seg' AS name, NULL::VARCHAR AS value, (SELECT count(*) FROM b WHERE seg IS NULL)::DOUBLE AS n
UNION ALL SELECT 'missing_before', unnest(['c_custkey', 'orden', 'odt']), NULL, 0
UNION ALL SELECT 'type_before', unnest(['c_custkey', 'orden', 'odt']), 'bigint', NULL
UNION ALL SELECT 'type_before', 'seg', 'string', NULL
UNION ALL SELECT 'missing_after', unnest(['c_custkey', 'seg']), NULL, 0
UNION ALL SELECT 'type_after', 'c_custkey', 'bigint', NULL UNION ALL SELECT 'type_after', 'seg', 'string', NULL
UNION ALL SELECT 'duplicates_before', 'orden_odt', NULL, COALESCE(n, 0) FROM d
UNION ALL SELECT 'frequency_after', 'seg', seg, count(*) FROM a GROUP BY seg""")
def a12_cleaning_details(spark, sf_dir):
    """The parts of the cleaning report beside the shapes."""
    b = A.read(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("long").alias("orden"), (F.col("c_custkey") % 9).cast("long").alias("odt"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"))
    return PR.cleaning_details(b, PR.drop_nulls(b, "seg").select("c_custkey", "seg"))


@register("a13_class_balance", V("""
SELECT "Motivo", CAST(sum(CASE WHEN lbl = 'Anomalia' THEN 1 ELSE 0 END) AS BIGINT) AS positive,
       CAST(sum(CASE WHEN lbl = 'Anomalia' THEN 0 ELSE 1 END) AS BIGINT) AS negative, CAST(count(*) AS BIGINT) AS total,
       round(sum(CASE WHEN lbl = 'Anomalia' THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS positive_pct
FROM (SELECT "Motivo", CASE WHEN "Descripcion" = 'Solo odt' THEN 'No anomalia' ELSE 'Anomalia' END AS lbl
      FROM anomalies) GROUP BY "Motivo" """, "anomalies"))
def a13_class_balance(spark, sf_dir):
    a = A.anomalies(spark, sf_dir).withColumn("lbl", S.anomaly_label("Descripcion"))
    return PR.class_balance(a, "lbl", "Anomalia", by="Motivo")


@register("a14_quantile", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, quantile_cont(o_totalprice, 0.95) AS q_0_95,
       quantile_cont(o_totalprice, 0.5) AS q_0_5 FROM orders GROUP BY o_orderstatus""")
def a14_quantile(spark, sf_dir):
    return PR.exact_quantiles(A.read(spark, sf_dir, "orders"), "o_totalprice", [0.95, 0.5], by="o_orderstatus")


@register("p14_percentile_filter", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.95) FROM orders)""")
def p14_percentile_filter(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return PR.percentile_filter(o, "o_totalprice", 0.95)


@register("a15_zone_stats", V("""
WITH m AS (SELECT "ZONA", avg("LATI_USU") AS "LATI_USU", avg("LONG_USU") AS "LONG_USU" FROM users GROUP BY "ZONA"),
c AS (SELECT "ZONA", "AREA", count(*) AS n FROM users WHERE "AREA" IS NOT NULL GROUP BY "ZONA", "AREA"),
md AS (SELECT "ZONA", "AREA" FROM (SELECT *, row_number() OVER (PARTITION BY "ZONA" ORDER BY n DESC, "AREA") AS rn
                                   FROM c) WHERE rn = 1)
SELECT m.*, md."AREA" FROM m LEFT JOIN md ON m."ZONA" IS NOT DISTINCT FROM md."ZONA" """, "users"))
def a15_zone_stats(spark, sf_dir):
    u = A.users(spark, sf_dir)
    means = PR.mean_of(u, ["LATI_USU", "LONG_USU"], by="ZONA")
    mode = PR.mode_of(u, "AREA", by="ZONA")
    return means.join(mode, on=means["ZONA"].eqNullSafe(mode["ZONA"]), how="left").drop(mode["ZONA"])


@register("w3_first_row_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def w3_first_row_per_key(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    # day and order number as one BIGINT that no two orders share
    o = o.withColumn("_ord", F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * (1 << 40) + F.col("o_orderkey"))
    return D.keep_first(o, ["o_custkey"], "_ord", keep_order=False)

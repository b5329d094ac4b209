"""Catalog entries: scalar functions, projections, filters, limits, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlens.functions import casts as C
from voltlens.functions import scalars as S
from voltlens.functions import schema as SC
from voltlens.operators import sampling as L
from voltlens.plans import analogues as A
from voltlens.plans import pipelines as P
from voltlens.plans.analogues import with_views as V
from voltlens.plans.catalog import register

# ----------------------------------------------------------------------------- F1-F3


@register("f2_explode_codes", V('SELECT "Orden", "Codigo_x" AS "Codigo" FROM codes_x', "codes_x"))
def f2_explode_codes(spark, sf_dir):
    return P.expand_codes(A.anomalies(spark, sf_dir).select("Orden", "Codigo"))


@register("f3_trim_upper", "SELECT c_custkey, upper(trim(' ' || lower(c_mktsegment) || ' ')) AS seg FROM customer")
def f3_trim_upper(spark, sf_dir):
    c = A.read(spark, sf_dir, "customer")
    return c.select("c_custkey", S.trim_upper(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))).alias("seg"))


_TOKENS_SQL = """
SELECT o_orderkey,
  CASE o_orderkey % 4 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN '<NA>' ELSE o_orderpriority END AS raw
FROM orders"""


def _tokens(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, "nan").when(k == 1, "None").when(k == 2, "<NA>").otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", raw.alias("raw"))


@register("f4_missing_text", f"""
SELECT o_orderkey, (raw IS NULL OR lower(raw) = 'nan') AS missing FROM ({_TOKENS_SQL})""")
def f4_missing_text(spark, sf_dir):
    return _tokens(spark, sf_dir).select("o_orderkey", S.is_missing_text("raw").alias("missing"))


@register("f8_null_tokens", f"""
SELECT o_orderkey, CASE WHEN raw IN ('nan', '<NA>', 'None') THEN NULL ELSE raw END AS clean FROM ({_TOKENS_SQL})""")
def f8_null_tokens(spark, sf_dir):
    return _tokens(spark, sf_dir).select("o_orderkey", C.null_tokens_to_null("raw").alias("clean"))


_NUMTXT_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN CAST(l_quantity AS VARCHAR) WHEN 2 THEN CAST(l_discount AS VARCHAR)
       WHEN 3 THEN 'abc' WHEN 4 THEN ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' '
       WHEN 5 THEN NULL ELSE CAST(l_tax AS VARCHAR) END AS raw
FROM lineitem"""


def _numtxt(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    raw = (F.when(n == 1, F.col("l_quantity").cast("string")).when(n == 2, F.col("l_discount").cast("string"))
            .when(n == 3, F.lit("abc"))
            .when(n == 4, F.concat(F.lit(" "), F.col("l_quantity").cast("long").cast("string"), F.lit(" ")))
            .when(n == 5, F.lit(None).cast("string")).otherwise(F.col("l_tax").cast("string")))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw"))


@register("f9_lenient_double", f"""
SELECT l_orderkey, l_linenumber, TRY_CAST(trim(raw) AS DOUBLE) AS num FROM ({_NUMTXT_SQL})""")
def f9_lenient_double(spark, sf_dir):
    return _numtxt(spark, sf_dir).select("l_orderkey", "l_linenumber", C.lenient_double("raw").alias("num"))


@register("f10_nullable_long", f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN TRY_CAST(trim(raw) AS DOUBLE) = floor(TRY_CAST(trim(raw) AS DOUBLE))
       THEN CAST(TRY_CAST(trim(raw) AS DOUBLE) AS BIGINT) END AS num,
  COALESCE(TRY_CAST(trim(raw) AS DOUBLE) <> floor(TRY_CAST(trim(raw) AS DOUBLE)), false) AS fractional
FROM ({_NUMTXT_SQL})""")
def f10_nullable_long(spark, sf_dir):
    t = _numtxt(spark, sf_dir)
    return t.select("l_orderkey", "l_linenumber", C.nullable_long("raw").alias("num"),
                    C.is_fractional("raw").alias("fractional"))


_TYPES = {"l_quantity": "long", "l_discount": "string", "l_returnflag": "bool", "l_shipdate": "date"}


@register("f11_type_map", """
SELECT l_orderkey,
  CASE WHEN l_quantity = floor(l_quantity) THEN CAST(l_quantity AS BIGINT) END AS l_quantity,
  CAST(l_discount AS VARCHAR) AS l_discount,
  CASE WHEN l_returnflag IN ('A', 'N') THEN NULL END::BOOLEAN AS l_returnflag,
  CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem""")
def f11_type_map(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_returnflag",
                                                  "l_shipdate")
    return C.apply_type_map(li, _TYPES)


@register("f12_text_cast", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust_txt FROM orders")
def f12_text_cast(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").select("o_orderkey", C.text("o_custkey").alias("cust_txt"))


_DATETXT_SQL = """
SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
    WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 2 THEN 'sin fecha ' || CAST(year(o_orderdate) AS VARCHAR)
    ELSE '31-31-' || CAST(year(o_orderdate) AS VARCHAR) END AS raw
FROM orders"""


def _datetxt(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 4
    y = F.year("o_orderdate").cast("string")
    raw = (F.when(k == 0, F.col("o_orderdate").cast("date").cast("string"))
            .when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
            .when(k == 2, F.concat(F.lit("sin fecha "), y))
            .otherwise(F.concat(F.lit("31-31-"), y)))
    return o.select("o_orderkey", raw.alias("raw"))


@register("f13_text_to_date", f"""
SELECT o_orderkey, COALESCE(TRY_CAST(raw AS DATE), CAST(try_strptime(raw, '%d/%m/%Y') AS DATE),
                            CAST(try_strptime(raw, '%Y/%m/%d') AS DATE)) AS fecha
FROM ({_DATETXT_SQL})""")
def f13_text_to_date(spark, sf_dir):
    return _datetxt(spark, sf_dir).select("o_orderkey", C.text_to_date("raw").alias("fecha"))


@register("f14_year_extract", f"""
SELECT o_orderkey, CAST(COALESCE(year(TRY_CAST(raw AS DATE)), TRY_CAST(regexp_extract(raw, '(\\d{{4}})', 1) AS INTEGER))
                        AS BIGINT) AS "año"
FROM ({_DATETXT_SQL})""")
def f14_year_extract(spark, sf_dir):
    return _datetxt(spark, sf_dir).select("o_orderkey", S.year_of("raw").alias("año"))


@register("f5_replace_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OPEN' ELSE o_orderstatus END AS status
FROM orders""")
def f5_replace_values(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.replace_values("o_orderstatus", {"F": "FINAL", "O": "OPEN"}).alias("status"))


@register("f6_fill_default", V("""
SELECT "CLIENTE", COALESCE("ZONA", 'NO INDICA') AS "ZONA", COALESCE(CAST("LATI_USU" AS VARCHAR), 'NOAPL') AS lat_txt,
       COALESCE("LATI_USU", 0.0) AS lat
FROM users""", "users"))
def f6_fill_default(spark, sf_dir):
    u = A.users(spark, sf_dir)
    return u.select("CLIENTE", S.fill_default("ZONA", "NO INDICA").alias("ZONA"),
                    S.fill_default("LATI_USU", "NOAPL").alias("lat_txt"),
                    S.fill_default("LATI_USU", 0.0).alias("lat"))


@register("f6_fill_default_nan", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey % 3 = 0 OR l_orderkey % 5 = 0 THEN 0.0 ELSE l_quantity END AS num,
       CASE WHEN l_orderkey % 3 = 0 OR l_orderkey % 5 = 0 THEN 'NO INDICA' ELSE 'x' END AS txt
FROM lineitem""")
def f6_fill_default_nan(spark, sf_dir):
    """NaN counts as missing, like NULL, for a number and for a text default."""
    k = F.col("l_orderkey")
    q = (F.when(k % 3 == 0, F.lit(float("nan"))).when(k % 5 == 0, F.lit(None).cast("double"))
          .otherwise(F.col("l_quantity").cast("double")))
    txt = S.fill_default(q, "NO INDICA")
    return A.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", S.fill_default(q, 0.0).alias("num"),
        F.when(txt == "NO INDICA", txt).otherwise("x").alias("txt"))


@register("f10_large_ids", """
SELECT o_orderkey, CAST(9007199254740992 + o_orderkey AS BIGINT) AS from_text,
       CAST(9007199254740992 + o_orderkey AS BIGINT) AS from_decimal_text,
       CAST(9007199254740992 + o_orderkey AS BIGINT) AS from_long FROM orders""")
def f10_large_ids(spark, sf_dir):
    """Ids above 2^53 keep every digit."""
    big = F.lit(9007199254740992) + F.col("o_orderkey")
    return A.read(spark, sf_dir, "orders").select(
        "o_orderkey", C.nullable_long(big.cast("string")).alias("from_text"),
        C.nullable_long(F.concat(big.cast("string"), F.lit(".0"))).alias("from_decimal_text"),
        C.nullable_long(big).alias("from_long"))


@register("f7_parse_bool", """
SELECT o_orderkey, CASE WHEN upper(trim(t)) IN ('TRUE', 'SI') THEN true
                        WHEN upper(trim(t)) IN ('FALSE', 'NO') THEN false END AS flag
FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN ' si ' WHEN 2 THEN 'FALSE'
                                             WHEN 3 THEN 'No' ELSE 'quizas' END AS t FROM orders)""")
def f7_parse_bool(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 5
    t = (F.when(k == 0, "true").when(k == 1, " si ").when(k == 2, "FALSE").when(k == 3, "No")
          .otherwise("quizas"))
    return o.select("o_orderkey", C.parse_bool(t).alias("flag"))


@register("f15_constant_column", "SELECT o_orderkey, CAST(2023 AS BIGINT) AS \"año\" FROM orders")
def f15_constant_column(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").select("o_orderkey", F.lit(2023).cast("long").alias("año"))


@register("f16_coalesce", V("""
SELECT a."Orden", COALESCE(CASE WHEN a."Orden" % 9 = 0 THEN NULL ELSE a."Usuario" END, u."PRODUCTO") AS "Usuario"
FROM anomalies a JOIN users u ON a."Usuario" = u."CLIENTE" """, "anomalies", "users"))
def f16_coalesce(spark, sf_dir):
    a = A.anomalies(spark, sf_dir)
    u = A.users(spark, sf_dir).select("CLIENTE", "PRODUCTO")
    j = a.join(u, a["Usuario"] == u["CLIENTE"])
    usr = F.when(F.col("Orden") % 9 == 0, F.lit(None).cast("long")).otherwise(F.col("Usuario"))
    return j.select("Orden", F.coalesce(usr, F.col("PRODUCTO")).alias("Usuario"))


@register("f17_anomaly_label", V("""
SELECT "Orden", CASE WHEN "Descripcion" = 'Solo odt' THEN 'No anomalia' ELSE 'Anomalia' END AS "Anomalia_conf"
FROM anomalies""", "anomalies"))
def f17_anomaly_label(spark, sf_dir):
    a = A.anomalies(spark, sf_dir)
    return a.select("Orden", S.anomaly_label("Descripcion").alias("Anomalia_conf"))


@register("f18_concat_key", V("""
SELECT "CLIENTE", concat_ws('_', CAST(CAST("FASES" AS BIGINT) AS VARCHAR), "ZONA") AS estrato FROM users""", "users"))
def f18_concat_key(spark, sf_dir):
    u = A.users(spark, sf_dir)
    return u.select("CLIENTE", S.concat_key(F.col("FASES").cast("long"), "ZONA").alias("estrato"))


@register("f19_row_uuid", "SELECT o_orderkey, substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 32) AS id FROM orders")
def f19_row_uuid(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").select("o_orderkey", S.row_uuid("o_orderkey").alias("id"))


@register("f20_load_timestamp", "SELECT o_orderkey, '2024-05-06 07:08:09' AS fecha_creacion FROM orders")
def f20_load_timestamp(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.load_timestamp("2024-05-06 07:08:09").alias("fecha_creacion"))


@register("f21_arithmetic_offset", "SELECT l_orderkey, l_linenumber, l_linenumber + 1 AS next_line FROM lineitem")
def f21_arithmetic_offset(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") + 1).alias("next_line"))


@register("f22_rounded_pct", """
SELECT o_orderstatus, COALESCE(round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) * 100.0
                                     / count(*), 2), 0.0) AS urgent_pct
FROM orders GROUP BY o_orderstatus""")
def f22_rounded_pct(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    a = o.groupBy("o_orderstatus").agg(F.sum((F.col("o_orderpriority") == "1-URGENT").cast("long")).alias("u"),
                                       F.count(F.lit(1)).alias("n"))
    return a.select("o_orderstatus", S.rounded_pct("u", "n").alias("urgent_pct"))


# ----------------------------------------------------------------------------- projections and filters


@register("p1_projection", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def p1_projection(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@register("p2_tolerant_projection", "SELECT c_custkey, c_mktsegment FROM customer")
def p2_tolerant_projection(spark, sf_dir):
    return SC.select_existing(A.read(spark, sf_dir, "customer"), ["c_custkey", "not_there", "c_mktsegment"])


@register("p3_required_columns", "SELECT c_custkey, c_nationkey FROM customer")
def p3_required_columns(spark, sf_dir):
    c = A.read(spark, sf_dir, "customer")
    SC.require_columns(c, ["c_custkey", "c_nationkey"])
    return c.select("c_custkey", "c_nationkey")


_TARGET = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()),
                        T.StructField("Cluster", T.StringType()), T.StructField("o_orderdate", T.DateType())])


@register("p4_conform_schema", """
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS "Cluster", CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""")
def p4_conform_schema(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders").select("o_orderdate", "o_custkey", "o_totalprice", "o_orderkey")
    return SC.conform(o, _TARGET)


@register("p5_rename_present", V('SELECT "Orden", "kWh_Rec" AS "kWh Rec_renamed", "Motivo" FROM anomalies',
                                 "anomalies"))
def p5_rename_present(spark, sf_dir):
    a = A.anomalies(spark, sf_dir).select("Orden", "kWh_Rec", "Motivo")
    return SC.rename_present(a, {"kWh_Rec": "kWh Rec_renamed", "cluster_id": "Cluster"})


@register("p6_drop_present", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def p6_drop_present(spark, sf_dir):
    return SC.drop_present(A.read(spark, sf_dir, "customer"), "c_acctbal", "absent_col")


@register("p7_equality_filter", V('SELECT * FROM users WHERE "ZONA" = \'EUROPE\'', "users"))
def p7_equality_filter(spark, sf_dir):
    return A.users(spark, sf_dir).where(F.col("ZONA") == "EUROPE")


@register("p8_criteria_filter", """
SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def p8_criteria_filter(spark, sf_dir):
    from voltlens.operators.filters import find_by_criteria
    return find_by_criteria(A.read(spark, sf_dir, "orders"),
                            {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


@register("p9_find_by_year", V('SELECT * FROM anomalies WHERE year("Ejecucion") = 1995', "anomalies"))
def p9_find_by_year(spark, sf_dir):
    from voltlens.operators.filters import find_by_year
    return find_by_year(A.anomalies(spark, sf_dir), 1995, date_col="Ejecucion")


@register("p13_substring_filter", V("""
SELECT "Orden", "Codigo", strpos("Codigo", '/') > 0 AS has_slash FROM anomalies""", "anomalies"))
def p13_substring_filter(spark, sf_dir):
    a = A.anomalies(spark, sf_dir)
    return a.select("Orden", "Codigo", F.col("Codigo").contains("/").alias("has_slash"))


@register("p16_columns_by_type", V("""
SELECT "CLIENTE", "AREA", "PLAN_COMERCIAL", "TRAFO_OPEN", "CATEGORIA", "SUB_CATEGORIA", "ZONA" FROM users""", "users"))
def p16_columns_by_type(spark, sf_dir):
    u = A.users(spark, sf_dir)
    return u.select("CLIENTE", *SC.columns_of_type(u, T.StringType))


# ----------------------------------------------------------------------------- limits, sorts, samples


@register("l1_limit_read", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000")
def l1_limit_read(spark, sf_dir):
    return L.limit_read(A.read(spark, sf_dir, "orders"), "o_orderkey", 1000)


@register("l2_sort_by_key", "SELECT DISTINCT n_name FROM nation ORDER BY n_name")
def l2_sort_by_key(spark, sf_dir):
    return A.read(spark, sf_dir, "nation").select("n_name").distinct().orderBy("n_name")


@register("l3_head", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def l3_head(spark, sf_dir):
    return L.head(A.read(spark, sf_dir, "customer"), 5, "c_custkey")


@register("l4_sample_n", """
SELECT * FROM customer ORDER BY (c_custkey * 2654435761) % 1000003, c_custkey LIMIT 100""")
def l4_sample_n(spark, sf_dir):
    c = A.read(spark, sf_dir, "customer")
    return L.sample_n(c, 100, key=(F.col("c_custkey") * F.lit(2654435761)) % F.lit(1000003), id_col="c_custkey")


@register("l5_top1_by_metric", """
SELECT o_orderstatus, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey, max(o_totalprice) AS best
FROM orders GROUP BY o_orderstatus""")
def l5_top1_by_metric(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders")
    return L.top1(o, "o_orderkey", F.col("o_totalprice"), by="o_orderstatus")


# ----------------------------------------------------------------------------- set operations, reconciliation


@register("u1_union_all", """
SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS bal, 'c' AS src FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 's' FROM supplier""")
def u1_union_all(spark, sf_dir):
    c = A.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                   F.lit("c").alias("src"))
    s = A.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                   F.col("s_acctbal").alias("bal"), F.lit("s").alias("src"))
    return c.unionByName(s, allowMissingColumns=True)


@register("u2_array_columns", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
       CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings""")
def u2_array_columns(spark, sf_dir):
    """Every element of the vectors, one row each."""
    e = A.read(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.posexplode("embedding").alias("pos", "v")).select(
        "vec_id", "pos", F.col("v").cast("double").alias("value"))


@register("x6_reconciliation", V("""
WITH a AS (SELECT "Orden", "Usuario" FROM anomalies WHERE year("Ejecucion") BETWEEN 1994 AND 1996),
b AS (SELECT "Orden", "Usuario" FROM anomalies WHERE year("Ejecucion") BETWEEN 1995 AND 1997)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM a) AS rows_a, (SELECT CAST(count(*) AS BIGINT) FROM b) AS rows_b,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b""",
                                    "anomalies"))
def x6_reconciliation(spark, sf_dir):
    from voltlens.operators.stats import reconcile
    an = A.anomalies(spark, sf_dir)
    y = F.year("Ejecucion")
    a = an.where(y.between(1994, 1996)).select("Orden", "Usuario")
    b = an.where(y.between(1995, 1997)).select("Orden", "Usuario")
    return reconcile(a, b)


@register("p9_find_by_id", "SELECT * FROM orders WHERE o_orderkey = 4242")
def p9_find_by_id(spark, sf_dir):
    from voltlens.operators.filters import find_by_id
    return find_by_id(A.read(spark, sf_dir, "orders"), 4242, "o_orderkey")


@register("f1_split_codes", V("""
SELECT "Orden", CAST(len(string_split("Codigo", '/')) AS INTEGER) AS n_parts,
       trim(string_split("Codigo", '/')[1]) AS part_1, trim(string_split("Codigo", '/')[2]) AS part_2
FROM anomalies""", "anomalies"))
def f1_split_codes(spark, sf_dir):
    parts = S.split_trim("Codigo")
    a = A.anomalies(spark, sf_dir)
    return a.select("Orden", F.size(parts).alias("n_parts"), F.element_at(parts, 1).alias("part_1"),
                    F.element_at(parts, 2).alias("part_2"))

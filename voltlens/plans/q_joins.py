"""Catalog entries: the join variants (J1-J3, J6-J8, J11, J12), encoders (K5,
K6, K12), the estimator API (D-3/D-4), processing report (A11), publish (C7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltlens.functions.schema import select_existing
from voltlens.operators import joins as J
from voltlens.plans import analogues as A
from voltlens.plans import pipelines as P
from voltlens.plans.analogues import with_views as V
from voltlens.plans.catalog import register


@register("j1_inner_join_renamed", V("""
SELECT o.o_orderkey, o.o_custkey AS item_288, u."AREA", u."ZONA"
FROM orders o JOIN users u ON o.o_custkey = u."PRODUCTO" """, "users"))
def j1_inner_join_renamed(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("item_288"))
    u = A.users(spark, sf_dir).select("PRODUCTO", "AREA", "ZONA")
    return J.join_renamed(o, u, "item_288", "PRODUCTO", "inner")


@register("j2_id_translation", """
SELECT CAST(l_orderkey AS BIGINT) AS odt, l_linenumber, o_orderkey AS orden
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def j2_id_translation(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")).alias("odt"), "l_linenumber")
    m = A.read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("uid"),
                                               F.col("o_orderkey").alias("orden"))
    return J.translate_ids(li, m, "odt", "uid")


_J3_LEFT_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber % 3 WHEN 0 THEN CAST(l_orderkey AS VARCHAR) WHEN 1 THEN CAST(l_orderkey AS VARCHAR) || '.0'
            ELSE 'k' || CAST(l_orderkey AS VARCHAR) END AS orden
FROM lineitem"""


@register("j3_mixed_key_left_join", f"""
SELECT l.l_orderkey, l.l_linenumber, l.orden, o.o_orderstatus
FROM ({_J3_LEFT_SQL}) l LEFT JOIN orders o
  ON (CASE WHEN l.l_linenumber % 3 = 2 THEN NULL ELSE l.l_orderkey END) = o.o_orderkey""")
def j3_mixed_key_left_join(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    k = F.col("l_linenumber") % 3
    orden = (F.when(k == 0, F.col("l_orderkey").cast("string"))
              .when(k == 1, F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")))
              .otherwise(F.concat(F.lit("k"), F.col("l_orderkey").cast("string"))))
    left = li.select("l_orderkey", "l_linenumber", orden.alias("orden"))
    right = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return J.left_join_mixed_keys(left, right, "orden", "o_orderkey").drop("o_orderkey")


@register("j3_large_ids", """
SELECT CAST(9007199254740992 + l_orderkey AS VARCHAR) AS k, l_linenumber, o_orderstatus
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def j3_large_ids(spark, sf_dir):
    """Neighbouring ids above 2^53 do not meet."""
    big = 9007199254740992
    left = A.read(spark, sf_dir, "lineitem").select(
        (F.lit(big) + F.col("l_orderkey")).cast("string").alias("k"), "l_linenumber")
    right = A.read(spark, sf_dir, "orders").select((F.lit(big) + F.col("o_orderkey")).alias("ok"), "o_orderstatus")
    return J.left_join_mixed_keys(left, right, "k", "ok").drop("ok")


@register("j4_left_join_empty_right", """
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS "Descripcion" FROM orders""")
def j4_left_join_empty_right(spark, sf_dir):
    o = A.read(spark, sf_dir, "orders").select("o_orderkey")
    empty = J.typed_empty_like(spark, "Orden long, Descripcion string")
    return J.left_join_mixed_keys(o, empty, "o_orderkey", "Orden").drop("Orden")


@register("j6_dimension_left_join", V("""
SELECT a."Orden", a."Codigo_x" AS "Codigo", s.id, s."Nombre", s.puntaje FROM codes_x a
LEFT JOIN severity s ON a."Codigo_x" = s."Item" """, "severity"))
def j6_dimension_left_join(spark, sf_dir):
    a = P.expand_codes(A.anomalies(spark, sf_dir).select("Orden", "Codigo"))
    return P.with_severity(a, A.severity(spark, sf_dir))


_NULLY_AN = ('SELECT "Orden", CASE WHEN "Orden" % 11 = 0 THEN NULL ELSE "Usuario" END AS "Usuario" '
             'FROM anomalies')
_NULLY_US = ('SELECT CASE WHEN "CLIENTE" % 13 = 0 THEN NULL ELSE "PRODUCTO" END AS "PRODUCTO", "ZONA" '
             'FROM users')


def _nully(spark, sf_dir):
    a = A.anomalies(spark, sf_dir).select(
        "Orden", F.when(F.col("Orden") % 11 == 0, F.lit(None).cast("long")).otherwise(F.col("Usuario"))
        .alias("Usuario"))
    u = A.users(spark, sf_dir).select(
        F.when(F.col("CLIENTE") % 13 == 0, F.lit(None).cast("long")).otherwise(F.col("PRODUCTO")).alias("PRODUCTO"),
        "ZONA")
    return a, u


@register("j7_fact_users_left_join", V(f"""
SELECT a."Orden", a."Usuario", u."PRODUCTO", u."ZONA" FROM ({_NULLY_AN}) a
LEFT JOIN ({_NULLY_US}) u ON a."Usuario" = u."PRODUCTO" """, "anomalies", "users"))
def j7_fact_users_left_join(spark, sf_dir):
    a, u = _nully(spark, sf_dir)
    return J.join_renamed(a, u, "Usuario", "PRODUCTO", "left", drop_right_key=False)


@register("j8_right_join_users", V(f"""
SELECT a."Orden", a."Usuario", u."PRODUCTO", u."ZONA" FROM ({_NULLY_AN}) a
RIGHT JOIN ({_NULLY_US}) u ON a."Usuario" = u."PRODUCTO" """, "anomalies", "users"))
def j8_right_join_users(spark, sf_dir):
    a, u = _nully(spark, sf_dir)
    return J.join_renamed(a, u, "Usuario", "PRODUCTO", "right", drop_right_key=False)


@register("j11_null_keys_match", V(f"""
SELECT a."Orden", a."Usuario", u."PRODUCTO", u."ZONA" FROM ({_NULLY_AN}) a
LEFT JOIN (SELECT "PRODUCTO", min("ZONA") AS "ZONA" FROM ({_NULLY_US}) GROUP BY "PRODUCTO") u
  ON a."Usuario" IS NOT DISTINCT FROM u."PRODUCTO" """, "anomalies", "users"))
def j11_null_keys_match(spark, sf_dir):
    """NULL meets NULL; the right side holds one row per key, NULL included (several
    NULLs on both sides are refused: their pairs would all fall in one task)."""
    a, u = _nully(spark, sf_dir)
    u = u.groupBy("PRODUCTO").agg(F.min("ZONA").alias("ZONA"))
    return J.join_renamed(a, u, "Usuario", "PRODUCTO", "left", drop_right_key=False, null_keys_match=True)


@register("j12_key_coercion", """
SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS qty FROM lineitem WHERE l_linenumber <> 3""")
def j12_key_coercion(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem")
    txt = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    return J.coerce_key(li.select("l_orderkey", txt.alias("qty")), "qty")


# ----------------------------------------------------------------------------- encoders

@register("k5_global_label_encoding", V("""
WITH d AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
           FROM (SELECT DISTINCT "SUB_CATEGORIA" AS v FROM users WHERE "SUB_CATEGORIA" IS NOT NULL))
SELECT u."CLIENTE", CAST(COALESCE(d.code, -1) AS BIGINT) AS sub_code
FROM (SELECT "CLIENTE", CASE WHEN "CLIENTE" % 17 = 0 THEN NULL ELSE "SUB_CATEGORIA" END AS "SUB_CATEGORIA"
      FROM users) u LEFT JOIN d ON u."SUB_CATEGORIA" = d.v""", "users"))
def k5_global_label_encoding(spark, sf_dir):
    from voltlens.operators.features import encode_with, label_codes
    u = A.users(spark, sf_dir)
    u = u.select("CLIENTE", F.when(F.col("CLIENTE") % 17 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("SUB_CATEGORIA")).alias("SUB_CATEGORIA"))
    d = label_codes(A.users(spark, sf_dir), "SUB_CATEGORIA")
    return encode_with(u, d, "SUB_CATEGORIA", "sub_code").select("CLIENTE", F.col("sub_code").cast("long"))


@register("k12_category_unknown", V("""
WITH d AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
           FROM (SELECT DISTINCT "PLAN_COMERCIAL" AS v FROM users WHERE "ZONA" = 'EUROPE'))
SELECT u."CLIENTE", CAST(COALESCE(d.code, -1) AS BIGINT) AS plan_code
FROM users u LEFT JOIN d ON u."PLAN_COMERCIAL" = d.v""", "users"))
def k12_category_unknown(spark, sf_dir):
    from voltlens.operators.features import encode_with, label_codes
    u = A.users(spark, sf_dir)
    d = label_codes(u.where(F.col("ZONA") == "EUROPE"), "PLAN_COMERCIAL")
    return encode_with(u.select("CLIENTE", "PLAN_COMERCIAL"), d, "PLAN_COMERCIAL", "plan_code") \
        .select("CLIENTE", F.col("plan_code").cast("long"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("k6_one_hot", V('SELECT "CLIENTE", ' + ", ".join(
    f"""CAST(CASE WHEN a = '{s}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS oh_{i}""" for i, s in enumerate(_SEGMENTS)) + """
FROM (SELECT "CLIENTE", CASE WHEN "CLIENTE" % 19 = 0 THEN NULL ELSE "AREA" END AS a FROM users)""", "users"))
def k6_one_hot(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    from voltlens.operators.features import one_hot
    u = A.users(spark, sf_dir)
    fit_rows = u.select("CLIENTE", "AREA")
    score = u.select("CLIENTE", F.when(F.col("CLIENTE") % 19 == 0, F.lit(None).cast("string"))
                     .otherwise(F.col("AREA")).alias("AREA"))
    model = one_hot(fit_rows, ["AREA"], "oh").fit(fit_rows)
    out = model.transform(score).select("CLIENTE", vector_to_array("oh").alias("v"))
    return out.select("CLIENTE", *[F.col("v")[i].alias(f"oh_{i}") for i in range(len(_SEGMENTS))])


# ----------------------------------------------------------------------------- estimator API, report, publish

def _k8_sql():
    from voltlens.plans.q_model import _PRED_BODY, _PRED_CTE, _sql
    return _sql(_PRED_BODY, _PRED_CTE)


@register("k11_zone_estimator", _k8_sql())
def k11_zone_estimator(spark, sf_dir):
    from voltlens.operators.ml import ZoneFuzzyCMeans
    from voltlens.plans.q_model import ITERS, K, _init_spark
    users = A.users(spark, sf_dir)
    est = ZoneFuzzyCMeans(init=_init_spark, k=K, maxIter=ITERS, tol=0.0)
    model = est.fit(users)
    pred = model.transform(users.where(F.col("ZONA").isNotNull()))
    return pred.select("CLIENTE", "ZONA", "cluster_id", *[f"cluster_{k}" for k in range(K)])


@register("a11_processing_report", V("""
SELECT 'anomalies' AS stage, CAST(count(*) AS BIGINT) AS rows, CAST(8 AS BIGINT) AS cols FROM anomalies
UNION ALL SELECT 'users', CAST(count(*) AS BIGINT), CAST(15 AS BIGINT) FROM users
UNION ALL SELECT 'plain', CAST(count(*) AS BIGINT), CAST(4 AS BIGINT) FROM lineitem
UNION ALL SELECT 'uid_conversion', CAST(count(*) AS BIGINT), CAST(2 AS BIGINT) FROM orders""", "anomalies", "users"))
def a11_processing_report(spark, sf_dir):
    from voltlens.operators.profile import shape_report
    parts = [shape_report(A.anomalies(spark, sf_dir), "anomalies"), shape_report(A.users(spark, sf_dir), "users"),
             shape_report(A.plain(spark, sf_dir), "plain"),
             shape_report(A.uid_conversion(spark, sf_dir), "uid_conversion")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _s11_sql():
    from voltlens.plans.q_io import s11_warehouse_load  # noqa: F401
    from voltlens.plans.catalog import _REGISTRY
    return _REGISTRY["s11_warehouse_load"][1]


@register("c7_publish_prepare", _s11_sql())
def c7_publish_prepare(spark, sf_dir):
    from voltlens.plans.jobs import publish_prepare
    a = A.anomalies(spark, sf_dir)
    u = A.users(spark, sf_dir).select("PRODUCTO", "AREA", "PLAN_COMERCIAL", "LATI_USU", "LONG_USU", "ZONA")
    src = a.join(u, a["Usuario"] == u["PRODUCTO"]).select(
        "Usuario", F.col("Ejecucion").cast("string").alias("Ejecucion"), "AREA", "PLAN_COMERCIAL",
        F.concat(F.lit("Cod "), F.col("Motivo")).alias("Nombre"), F.col("kWh_Rec").alias("kWh Rec"),
        (F.col("Orden") % 3).alias("cluster_id"), "LATI_USU", "LONG_USU", "ZONA")
    return publish_prepare(src)


@register("p15_valid_fields", V("""
SELECT "AREA", "PLAN_COMERCIAL", "ZONA", "LATI_USU", "LONG_USU", "NIVEL" FROM users""", "users"))
def p15_valid_fields(spark, sf_dir):
    from voltlens.plans.jobs import ANOMALIA_SCHEMA
    return select_existing(A.users(spark, sf_dir), [f.name for f in ANOMALIA_SCHEMA.fields])


@register("s6_jdbc_partitioned_read", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s6_jdbc_partitioned_read(spark, sf_dir):
    import uuid
    from voltlens.sources import jdbc
    url = f"jdbc:derby:memory:voltlens_{uuid.uuid4().hex[:8]};create=true"
    jdbc.append(A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), url, "O_T")
    return jdbc.read_table(spark, url, "O_T", partition_column="o_orderkey", num_partitions=8)

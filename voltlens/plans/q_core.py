"""Catalog entries: dataset build (C1, C3, C4) and its joins, EAV, dedupe."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltlens.plans import analogues as A
from voltlens.plans import pipelines as P
from voltlens.plans.analogues import with_views as V
from voltlens.plans.catalog import register

# ----------------------------------------------------------------------------- C3

_C3_SELECT = """
SELECT DISTINCT a."Orden", a."Usuario", a."Ejecucion", a."Codigo_x" AS "Codigo", a."Descripcion",
       a."Motivo", a."kWh_Rec", s.id, s."Nombre", u."TRAFO_OPEN", u."FASES", u."KVA", u."AREA",
       u."PLAN_COMERCIAL", u."LATI_USU", u."LONG_USU", u."LATI_TRAFO", u."LONG_TRAFO", u."ZONA",
       u."CATEGORIA", u."SUB_CATEGORIA", s.puntaje
FROM codes_x a
LEFT JOIN severity s ON a."Codigo_x" = s."Item"
LEFT JOIN users u ON a."Usuario" = u."PRODUCTO"
WHERE u."ZONA" IS NOT NULL
"""


@register("c3_merge_and_clean", V(_C3_SELECT, "severity", "users"))
def c3_merge_and_clean(spark, sf_dir):
    return P.merge_and_clean(A.anomalies(spark, sf_dir), A.users(spark, sf_dir), A.severity(spark, sf_dir))


_C4_SELECT = """
SELECT DISTINCT a."Orden", a."Usuario", a."Ejecucion", a."Codigo_x" AS "Codigo", a."Descripcion",
       a."Motivo", a."kWh_Rec", s.id, s."Nombre", s.puntaje, u.*
FROM codes_x a
LEFT JOIN severity s ON a."Codigo_x" = s."Item"
RIGHT JOIN users u ON a."Usuario" = u."PRODUCTO"
WHERE u."ZONA" IS NOT NULL
"""


@register("c4_inference_dataset", V(_C4_SELECT, "severity", "users"))
def c4_inference_dataset(spark, sf_dir):
    return P.inference_dataset(A.anomalies(spark, sf_dir), A.users(spark, sf_dir), A.severity(spark, sf_dir))


# ----------------------------------------------------------------------------- C1

C1_YEAR = 1996
C1_ITEMS = [3, 4, 5, 6, 7, 99]
C1_TYPES = {"item_3": "double", "item_4": "long", "item_5": "string", "item_6": "string", "item_7": "double",
            "item_99": "string"}

_NUM_LONG = "CASE WHEN TRY_CAST({x} AS DOUBLE) = floor(TRY_CAST({x} AS DOUBLE)) THEN CAST(TRY_CAST({x} AS DOUBLE) AS BIGINT) END"

_C1_SQL = f"""
WITH p1 AS (SELECT odt, value, row_number() OVER (PARTITION BY odt ORDER BY ord) AS rn FROM plain WHERE id = 2),
lk AS (SELECT odt, value AS v288 FROM p1 WHERE rn = 1 AND value IS NOT NULL),
z AS (SELECT p.odt, {_NUM_LONG.format(x='lk.v288')} AS item_288
      FROM plain p JOIN lk ON p.odt = lk.odt WHERE p.id = 1),
zu AS (SELECT z.odt, z.item_288, u."AREA", u."PLAN_COMERCIAL", u."NIVEL", u."LATI_USU", u."LONG_USU", u."ZONA"
       FROM z JOIN users u ON z.item_288 = u."PRODUCTO" WHERE z.item_288 IS NOT NULL),
zuid AS (SELECT zu.*, m.orden FROM zu JOIN uid_conversion m ON zu.odt = m.uid WHERE m.orden IS NOT NULL),
an0 AS (SELECT "Orden", "Descripcion", "Revision", count(*) OVER (PARTITION BY "Orden") AS n
        FROM anomalies WHERE year("Ejecucion") = {C1_YEAR}),
an AS (SELECT "Orden", "Descripcion" FROM an0
       WHERE NOT (n > 1 AND ("Revision" IS NULL OR lower("Revision") = 'nan'))),
mm AS (SELECT zuid.*, an."Descripcion" FROM zuid LEFT JOIN an ON zuid.orden = an."Orden"),
items AS (SELECT odt, id, value FROM (
            SELECT odt, id, value, row_number() OVER (PARTITION BY odt, id ORDER BY ord) AS rn
            FROM plain WHERE id IN ({', '.join(str(i) for i in C1_ITEMS)})) WHERE rn = 1),
wide AS (SELECT odt, {', '.join(f'max(CASE WHEN id = {i} THEN value END) AS w{i}' for i in C1_ITEMS)}
         FROM items GROUP BY odt)
SELECT mm.item_288, mm."PLAN_COMERCIAL", mm."NIVEL", mm."LATI_USU", mm."LONG_USU", mm."AREA", mm."ZONA",
       CASE WHEN mm."Descripcion" IN ('nan', '<NA>', 'None') THEN NULL ELSE mm."Descripcion" END AS "Descripcion",
       mm.odt, mm.orden,
       TRY_CAST(w.w3 AS DOUBLE) AS item_3, {_NUM_LONG.format(x='w.w4')} AS item_4,
       CASE WHEN w.w5 IN ('nan', '<NA>', 'None') THEN NULL ELSE w.w5 END AS item_5,
       CASE WHEN w.w6 IN ('nan', '<NA>', 'None') THEN NULL ELSE w.w6 END AS item_6,
       TRY_CAST(w.w7 AS DOUBLE) AS item_7, CAST(w.w99 AS VARCHAR) AS item_99,
       CAST({C1_YEAR} AS BIGINT) AS "año"
FROM mm LEFT JOIN wide w ON mm.odt = w.odt
"""


@register("c1_process_data", V(_C1_SQL, "anomalies", "users", "plain", "uid_conversion"))
def c1_process_data(spark, sf_dir, keep_order=False):
    return P.process_data(A.anomalies(spark, sf_dir), A.users(spark, sf_dir), A.plain(spark, sf_dir),
                          A.uid_conversion(spark, sf_dir), target_year=C1_YEAR, item_ids=C1_ITEMS,
                          item_types=C1_TYPES, zone_item=1, customer_item=2, keep_order=keep_order)


# ----------------------------------------------------------------------------- J9 / J5

_J9_IDS = [1, 2, 3, 4, 5, 6, 7, 48]
_J9_SQL = f"""
WITH items AS (SELECT odt, id, value FROM (
        SELECT odt, id, value, row_number() OVER (PARTITION BY odt, id ORDER BY ord) AS rn FROM plain
        WHERE id IN ({', '.join(map(str, _J9_IDS))})) WHERE rn = 1),
wide AS (SELECT odt, {', '.join(f'max(CASE WHEN id = {i} THEN value END) AS item_{i}' for i in _J9_IDS)}
         FROM items GROUP BY odt),
base AS (SELECT DISTINCT o_orderkey AS odt, o_orderstatus FROM orders)
SELECT base.odt, base.o_orderstatus, {', '.join(f'wide.item_{i}' for i in _J9_IDS[:-1])},
       CAST(wide.item_48 AS VARCHAR) AS item_48
FROM base LEFT JOIN wide ON base.odt = wide.odt
"""


@register("j9_eav_widen", V(_J9_SQL, "plain"))
def j9_eav_widen(spark, sf_dir):
    from voltlens.operators import eav
    base = A.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("odt"), "o_orderstatus").distinct()
    return eav.widen_join(base, A.plain(spark, sf_dir), _J9_IDS)


_J5_SQL = """
WITH p1 AS (SELECT odt, value, row_number() OVER (PARTITION BY odt ORDER BY ord) AS rn FROM plain WHERE id = 3),
lk AS (SELECT odt, value AS item_3 FROM p1 WHERE rn = 1)
SELECT p.odt, p.value AS zone_value, lk.item_3 FROM plain p JOIN lk ON p.odt = lk.odt
WHERE p.id = 1 AND lk.item_3 IS NOT NULL
"""


@register("j5_lookup_join", V(_J5_SQL, "plain"))
def j5_lookup_join(spark, sf_dir):
    from voltlens.operators import eav
    p = A.plain(spark, sf_dir)
    zones = p.where(F.col("id") == 1).select("odt", F.col("value").alias("zone_value"))
    return eav.lookup_join(zones, p, 3, "item_3")

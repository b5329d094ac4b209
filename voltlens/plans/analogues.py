"""Role tables of the anomaly pipeline derived from the driver's test tables.

Each builder is plain DataFrame code over the given parquet tables, so work
grows with them; ``SQL`` holds the same derivations as DuckDB views for the
oracle. Missing values are injected by a rule on the key on both sides
(the test tables carry no NULLs).

| role            | source                      |
|-----------------|-----------------------------|
| anomalies       | orders                      |
| severity        | distinct codes of anomalies |
| users           | customer x nation x region  |
| plain (EAV)     | lineitem                    |
| uid_conversion  | orders                      |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlens.functions.scalars import explode_codes
from voltlens.operators.prefix import dense_codes
from voltlens.session import table_path
from voltlens.sources.files import read_table


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("Orden"),
        F.col("o_custkey").alias("Usuario"),
        F.col("o_orderdate").cast("date").alias("Ejecucion"),
        F.concat(F.col("o_orderstatus"), F.lit(" / "), F.col("o_orderpriority")).alias("Codigo"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Solo odt"))
         .otherwise(F.col("o_orderpriority")).alias("Descripcion"),
        F.col("o_orderstatus").alias("Motivo"),
        F.col("o_totalprice").alias("kWh_Rec"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("r")).alias("Revision"),
    )


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code -> severity dimension: the distinct codes, numbered in sorted order,
    ``puntaje`` cycling 1..5."""
    codes = anomalies(spark, sf_dir).select(explode_codes("Codigo").alias("Item"))
    d = dense_codes(codes, "Item", name="rk")
    return d.select(
        "Item",
        (F.col("rk") + 1).cast("double").alias("id"),
        F.concat(F.lit("Cod "), F.col("Item")).alias("Nombre"),
        (F.col("rk") % 5 + 1).cast("int").alias("puntaje"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.select(
        F.col("c_custkey").alias("CLIENTE"),
        F.col("c_custkey").alias("PRODUCTO"),
        F.col("c_mktsegment").alias("AREA"),
        F.col("n_name").alias("PLAN_COMERCIAL"),
        F.concat(F.lit("T"), F.col("c_nationkey").cast("string")).alias("TRAFO_OPEN"),
        (F.col("c_nationkey") % 3 + 1).cast("double").alias("FASES"),
        (F.col("c_nationkey") * 5).cast("double").alias("KVA"),
        F.when(F.col("c_acctbal") < 0, F.lit("NEG")).otherwise(F.lit("POS")).alias("CATEGORIA"),
        F.substring("c_mktsegment", 1, 3).alias("SUB_CATEGORIA"),
        F.when(F.col("c_custkey") % 53 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("ZONA"),
        (F.col("c_nationkey") % 5 + 1).cast("double").alias("NIVEL"),
        F.when(F.col("c_custkey") % 41 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal")).alias("LATI_USU"),
        (F.col("c_custkey") % 97).cast("double").alias("LONG_USU"),
        F.col("c_nationkey").cast("double").alias("LATI_TRAFO"),
        F.col("n_regionkey").cast("double").alias("LONG_TRAFO"),
    )


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EAV rows (odt, id, value) with their BIGINT ingest ordinal ``_ord``."""
    li = read_table(spark, table_path(sf_dir, "lineitem"), ordinal="_ord")
    return li.select(
        F.col("l_orderkey").alias("odt"),
        F.col("l_linenumber").alias("id"),
        F.col("l_quantity").cast("string").alias("value"),
        "_ord",
    )


def uid_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("uid"), F.col("o_orderkey").alias("orden"))


# ---------------------------------------------------------------------------
# DuckDB views with the same derivations (used by the oracle SQL strings)
# ---------------------------------------------------------------------------

SQL = {
    "anomalies": """
        SELECT o_orderkey AS "Orden", o_custkey AS "Usuario",
               CAST(o_orderdate AS DATE) AS "Ejecucion",
               o_orderstatus || ' / ' || o_orderpriority AS "Codigo",
               CASE WHEN o_orderstatus = 'P' THEN 'Solo odt' ELSE o_orderpriority END AS "Descripcion",
               o_orderstatus AS "Motivo", o_totalprice AS "kWh_Rec",
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'r' END AS "Revision"
        FROM orders""",
    "codes_x": """
        SELECT *, trim(unnest(string_split("Codigo", '/'))) AS "Codigo_x" FROM anomalies""",
    "severity": """
        SELECT "Item", CAST(rk + 1 AS DOUBLE) AS id, 'Cod ' || "Item" AS "Nombre",
               CAST(rk % 5 + 1 AS INTEGER) AS puntaje
        FROM (SELECT "Item", dense_rank() OVER (ORDER BY "Item") - 1 AS rk
              FROM (SELECT DISTINCT "Codigo_x" AS "Item" FROM codes_x WHERE "Codigo_x" IS NOT NULL))""",
    "users": """
        SELECT c_custkey AS "CLIENTE", c_custkey AS "PRODUCTO", c_mktsegment AS "AREA",
               n_name AS "PLAN_COMERCIAL", 'T' || CAST(c_nationkey AS VARCHAR) AS "TRAFO_OPEN",
               CAST(c_nationkey % 3 + 1 AS DOUBLE) AS "FASES", CAST(c_nationkey * 5 AS DOUBLE) AS "KVA",
               CASE WHEN c_acctbal < 0 THEN 'NEG' ELSE 'POS' END AS "CATEGORIA",
               substr(c_mktsegment, 1, 3) AS "SUB_CATEGORIA",
               CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE r_name END AS "ZONA",
               CAST(c_nationkey % 5 + 1 AS DOUBLE) AS "NIVEL",
               CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_acctbal END AS "LATI_USU",
               CAST(c_custkey % 97 AS DOUBLE) AS "LONG_USU",
               CAST(c_nationkey AS DOUBLE) AS "LATI_TRAFO", CAST(n_regionkey AS DOUBLE) AS "LONG_TRAFO"
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "plain": """
        SELECT l_orderkey AS odt, l_linenumber AS id, CAST(l_quantity AS VARCHAR) AS value,
               row_number() OVER () AS ord
        FROM lineitem""",
    "uid_conversion": "SELECT o_orderkey AS uid, o_orderkey AS orden FROM orders",
}

_ORDERED = ["anomalies", "codes_x", "severity", "users", "plain", "uid_conversion"]


def with_views(sql: str, *needed: str) -> str:
    """Prefix ``sql`` with the analogue views it needs (in dependency order)."""
    deps = {"codes_x": ["anomalies"], "severity": ["anomalies", "codes_x"]}
    want = set()
    for n in needed:
        want.add(n)
        want.update(deps.get(n, []))
    ctes = [f'{n} AS ({SQL[n]})' for n in _ORDERED if n in want]
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body

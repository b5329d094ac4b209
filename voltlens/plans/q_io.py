"""Catalog entries: sources, sinks, jobs and the stream.

Sinks write to a fresh folder under the shared checkpoint directory and the
query returns what is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlens.plans import analogues as A
from voltlens.plans.analogues import with_views as V
from voltlens.plans.catalog import register
from voltlens.session import scratch_path
from voltlens.sources import files, sinks

RUN_TS = "2024-05-06 07:08:09"

_ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _orders_csv(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    sinks.write_table(A.read(spark, sf_dir, "orders"), path, "csv")
    return path


# inference picks INT for keys whose values fit in 32 bits
@register("s1_csv_inferred", "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, "
                             "o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def s1_csv_inferred(spark, sf_dir):
    return files.read_csv(spark, _orders_csv(spark, sf_dir))


_ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])


@register("s2_csv_typed", f"SELECT {_ORDERS_COLS}, CAST(NULL AS VARCHAR) AS _corrupt FROM orders")
def s2_csv_typed(spark, sf_dir):
    return files.read_csv(spark, _orders_csv(spark, sf_dir), _ORDERS_SCHEMA, corrupt_col="_corrupt")


@register("s3_table_scan", """
SELECT l_orderkey, l_linenumber, l_quantity,
       row_number() OVER () AS pos FROM lineitem""")
def s3_table_scan(spark, sf_dir):
    li = files.read_table(spark, f"{sf_dir}/lineitem.parquet", ordinal="_ord")
    # the ordinal holds the file's number and the row in the file: rank it to a plain number
    from voltlens.operators.prefix import row_rank
    r = li.select("l_orderkey", "l_linenumber", "l_quantity", "_ord")
    return row_rank(r, ["_ord"], name="pos").drop("_ord")


@register("s4_optional_source", """
SELECT o_orderkey, c_name, CAST(NULL AS VARCHAR) AS note FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def s4_optional_source(spark, sf_dir):
    """A present optional input joins; a missing one leaves its column empty."""
    out = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    present = files.optional_source(spark, f"{sf_dir}/customer.parquet")
    out = out.join(present.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left")
    notes = files.optional_source(spark, f"{sf_dir}/no_such_table.parquet")
    out = out.withColumn("note", F.lit(None).cast("string")) if notes is None else out.join(notes, "o_custkey", "left")
    return out.drop("o_custkey")


# ----------------------------------------------------------------------------- API ingest

def _land_api(spark, sf_dir):
    """API records derived from ``events``: views carry a present NULL
    latitude, errors lack ZONA, clicks send orden as a fraction."""
    e = A.read(spark, sf_dir, "events")
    zone = F.get_json_object("props", "$.k")
    lat = F.when(F.col("event_type") == "view", F.lit(None).cast("string")).otherwise(F.col("value").cast("string"))
    orden = F.when(F.col("event_type") == "click", (F.col("user_id") + 0.5).cast("string")) \
             .otherwise(F.col("user_id").cast("string"))
    m = F.create_map(F.lit("odt"), F.col("event_id").cast("string"), F.lit("orden"), orden,
                     F.lit("LATI_USU"), lat, F.lit("LONG_USU"), (-F.col("value")).cast("string"),
                     F.lit("PLAN_COMERCIAL"), F.col("event_type"), F.lit("ZONA"), zone,
                     F.lit("item_288"), (F.col("event_id") % 1000).cast("string"),
                     F.lit("extra_field"), F.lit("x"))
    m = F.when(F.col("event_type") == "error", F.map_filter(m, lambda k, v: k != "ZONA")).otherwise(m)
    path = scratch_path(spark, "api-landing")
    e.select(F.to_json(m).alias("value")).write.mode("overwrite").text(path)
    return path


_API_SQL = """
SELECT event_id AS odt, CAST(trunc(CAST(CAST(user_id AS VARCHAR) AS DOUBLE)) AS BIGINT) AS orden,
       value AS "LATI_USU", -value AS "LONG_USU", CAST(0.0 AS DOUBLE) AS "NIVEL", event_type AS "PLAN_COMERCIAL",
       json_extract_string(props, '$.k') AS "ZONA", event_id % 1000 AS item_288, 'NO' AS item_23,
       'Anomalia' AS "Anomalia_conf", CAST(2024 AS BIGINT) AS "año"
FROM events WHERE event_type NOT IN ('view', 'error', 'click')"""


@register("c9_api_load", _API_SQL)
def c9_api_load(spark, sf_dir):
    from voltlens.plans.jobs import api_load_job
    ok, _ = api_load_job(spark, _land_api(spark, sf_dir), 2024, RUN_TS, json_lines=True)
    return ok.select("odt", "orden", "LATI_USU", "LONG_USU", "NIVEL", "PLAN_COMERCIAL", "ZONA", "item_288",
                     "item_23", "Anomalia_conf", "año")


@register("p17_record_rejects", """
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'missing required field' ELSE 'value does not cast' END AS reason
  FROM events WHERE event_type IN ('view', 'error', 'click')) GROUP BY reason""")
def p17_record_rejects(spark, sf_dir):
    from voltlens.sources import api_json
    rec = api_json.read_records(spark, _land_api(spark, sf_dir), json_lines=True)
    _, bad = api_json.validate(rec, 2024, RUN_TS)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("s5_json_documents", """
SELECT CAST(count(*) FILTER (WHERE event_type NOT IN ('view', 'error', 'click')) AS BIGINT) AS accepted,
       CAST(count(*) FILTER (WHERE event_type IN ('view', 'error', 'click')) AS BIGINT) AS rejected,
       CAST(sum(event_id) FILTER (WHERE event_type NOT IN ('view', 'error', 'click')) AS BIGINT) AS odt_sum,
       CAST(1 AS BIGINT) AS not_json
FROM events""")
def s5_json_documents(spark, sf_dir):
    """The document layout: every landed file is one JSON object holding an array of
    records; one document is broken and is rejected as a whole."""
    from voltlens.operators.prefix import materialize
    from voltlens.sources import api_json
    lines = spark.read.text(_land_api(spark, sf_dir))
    n_docs = 1 + lines.count() // 500  # documents of about 500 records
    docs = lines.groupBy(F.pmod(F.xxhash64("value"), F.lit(n_docs)).alias("doc")).agg(
        F.concat(F.lit('{"anomalias": ['), F.array_join(F.collect_list("value"), ", "), F.lit("]}")).alias("value"))
    broken = lines.limit(1).select(F.lit(-1).cast("long").alias("doc"), F.lit('{"anomalias": [{"odt": 1').alias("value"))
    path = scratch_path(spark, "api-documents")
    # one document a file, all in one folder
    docs.union(broken).repartition("doc").select("value").write.option("maxRecordsPerFile", 1).text(path)
    # the files are opened and parsed once: both parts read the written records
    ok, bad = api_json.validate(materialize(api_json.read_records(spark, path)), 2024, RUN_TS)
    a = ok.agg(F.count(F.lit(1)).alias("accepted"), F.sum("odt").alias("odt_sum")).first()
    return bad.agg(F.count(F.when(F.col("reason") != "not JSON", 1)).alias("rejected"),
                   F.count(F.when(F.col("reason") == "not JSON", 1)).alias("not_json")).select(
        F.lit(a.accepted).cast("long").alias("accepted"), "rejected", F.lit(a.odt_sum).alias("odt_sum"), "not_json")


@register("c9_bad_lines", _API_SQL)
def c9_bad_lines(spark, sf_dir):
    """Malformed lines are rejected with their text and do not end the load."""
    from voltlens.plans.jobs import api_load_job
    path = _land_api(spark, sf_dir)
    spark.read.text(path).select(F.substring("value", 1, 9).alias("value")).write.mode("append").text(path + "-bad")
    spark.read.text(path + "-bad").write.mode("append").text(path)
    ok, bad = api_load_job(spark, path, 2024, RUN_TS, json_lines=True)
    assert bad.where("reason = 'not JSON'").limit(1).count() == 1
    return ok.select("odt", "orden", "LATI_USU", "LONG_USU", "NIVEL", "PLAN_COMERCIAL", "ZONA", "item_288",
                     "item_23", "Anomalia_conf", "año")


@register("st_api_stream", _API_SQL)
def st_api_stream(spark, sf_dir):
    from voltlens.streaming import api_stream
    landing = _land_api(spark, sf_dir)
    sink = scratch_path(spark, "api-stream-sink")
    q = api_stream.start(spark, landing, sink, scratch_path(spark, "api-stream-ckpt"), 2024, RUN_TS)
    q.awaitTermination()
    return spark.read.parquet(sink).select("odt", "orden", "LATI_USU", "LONG_USU", "NIVEL", "PLAN_COMERCIAL",
                                           "ZONA", "item_288", "item_23", "Anomalia_conf", "año")


@register("st_api_stream_state", f"SELECT odt, orden, CAST(1 AS BIGINT) AS times FROM (SELECT DISTINCT odt, orden FROM ({_API_SQL}))")
def st_api_stream_state(spark, sf_dir):
    """The records landed twice, read by two runs of the stream: every (odt, orden) is stored once."""
    from voltlens.streaming import api_stream
    landing = _land_api(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "api-state-sink"), scratch_path(spark, "api-state-ckpt")
    for _ in range(2):
        api_stream.start(spark, landing, sink, ckpt, 2024, RUN_TS, dedupe_window="30 days").awaitTermination()
        spark.read.text(landing).write.mode("append").text(landing + "-again")
        spark.read.text(landing + "-again").write.mode("append").text(landing)
    return spark.read.parquet(sink).groupBy("odt", "orden").agg(F.count(F.lit(1)).alias("times"))


def _gen_sql():
    p = 1000003
    part = lambda i: f"(((o_orderkey % {p}) * {7919 + 2 * (42 + i)} + {(42 + i) * 104729}) % {p})"
    below = lambda n, i: f"CAST(floor({part(i)} * {n} / {p}.0) AS BIGINT)"
    from voltlens.sources.api_json import GEN_ZONES
    zones = "[" + ", ".join(f"'{z}'" for z in GEN_ZONES) + "]"
    return (f'SELECT {below(90000, 0)} + 10000 AS odt, {below(900000, 1)} + 100000 AS orden, '
            f'{part(2)} * 2 / {p}.0::DOUBLE + 1 AS "LATI_USU", {part(3)} * 2 / {p}.0::DOUBLE - 78 AS "LONG_USU", '
            f'{zones}[{below(5, 5)} + 1] AS "ZONA", {below(9000, 8)} + 1000 AS item_288, '
            f'{below(2, 9)} = 0 AS item_68 FROM orders')


@register("s18_record_generator", _gen_sql())
def s18_record_generator(spark, sf_dir):
    from voltlens.sources.api_json import generate_records
    g = generate_records(A.read(spark, sf_dir, "orders"), "o_orderkey")
    return g.select("odt", "orden", "LATI_USU", "LONG_USU", "ZONA", "item_288", "item_68")


# ----------------------------------------------------------------------------- JDBC

def _derby(name):
    return f"jdbc:derby:memory:voltlens_{name};create=true"


@register("s9_jdbc_append_read", V("SELECT * FROM users", "users"))
def s9_jdbc_append_read(spark, sf_dir):
    from voltlens.sources import jdbc
    import uuid
    url, table = _derby(uuid.uuid4().hex[:8]), "USERS_T"
    u = A.users(spark, sf_dir)
    n = jdbc.append(u, url, table, batch_size=1000)
    assert n == u.count()
    back = jdbc.read_table(spark, url, table, partition_column="CLIENTE", num_partitions=4)
    return back.select(*u.columns)


@register("s9_staged_append", V("SELECT * FROM users", "users"))
def s9_staged_append(spark, sf_dir):
    """Three loads, the second with every row twice (tasks run again), the third a repeat: each id once."""
    from voltlens.sources import jdbc
    import uuid
    url, table = _derby(uuid.uuid4().hex[:8]), "USERS_ONCE"
    u = A.users(spark, sf_dir)
    first = jdbc.append_once(u.where(F.col("CLIENTE") % 3 == 0), url, table, "CLIENTE", "r1")
    second = jdbc.append_once(u.union(u), url, table, "CLIENTE", "r2")
    assert jdbc.append_once(u, url, table, "CLIENTE", "r2") == 0 and first + second == u.count()
    return jdbc.read_table(spark, url, table, partition_column="CLIENTE", num_partitions=4).select(*u.columns)


@register("s10_scored_rows_sink", V("""
SELECT "Orden" AS data_id, "kWh_Rec", '2024-05-06 07:08:09' AS fecha_carga FROM anomalies""", "anomalies"))
def s10_scored_rows_sink(spark, sf_dir):
    from voltlens.sources import jdbc
    import uuid
    url = _derby(uuid.uuid4().hex[:8])
    a = A.anomalies(spark, sf_dir).select(F.col("Orden").alias("id"), F.col("kWh_Rec").alias("kWh Rec"))
    rows = jdbc.prepare_scored_rows(a, RUN_TS)
    jdbc.append(rows, url, "SCORED_T")
    return jdbc.read_table(spark, url, "SCORED_T")


@register("l1_jdbc_limit_read", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def l1_jdbc_limit_read(spark, sf_dir):
    from voltlens.sources import jdbc
    import uuid
    url = _derby(uuid.uuid4().hex[:8])
    jdbc.append(A.read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), url, "ORDERS_T")
    return jdbc.limit_read(spark, url, "ORDERS_T", "o_orderkey", 1000)


# ----------------------------------------------------------------------------- file sinks

@register("s7_file_sink", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s7_file_sink(spark, sf_dir):
    path = scratch_path(spark, "s7")
    sinks.write_table(A.read(spark, sf_dir, "customer"), path)
    return spark.read.parquet(path)


@register("s8_snapshot_sink", "SELECT n_nationkey, n_name, n_regionkey, '2024-05-06 07:08:09' AS run_ts FROM nation")
def s8_snapshot_sink(spark, sf_dir):
    path = scratch_path(spark, "s8")
    sinks.write_snapshot(A.read(spark, sf_dir, "nation"), path, RUN_TS)
    return spark.read.parquet(path).withColumn("run_ts", F.col("run_ts").cast("string"))


@register("s11_warehouse_load", V("""
SELECT a."Usuario", a."Ejecucion", u."AREA", u."PLAN_COMERCIAL", 'Cod ' || a."Motivo" AS "Nombre", a."kWh_Rec",
       CAST(CAST(a."Orden" % 3 AS BIGINT) AS VARCHAR) AS "Cluster", CAST(NULL AS BIGINT) AS puntaje,
       CAST(NULL AS DOUBLE) AS puntaje_1, CAST(NULL AS DOUBLE) AS puntaje_2, CAST(NULL AS DOUBLE) AS puntaje_3,
       CAST(NULL AS DOUBLE) AS puntaje_4, CAST(NULL AS DOUBLE) AS puntaje_5, u."LATI_USU", u."LONG_USU", u."ZONA"
FROM anomalies a JOIN users u ON a."Usuario" = u."PRODUCTO" """, "anomalies", "users"))
def s11_warehouse_load(spark, sf_dir):
    from voltlens.plans.jobs import publish_job
    a = A.anomalies(spark, sf_dir)
    u = A.users(spark, sf_dir).select("PRODUCTO", "AREA", "PLAN_COMERCIAL", "LATI_USU", "LONG_USU", "ZONA")
    src = a.join(u, a["Usuario"] == u["PRODUCTO"]).select(
        "Usuario", F.col("Ejecucion").cast("string").alias("Ejecucion"), "AREA", "PLAN_COMERCIAL",
        F.concat(F.lit("Cod "), F.col("Motivo")).alias("Nombre"), F.col("kWh_Rec").alias("kWh Rec"),
        (F.col("Orden") % 3).alias("cluster_id"), "LATI_USU", "LONG_USU", "ZONA")
    path = scratch_path(spark, "s11")
    n = publish_job(src, path)
    assert n >= 0
    return spark.read.parquet(path)


@register("s12_dictionary_sink", V("""
SELECT 'AREA' AS "column", CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code, v AS label
FROM (SELECT DISTINCT "AREA" AS v FROM users WHERE "AREA" IS NOT NULL)""", "users"))
def s12_dictionary_sink(spark, sf_dir):
    from voltlens.operators.features import label_codes
    d = label_codes(A.users(spark, sf_dir), "AREA").select(F.lit("AREA").alias("column"), "code",
                                                           F.col("AREA").alias("label"))
    path = scratch_path(spark, "s12")
    sinks.write_dictionary(spark, d, path)
    return sinks.read_dictionary(spark, path)


@register("s13_duplicate_report", """
SELECT l_orderkey, l_linenumber, l_quantity FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
  FROM lineitem) WHERE n > 1""")
def s13_duplicate_report(spark, sf_dir):
    li = A.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    path = scratch_path(spark, "s13")
    n = sinks.write_duplicates(li, ["l_orderkey", "l_linenumber"], path, fmt="parquet")
    return spark.read.parquet(path) if n else li.where("false")


@register("s14_reject_sink", V("""
SELECT "CLIENTE", "ZONA", "LATI_USU" FROM users WHERE "ZONA" IS NULL OR "LATI_USU" IS NULL""", "users"))
def s14_reject_sink(spark, sf_dir):
    u = A.users(spark, sf_dir).select("CLIENTE", "ZONA", "LATI_USU")
    good, bad = scratch_path(spark, "s14-good"), scratch_path(spark, "s14-bad")
    sinks.split_rejects(u, ["ZONA", "LATI_USU"], good, bad)
    return spark.read.parquet(bad)


def _k9_sql():
    from voltlens.plans.q_model import _PC_BODY, _PC_CTE, _sql
    return _sql(_PC_BODY, _PC_CTE)


@register("s17_metrics_sink", _k9_sql())
def s17_metrics_sink(spark, sf_dir):
    from voltlens.plans.q_model import k9_partition_scores
    path = scratch_path(spark, "s17")
    sinks.write_metrics(k9_partition_scores(spark, sf_dir), path)
    return spark.read.schema("ZONA STRING, PC DOUBLE, PEC DOUBLE").option("header", True).csv(path)


def _k7_sql():
    from voltlens.plans.q_model import D, _sql
    return _sql('SELECT "ZONA", CAST(cluster AS BIGINT) AS cluster, ' + ", ".join(f"x{j}" for j in range(D))
                + " FROM CL")


@register("s15_zone_model_store", _k7_sql())
def s15_zone_model_store(spark, sf_dir):
    from voltlens.plans.q_model import _train
    from voltlens.sources import model_store
    _, prep, model, _ = _train(spark, sf_dir)
    path = scratch_path(spark, "s15")
    model_store.save_zone_models(spark, prep, model, path)
    _, loaded = model_store.load_zone_models(spark, path)
    return loaded.centres_long(spark)


# The sink's defaults, written out for the SQL twin: items that become NOAPL, NO INDICA, NO.
_C8_DEFAULTS = {**{f"item_{i}": "'NOAPL'" for i in (597, 598, 599, 601, 602, 603)},
                **{f"item_{i}": "'NO INDICA'" for i in (33, 35, 43, 108, 248)},
                **{f"item_{i}": "'NO'" for i in (23, 24)}, **{f"item_{i}": "false" for i in (68, 74, 237)},
                "reincidente": "'NO'", "Anomalia_conf": "'Anomalia'", "NIVEL": "0.0"}


def _c8_sql():
    from voltlens.plans.jobs import ANOMALIA_SCHEMA
    from voltlens.plans.q_clean import _C2_SQL, CLEAN_KEEP_PRESENT
    cols = []
    for f in ANOMALIA_SCHEMA.fields:
        if f.name == "id":
            cols.append("substr(sha256(concat_ws(chr(1), CAST(odt AS VARCHAR), CAST(orden AS VARCHAR), "
                        "CAST(item_288 AS VARCHAR))), 1, 32) AS id")
        elif f.name == "fecha_creacion":
            cols.append(f"'{RUN_TS}' AS fecha_creacion")
        else:
            t = {"StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "DoubleType()": "DOUBLE",
                 "LongType()": "BIGINT"}[repr(f.dataType)]
            got = f'"{f.name}"' if f.name in CLEAN_KEEP_PRESENT else "NULL"
            cols.append(f'CAST(COALESCE({got}, {_C8_DEFAULTS.get(f.name, "NULL")}) AS {t}) AS "{f.name}"')
    body = _C2_SQL.strip()
    required = " AND ".join(f'"{c}" IS NOT NULL' for c in ("item_288", "odt", "orden", "PLAN_COMERCIAL", "ZONA", "año",
                                                            "LATI_USU", "LONG_USU"))
    return V("WITH c2 AS (" + body + "), c8 AS (SELECT " + ", ".join(cols) + f" FROM c2) SELECT * FROM c8 WHERE {required}",
             "anomalies", "users", "plain", "uid_conversion")


@register("c8_load_job", _c8_sql())
def c8_load_job(spark, sf_dir):
    from voltlens.plans.jobs import load_job
    from voltlens.plans.q_clean import c2_clean
    from voltlens.sources import jdbc
    import uuid
    url = _derby(uuid.uuid4().hex[:8])
    n = load_job(c2_clean(spark, sf_dir), url, "ANOMALIA_DATA", RUN_TS)
    assert n >= 0
    return jdbc.read_table(spark, url, "ANOMALIA_DATA")

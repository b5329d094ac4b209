"""API ingest (S5, P17, F23, C9 core): ``{"anomalias": [ {...}, ... ]}``.

Each record is parsed into a VARIANT, so presence of a key, a JSON null and a
value that does not cast are all distinguishable without Python code:
records missing a required field are skipped; LATI_USU / LONG_USU / NIVEL /
odt / orden that do not cast are skipped (Python ``float()`` / ``int()``
semantics: 4.7 -> 4, "12.0" -> rejected); absent optional fields get their
defaults while a present NULL stays NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlens.functions.schema import q

# Fields that a record must have.
REQUIRED = ["odt", "orden", "LATI_USU", "LONG_USU", "PLAN_COMERCIAL", "ZONA"]

# Defaults applied to absent API fields.
DEFAULTS = {
    "Anomalia_conf": "Anomalia", "reincidente": "NO", "item_68": False, "item_74": False, "item_237": False,
    "item_248": "NO INDICA", "item_597": "NOAPL", "item_602": "NOAPL", "item_108": "NO INDICA",
    "item_43": "NO INDICA", "item_603": "NOAPL", "item_599": "NOAPL", "item_35": "NO INDICA",
    "item_598": "NOAPL", "item_33": "NO INDICA", "item_601": "NOAPL", "item_24": "NO", "item_23": "NO",
    "NIVEL": 0.0,
}

# Target fields and their SQL types (others in a record are dropped: P15)
FIELDS = {
    "odt": "bigint", "orden": "bigint", "item_288": "bigint", "LATI_USU": "double", "LONG_USU": "double",
    "NIVEL": "double", "PLAN_COMERCIAL": "string", "ZONA": "string", "AREA": "string", "Descripcion": "string",
    "reincidente": "string", "Anomalia_conf": "string", "año": "bigint", "item_68": "boolean",
    "item_74": "boolean", "item_237": "boolean", "item_248": "string", "item_597": "string",
    "item_602": "string", "item_108": "string", "item_43": "string", "item_603": "string", "item_599": "string",
    "item_35": "string", "item_598": "string", "item_33": "string", "item_601": "string", "item_24": "string",
    "item_23": "string",
}
# Fields whose value must cast.
STRICT = ["LATI_USU", "LONG_USU", "NIVEL", "odt", "orden", "item_288"]


def read_records(spark: SparkSession, path: str, json_lines: bool = False, key: str = "anomalias") -> DataFrame:
    """One row per record: VARIANT ``r`` and its text ``raw``. ``r`` is NULL where the text
    is not JSON (``validate`` rejects it). Files without ``key`` contribute
    nothing. ``json_lines`` reads one record per line (splittable, the layout
    to land at scale); otherwise each file is one JSON document, and a document
    that is not JSON becomes one row to reject."""
    if json_lines:
        return parse_lines(spark.read.text(path))
    docs = (spark.read.schema(f"{key} ARRAY<STRING>, _vl_bad STRING").option("multiLine", True)
                 .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_vl_bad").json(path))
    bad = F.col("_vl_bad").isNotNull()
    texts = F.when(bad, F.array("_vl_bad")).otherwise(F.col(key))
    # parsed where the rows are made: a filter on the record's fields cannot repeat the parsing for each of them
    return docs.select(F.inline(F.transform(texts, lambda t: F.struct(
        F.when(~bad, F.try_parse_json(t)).alias("r"), t.alias("raw")))))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Text lines (column ``value``) as (r, raw); empty lines are skipped."""
    one = F.array(F.struct(F.try_parse_json("value").alias("r"), F.col("value").alias("raw")))
    return lines.where(F.trim("value") != "").select(F.inline(one))  # parsed once a line, as in read_records


def _present(name: str) -> Column:
    return F.expr(f"variant_get(r, '$.{name}', 'variant') IS NOT NULL")


def _value(name: str, sql_type: str) -> Column:
    return F.expr(f"try_variant_get(r, '$.{name}', '{sql_type}')")


def validate(records: DataFrame, run_year: int, run_ts: str, carry=()) -> tuple[DataFrame, DataFrame]:
    """P17 + F23: (accepted typed rows, rejected raw records with a reason). ``carry``: columns of the
    records that accepted rows keep."""
    ok_req = None
    for f in REQUIRED:
        c = _present(f)
        ok_req = c if ok_req is None else ok_req & c
    cols = {}
    for name, t in FIELDS.items():
        v = _value(name, t)
        if name in DEFAULTS:
            v = F.when(_present(name), v).otherwise(F.lit(DEFAULTS[name]).cast(t))
        cols[name] = v
    cols["año"] = F.when(_present("año"), _value("año", "bigint")).otherwise(F.lit(run_year).cast("bigint"))
    cols["item_288"] = F.when(_present("item_288"), _value("item_288", "bigint")).otherwise(F.lit(0).cast("bigint"))
    cols["fecha_creacion"] = F.lit(run_ts)
    raw = F.col("raw") if "raw" in records.columns else F.lit(None).cast("string")
    typed = records.select("r", raw.alias("_raw"), ok_req.alias("_req"), *[v.alias(k) for k, v in cols.items()],
                           *carry)
    cast_ok = None
    for f in STRICT:
        c = F.col(f).isNotNull()
        cast_ok = c if cast_ok is None else cast_ok & c
    reason = (F.when(F.col("r").isNull(), F.lit("not JSON")).when(~F.col("_req"), F.lit("missing required field"))
               .when(~cast_ok, F.lit("value does not cast")))
    typed = typed.withColumn("_reason", reason)
    accepted = typed.where(F.col("_reason").isNull()).drop("r", "_raw", "_req", "_reason")
    rejected = typed.where(F.col("_reason").isNotNull()).select(F.coalesce("_raw", F.to_json("r")).alias("record"),
                                                                F.col("_reason").alias("reason"))
    return accepted, rejected


# The generator's pools.
GEN_ZONES = ["ZONA_NORTE", "ZONA_SUR", "ZONA_ESTE", "ZONA_OESTE", "ZONA_CENTRO"]
GEN_PLANS = ["PLAN_A", "PLAN_B", "PLAN_C", "PLAN_D"]
GEN_TEXTS = ["Anomalía en consumo", "Conexión irregular", "Medidor manipulado", "Desconexión no autorizada",
             "Posible fraude"]
_PRIME = 1_000_003


def generate_records(keys: DataFrame, key_col: str, seed: int = 42) -> DataFrame:
    """One synthetic API record for every row of a table, repeatable from its key.

    A field's position in its range is ``((key mod p) * (7919 + 2 s) + s * 104729) mod p`` over
    p, where s is the seed plus the field's number. Ranges follow the reference
    generator: odt 10000-99999, orden 100000-999999, latitude 1-3, longitude -78..-76,
    level 1.0-5.0.
    """
    def part(i):
        s = seed + i
        return F.pmod(F.pmod(F.col(q(key_col)).cast("long"), F.lit(_PRIME)) * (7919 + 2 * s) + s * 104729, F.lit(_PRIME))

    def below(n, i):
        return F.floor(part(i) * n / _PRIME)

    def pick(values, i):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (below(len(values), i) + 1).cast("int"))

    return keys.select(
        (below(90000, 0) + 10000).alias("odt"), (below(900000, 1) + 100000).alias("orden"),
        (part(2) * 2 / _PRIME + 1).alias("LATI_USU"), (part(3) * 2 / _PRIME - 78).alias("LONG_USU"),
        F.round(part(4) * 4 / _PRIME + 1, 1).alias("NIVEL"),
        pick(GEN_ZONES, 5).alias("ZONA"), pick(GEN_PLANS, 6).alias("PLAN_COMERCIAL"),
        pick(GEN_TEXTS, 7).alias("Descripcion"), (below(9000, 8) + 1000).alias("item_288"),
        *[(below(2, 9 + i) == 0).alias(f"item_{n}") for i, n in enumerate((68, 74, 237))],
        *[F.when(below(2, 12 + i) == 0, "SI").otherwise("NO").alias(f"item_{n}") for i, n in enumerate((23, 24))],
    )


def write_landing(df: DataFrame, path: str) -> None:
    """Land records as JSON lines (one record per line)."""
    df.write.mode("overwrite").json(path)

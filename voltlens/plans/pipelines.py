"""Composite jobs (C1-C4): lazy DataFrame functions, nothing collected."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlens.functions.casts import apply_type_map, null_tokens_to_null, nullable_long
from voltlens.functions.scalars import explode_codes, year_of
from voltlens.functions.schema import q, require_columns, select_existing
from voltlens.operators import dedupe, eav, joins

log = logging.getLogger(__name__)

# Columns of the source tables and of the training set.
ANOMALY_COLS = ["Orden", "Usuario", "Ejecucion", "Codigo", "Descripcion", "Motivo", "kWh_Rec"]
SEVERITY_COLS = ["Item", "id", "Nombre", "puntaje"]
USER_COLS = ["CLIENTE", "PRODUCTO", "AREA", "PLAN_COMERCIAL", "TRAFO_OPEN", "FASES", "KVA", "CATEGORIA",
             "SUB_CATEGORIA", "ZONA", "LATI_USU", "LONG_USU", "LATI_TRAFO", "LONG_TRAFO"]
TRAIN_COLS = ["Orden", "Usuario", "Ejecucion", "Codigo", "Descripcion", "Motivo", "kWh_Rec", "id", "Nombre",
              "TRAFO_OPEN", "FASES", "KVA", "AREA", "PLAN_COMERCIAL", "LATI_USU", "LONG_USU", "LATI_TRAFO",
              "LONG_TRAFO", "ZONA", "CATEGORIA", "SUB_CATEGORIA", "puntaje"]


def expand_codes(anomalies: DataFrame, code_col: str = "Codigo") -> DataFrame:
    """one row per trimmed code."""
    return anomalies.withColumn(code_col, explode_codes(code_col))


def with_severity(expanded: DataFrame, severity: DataFrame, code_col: str = "Codigo",
                  null_keys_match: bool = False) -> DataFrame:
    """Exploded codes LEFT JOIN the code -> severity dimension."""
    sev = severity.select(*SEVERITY_COLS)
    return joins.join_renamed(expanded, sev, code_col, "Item", "left", null_keys_match=null_keys_match)


def merge_and_clean(anomalies: DataFrame, users: DataFrame, severity: DataFrame,
                    null_keys_match: bool = False) -> DataFrame:
    """Training set. explode codes -> severity -> users (left) -> project ->
    distinct -> drop rows without zone."""
    a = expand_codes(anomalies.select(*[q(c) for c in ANOMALY_COLS]))
    u = users.select(*[q(c) for c in USER_COLS if c == "PRODUCTO" or c in TRAIN_COLS])
    a, s, u = _distinct_sides(a, severity.select(*SEVERITY_COLS), u, null_keys_match)
    a = with_severity(a, s, null_keys_match=null_keys_match)
    j = joins.join_renamed(a, u, "Usuario", "PRODUCTO", "left", drop_right_key=False,
                           null_keys_match=null_keys_match)
    out = j.select(*[q(c) for c in TRAIN_COLS])
    return (dedupe.distinct_spread(out) if null_keys_match else out).na.drop(subset=["ZONA"])


def _distinct_sides(a: DataFrame, s: DataFrame, u: DataFrame, null_keys_match: bool):
    """The sides of the dataset joins without repeats. A joined row names all columns of its three rows (the dropped
    keys equal kept ones), and a row joins to nothing or to something, never both: joins of distinct sides
    are distinct, and the narrow sides are compared in place of the wide result. With ``null_keys_match`` the
    sides stay whole, since their NULL keys are counted before the join."""
    return (a, s, u) if null_keys_match else tuple(dedupe.distinct_spread(x) for x in (a, s, u))


def inference_dataset(anomalies: DataFrame, users: DataFrame, severity: DataFrame,
                      null_keys_match: bool = False) -> DataFrame:
    """C4: every user kept (right join), all user columns, distinct, zone present."""
    a = expand_codes(anomalies.select(*[q(c) for c in ANOMALY_COLS]))
    a, s, u = _distinct_sides(a, severity.select(*SEVERITY_COLS), users, null_keys_match)
    a = with_severity(a, s, null_keys_match=null_keys_match)
    j = joins.join_renamed(a, u, "Usuario", "PRODUCTO", "right", drop_right_key=False,
                           null_keys_match=null_keys_match)
    return (dedupe.distinct_spread(j) if null_keys_match else j).na.drop(subset=["ZONA"])


# --------------------------------------------------------------------------- C1

# The inspection items of the yearly dataset and their types.
ITEM_TYPES = {
    1442: "double", 8: "string", 237: "string", 23: "string", 24: "string", 33: "double", 598: "string",
    601: "string", 43: "double", 99: "double", 35: "string", 111: "double", 599: "string", 108: "double",
    603: "string", 190: "double", 192: "string", 588: "double", 248: "string", 591: "double", 602: "string",
    41: "double", 211: "double", 74: "string", 1889: "double", 597: "string", 600: "string", 37: "double",
    1407: "string", 1410: "string", 68: "string", 1328: "double", 1334: "string", 594: "string", 67: "string",
    1408: "string", 1352: "double", 1405: "string", 1283: "double", 1343: "double", 1346: "double",
    1292: "double", 1298: "double", 69: "string", 1331: "string", 202: "double", 1349: "double",
}

# Columns of the yearly dataset before its items.
BASE_COLUMNS = ["item_288", "PLAN_COMERCIAL", "NIVEL", "LATI_USU", "LONG_USU", "AREA", "ZONA",
                "Descripcion", "odt", "orden"]


def yearly_anomalies(anomalies: DataFrame, target_year: int, year_col: str = "año",
                     date_col: str = "Ejecucion", constant_year: bool = False) -> DataFrame:
    """Anomalies of one year with unrevised duplicates removed (P7 + P12).

    D2: without a year column the year is derived from the execution date
    (F14); ``constant_year`` reproduces stamping every row with the target year.
    """
    if year_col not in anomalies.columns:
        yr = F.lit(target_year).cast("long") if constant_year else year_of(date_col)
        anomalies = anomalies.withColumn(year_col, yr)
    a = anomalies.where(F.col(q(year_col)) == F.lit(target_year))
    if "Revision" in a.columns:
        a = dedupe.drop_unrevised_duplicates(a, "Orden", "Revision")
    return a.select("Orden", "Descripcion")


def process_data(anomalies: DataFrame, users: DataFrame, plain: DataFrame, uid_conversion: DataFrame,
                 target_year: int, item_ids=tuple(ITEM_TYPES), item_types: dict[str, str] | None = None,
                 zone_item: int = 1, customer_item: int = 288, order_col: str = "_ord",
                 constant_year: bool = False, keep_order: bool = False) -> DataFrame:
    """Yearly dataset. With ``keep_order`` the zone rows' ingest ordinal stays, so that the
    cleaning can keep the first row in file order.

    zone rows of the EAV table -> customer number (J5, first value per work
    order, non-numeric dropped) -> users (J1, inner) -> id translation (J2,
    inner) -> year's anomalies (J3, left) -> items widened (J9, one pivot) ->
    type map (F11) -> year column (F15).
    """
    require_columns(users, ["PRODUCTO", "AREA", "PLAN_COMERCIAL", "NIVEL", "LATI_USU", "LONG_USU", "ZONA"])
    require_columns(uid_conversion, ["uid", "orden"])
    zones = plain.where(F.col("id") == F.lit(zone_item)).select("odt", *([order_col] if keep_order else []))
    z = eav.lookup_join(zones, plain, customer_item, "item_288", order_col=order_col)
    z = z.withColumn("item_288", nullable_long("item_288")).where(F.col("item_288").isNotNull())

    u = users.select("PRODUCTO", "AREA", "PLAN_COMERCIAL", "NIVEL", "LATI_USU", "LONG_USU", "ZONA")
    u = joins.coerce_key(u, "PRODUCTO")
    zu = joins.join_renamed(z, u, "item_288", "PRODUCTO", "inner")

    zuid = joins.translate_ids(zu, uid_conversion.select("uid", "orden"), "odt", "uid")
    zuid = joins.coerce_key(zuid, "orden")

    an = yearly_anomalies(anomalies, target_year, constant_year=constant_year)
    an = joins.coerce_key(an, "Orden")
    m = joins.join_renamed(zuid, an, "orden", "Orden", "left")

    base = select_existing(m, [*BASE_COLUMNS, *([order_col] if keep_order else [])])
    wide = eav.widen_join(base, plain, item_ids, order_col=order_col)
    wide = wide.withColumn("Descripcion", null_tokens_to_null("Descripcion"))
    if item_types is None:
        item_types = {f"item_{i}": ITEM_TYPES[i] for i in item_ids if i in ITEM_TYPES}
    typed = apply_type_map(wide, item_types)
    return typed.withColumn("año", F.lit(target_year).cast("long"))


# --------------------------------------------------------------------------- C2

# The cleaning defaults of the yearly dataset.
BOOLEAN_COLUMNS = ["item_237", "item_74", "item_68"]
CATEGORICAL_DEFAULTS = {
    "item_601": "NOAPL", "item_33": "NO INDICA", "item_598": "NOAPL", "item_35": "NO INDICA",
    "item_599": "NOAPL", "item_603": "NOAPL", "item_43": "NO INDICA", "item_108": "NO INDICA",
    "item_602": "NOAPL", "item_597": "NOAPL", "item_248": "NO INDICA",
}
BINARY_COLUMNS = {"item_23": {None: "NO", "TRUE": "SI", "FALSE": "NO"},
                  "item_24": {None: "NO", "TRUE": "SI", "FALSE": "NO"}}
CLEAN_KEEP = ["AREA", "item_288", "odt", "orden", "PLAN_COMERCIAL", "Descripcion", "reincidente",
              "Anomalia_conf", "ZONA", "año", "LATI_USU", "LONG_USU", "NIVEL", "item_68", "item_74", "item_237",
              "item_248", "item_597", "item_602", "item_108", "item_43", "item_603", "item_599", "item_35",
              "item_598", "item_33", "item_601", "item_24", "item_23"]


def clean(df: DataFrame, order_col: str | None = None, dedupe_keys=("orden", "odt"),
          coordinate_cols=("LATI_USU",), boolean_cols=BOOLEAN_COLUMNS,
          categorical_defaults=CATEGORICAL_DEFAULTS, binary_cols=BINARY_COLUMNS,
          recurrence_key: str = "item_288", columns_to_keep=CLEAN_KEEP,
          fill_null_description: str | None = "Solo odt") -> DataFrame:
    """Keep-first on (orden, odt), by the ingest ordinal where there is one -> drop NULL coordinates -> booleans
    (NULL -> false, TRUE/SI/FALSE/NO parsed, other text NULL: D4) -> text
    defaults (D6: cast to text first) -> SI/NO indicators (D5) -> recurrence
    flag -> anomaly label (D3: NULL description filled first unless
    ``fill_null_description`` is None) -> tolerant projection.
    """
    from voltlens.functions.casts import parse_bool
    from voltlens.functions.scalars import anomaly_label, fill_default, replace_values
    from voltlens.operators.profile import drop_nulls

    keys = [k for k in dedupe_keys if k in df.columns]
    df = dedupe.keep_first(df, keys, order_col, keep_order=False, unique=False)
    df = drop_nulls(df, [c for c in coordinate_cols if c in df.columns])
    cols = {}
    for c in boolean_cols:
        if c in df.columns:
            cols[c] = F.coalesce(parse_bool(c), F.lit(False))
    for c, v in categorical_defaults.items():
        if c in df.columns:
            cols[c] = fill_default(c, v)
    for c, m in binary_cols.items():
        if c in df.columns:
            cols[c] = replace_values(F.col(q(c)).cast("string"), m)
    if cols:
        df = df.withColumns(cols)
    if recurrence_key in df.columns:
        # the recurrence count reads the cleaned rows a second time: write them
        # once (reliable checkpoint) instead of recomputing the whole build
        from voltlens.operators.prefix import materialize

        df = dedupe.recurrence_flag(materialize(df), recurrence_key)
    if "Descripcion" in df.columns:
        d = F.col("Descripcion")
        if fill_null_description is not None:
            d = F.coalesce(d, F.lit(fill_null_description))
        df = df.withColumn("Anomalia_conf", anomaly_label(d))
    keep = list(columns_to_keep or df.columns)
    if "año" in df.columns and "año" not in keep:
        keep.append("año")
    return select_existing(df, keep)


# --------------------------------------------------------------------------- clustering (C5, part 1)

# The zone models' feature columns.
CLUSTER_NUM = ["LATI_USU", "LONG_USU"]
CLUSTER_CAT = ["TRAFO_OPEN", "AREA", "PLAN_COMERCIAL", "SUB_CATEGORIA"]


def cluster_fit_rows(df: DataFrame, zone_col: str = "ZONA", num=CLUSTER_NUM, cat=CLUSTER_CAT) -> DataFrame:
    """Rows a zone model is fitted on: zone present, distinct by features."""
    return df.where(F.col(q(zone_col)).isNotNull()).select(zone_col, *num, *cat).distinct()


def train_zones(df: DataFrame, zone_col: str = "ZONA", num=CLUSTER_NUM, cat=CLUSTER_CAT, K: int = 3,
                m: float = 2.0, max_iter: int = 150, tol: float = 1e-5, init=None, seed: int = 42):
    """Preprocessing and fuzzy c-means for every zone in one pass
    per iteration. Returns (prep, model, fit_features)."""
    from voltlens.operators import fcm
    from voltlens.operators.features import fit_zone_prep, transform_zone_prep

    rows = cluster_fit_rows(df, zone_col, num, cat).persist()
    prep = fit_zone_prep(rows, zone_col, num, cat)
    feats = transform_zone_prep(rows, prep)
    d = len(num) + len(cat)
    model = fcm.fit(feats, zone_col, d, K=K, m=m, max_iter=max_iter, tol=tol,
                    init=init(feats) if callable(init) else init, seed=seed)
    rows.unpersist()
    return prep, model, feats


def predict_zones(df: DataFrame, prep, model) -> DataFrame:
    """C6 part / K8 / J10: cluster memberships for every row of a modelled zone."""
    from voltlens.operators import fcm
    from voltlens.operators.features import transform_zone_prep

    return fcm.predict(transform_zone_prep(df, prep), model)

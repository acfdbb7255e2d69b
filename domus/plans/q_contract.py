"""Queries: projection, coercion and the declarative contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.functions.numeric import py_round_sql
from domus.operators import contract as K
from domus.plans import q_training  # noqa: F401  (registers batch_score first)
from domus.plans.catalog import ORACLE, register
from domus.sources.panel import panel, panel_sql
from domus.sources.snapshots import coercion_failures, project_contract

# Value sets and bounds for the panel stand-in (the listing sets apply to real snapshots).
# Tighter than the data on purpose so every rule kind has violations to count.
PANEL_SETS = dict(
    cities=tuple(f"NATION_{i}" for i in range(20)),
    property_types=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"),
    ownerships=("A", "N", "R"),
    materials=("F", "O"),
    conditions=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"),
    area=(25.0, 120.0),
    as_of=dt.date(1999, 12, 31),
)


def panel_contract(record: bool = True) -> K.Contract:
    return K.listing_contract(**PANEL_SETS, record=record)


def panel_request_contract() -> K.Contract:
    return K.request_contract(**PANEL_SETS)


def _rules(kind: str | None = None) -> list[K.RuleSpec]:
    rules = panel_contract().rules()
    return [r for r in rules if kind is None or r.kind == kind]


def _report_sql(kind: str | None = None) -> str:
    return panel_sql() + "\n" + K.report_sql("panel", _rules(kind))


def _report(spark: SparkSession, sf: str, kind: str | None = None) -> DataFrame:
    return K.validate_report(panel(spark, sf), _rules(kind))


# --- B1 -------------------------------------------------------------------
@register("project_contract", panel_sql() + "\nSELECT " + ", ".join(C.LISTING_COLUMNS) + " FROM panel")
def q_project_contract(spark: SparkSession, sf: str) -> DataFrame:
    """B1: the 29 contract columns in order, for every panel row."""
    return project_contract(panel(spark, sf))


# --- B2 (rows) --------------------------------------------------------------
@register("check_columns", panel_sql() + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{'extra' if c == 'uid' else 'ok'}' AS status, count({c}) AS n_values FROM panel"
    for c in (*C.LISTING_COLUMNS, "uid")))
def q_check_columns(spark: SparkSession, sf: str) -> DataFrame:
    """B2: strict column check of the panel (with its extra ``uid``) against the contract, with the number of values
    that each column holds."""
    df = panel(spark, sf)
    missing, extra = panel_contract().check_columns(df)
    status = {c: "extra" if c in extra else "ok" for c in df.columns} | {c: "missing" for c in missing}
    present = [c for c in status if c not in missing]
    filled = df.agg(*[F.count(c).alias(c) for c in present]).unpivot([], present, "column", "n_values")
    names = spark.createDataFrame(list(status.items()), "column string, status string")
    return names.join(filled, "column", "left")


# --- B3 -------------------------------------------------------------------
def _raw_text_sql() -> str:
    casts = []
    for c in C.LISTING_COLUMNS:
        if c == "floor":
            casts.append("coalesce(CAST(floor AS VARCHAR), property_type) AS floor")
        elif c == "build_year":
            casts.append("coalesce(CAST(build_year AS VARCHAR), building_material) AS build_year")
        elif c in C.BOOL_FEATURES:
            continue
        else:
            casts.append(f"CAST({c} AS VARCHAR) AS {c}")
    return ", ".join(casts)


_B3_TYPES = {"square_meters": "DOUBLE", "rooms": "BIGINT", "floor": "BIGINT", "floor_count": "BIGINT",
             "build_year": "BIGINT", "latitude": "DOUBLE", "longitude": "DOUBLE",
             "centre_distance_km": "DOUBLE", "poi_count": "BIGINT",
             **{c: "DOUBLE" for c in C.DISTANCE_COLUMNS}, "price_pln": "BIGINT"}


@register("coerce_types", panel_sql() + f",\nrawtxt AS (SELECT {_raw_text_sql()} FROM panel)\n"
          + "\nUNION ALL ".join(
              f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL "
              f"THEN 1 ELSE 0 END) AS BIGINT) AS n_failed FROM rawtxt" for c, t in _B3_TYPES.items()))
def q_coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    """Per column, text values that do not cast to the contract type.

    Input: the panel with every column as text; ``floor``/``build_year`` carry a category
    word where the number is missing, so there is something to reject.
    """
    p = panel(spark, sf)
    txt = {c: F.col(c).cast("string") for c in C.LISTING_COLUMNS if c not in C.BOOL_FEATURES}
    txt["floor"] = F.coalesce(F.col("floor").cast("string"), F.col("property_type"))
    txt["build_year"] = F.coalesce(F.col("build_year").cast("string"), F.col("building_material"))
    raw = p.select(*[v.alias(k) for k, v in txt.items()])
    cols = list(_B3_TYPES)
    wide = raw.agg(*coercion_failures(raw, cols))
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (`column`, n_failed)")


# --- B4–B9 -------------------------------------------------------------------
@register("check_not_null", _report_sql("not_null"))
def q_check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Null counts of the non-nullable contract columns."""
    return _report(spark, sf, "not_null")


@register("check_range", _report_sql("range"))
def q_check_range(spark: SparkSession, sf: str) -> DataFrame:
    """Inclusive bound violations (nulls pass)."""
    return _report(spark, sf, "range")


@register("check_isin", _report_sql("isin"))
def q_check_isin(spark: SparkSession, sf: str) -> DataFrame:
    """Closed value-set violations (nulls pass)."""
    return _report(spark, sf, "isin")


@register("check_build_year_not_future", _report_sql("not_future"))
def q_check_build_year_not_future(spark: SparkSession, sf: str) -> DataFrame:
    """Build years after the as-of year (injected: 1999)."""
    return _report(spark, sf, "not_future")


@register("check_trimmed_text", _report_sql("trimmed_text"))
def q_check_trimmed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers whose trimmed length is outside 1..120."""
    return _report(spark, sf, "trimmed_text")


@register("validate_report", _report_sql())
def q_validate_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule of the panel contract, counted in one pass, long form."""
    return _report(spark, sf)


# --- B12 ------------------------------------------------------------------
@register("split_valid_rejected", panel_sql() + f"""
SELECT uid, {K.reasons_sql(_rules())} AS reject_reason FROM panel""")
def q_split_valid_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Every row with its violated rules ('' for valid rows), one pass."""
    tagged = K.tag_rejects(panel(spark, sf), _rules())
    return tagged.select("uid", F.array_join("reject_reason", ",").alias("reject_reason"))


# --- B10 ------------------------------------------------------------------
def _request_rules() -> list[K.RuleSpec]:
    return panel_request_contract().rules()


@register("request_contract", panel_sql() + f"""
SELECT uid, {K.reasons_sql(_request_rules())} AS reject_reason FROM panel""")
def q_request_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Panel rows as scoring requests (26 fields), checked row by row."""
    p = panel(spark, sf)
    req = K.conform_requests(p.drop("id", "price_pln", "snapshot_month", "uid"))
    # conform_requests drops nothing it needs; re-attach the key for the report
    keyed = p.select("uid", *[F.col(c) for c in req.columns])
    return keyed.select("uid", F.array_join(K.reasons_expr(_request_rules()), ",").alias("reject_reason"))


# --- B11 ------------------------------------------------------------------
@register("result_contract", "WITH res AS (" + ORACLE["batch_score"] + ")\n"
          + K.report_sql("res", K.result_rules()))
def q_result_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Result rules over every scored panel row (price > 0, bounds >= 0, names set)."""
    from domus.plans.q_training import q_batch_score

    return K.validate_report(q_batch_score(spark, sf), K.result_rules())


# --- B13 ------------------------------------------------------------------
@register("derive_price_per_sqm", panel_sql() + f"""
SELECT uid, {py_round_sql("CAST(price_pln AS DOUBLE) / square_meters", 2)} AS price_per_sqm FROM panel""")
def q_derive_price_per_sqm(spark: SparkSession, sf: str) -> DataFrame:
    """Price per square metre, rounded to 2 places."""
    return panel(spark, sf).select("uid", K.price_per_sqm().alias("price_per_sqm"))


# --- B14 ------------------------------------------------------------------
@register("null_profile", panel_sql() + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM panel"
    for c in C.LISTING_COLUMNS))
def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Null count per contract column."""
    return K.null_profile(panel(spark, sf), list(C.LISTING_COLUMNS))


# --- H18 ------------------------------------------------------------------
@register("current_year", panel_sql() + """
SELECT uid, build_year, build_year > year(today()) AS not_built_yet, year(today()) - build_year AS age FROM panel""")
def q_current_year(spark: SparkSession, sf: str) -> DataFrame:
    """The year of now in UTC, as the contract takes it when no date is injected, held against every build year."""
    rule = next(r for r in K.listing_contract(record=True).rules() if r.kind == "not_future")
    return panel(spark, sf).select("uid", "build_year", K.bad_expr(rule).alias("not_built_yet"),
                                   (F.lit(rule.params[0]) - F.col("build_year")).cast("long").alias("age"))

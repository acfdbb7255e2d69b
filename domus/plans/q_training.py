"""Queries: features, splits, ranks, model fit, conformal intervals, metrics, scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.operators import conformal
from domus.operators.contract import ColumnSpec, Contract
from domus.operators.features import column_medians, encoded_slots, impute
from domus.operators.metrics import cv_mean_score, interval_coverage, regression_metrics
from domus.operators.rank import global_rank
from domus.operators.registry import Registry
from domus.operators.split import exact_split, group_split, kfold_assign
from domus.plans import sqlparts as S
from domus.plans.catalog import register
from domus.plans.training import FittedModel, batch_score, cv_fold_scores, fit, train_flow, tune
from domus.session import materialize, scratch_path
from domus.sources.panel import panel, panel_sql

AS_OF = dt.datetime(2026, 1, 1, 12, 0, 0)  # injected scoring time (H18), fixed for checks
AS_OF_SQL = "TIMESTAMP '2026-01-01 12:00:00'"


def _rm(df: DataFrame) -> DataFrame:
    """Round metric columns like the oracle does."""
    return df.withColumns({"mae": F.round("mae", 4), "rmse": F.round("rmse", 4),
                           "mape": F.round("mape", 6), "r2": F.round("r2", 6)})


def linear_setup(spark: SparkSession, sf: str) -> tuple[DataFrame, FittedModel]:
    """Panel with exact split + closed-form linear model fit on train (medians from train)."""
    split = materialize(exact_split(panel(spark, sf)))
    model = fit(split.filter(F.col("part") == "train"), "simple_linear")
    return split, model


def linear_scored(spark: SparkSession, sf: str) -> tuple[DataFrame, FittedModel]:
    split, model = linear_setup(spark, sf)
    scored = model.predict(split, keep=("uid", "id", "part", C.TARGET, "snapshot_month"))
    return scored, model


# --- D1 -------------------------------------------------------------------
@register("column_medians", S.split_ctes() + ",\n" + S.medians_cte() + "\nSELECT "
          + ", ".join(f"round({c}, 6) AS {c}" for c in C.NUMERIC_FEATURES) + " FROM med")
def q_column_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Exact medians of the 14 numeric features over the train part."""
    split = materialize(exact_split(panel(spark, sf).select("uid", *C.NUMERIC_FEATURES)))
    med = column_medians(split.filter(F.col("part") == "train"))
    return spark.createDataFrame([tuple(round(med[c], 6) for c in C.NUMERIC_FEATURES)],
                                 ", ".join(f"{c} double" for c in C.NUMERIC_FEATURES))


# --- K3 -------------------------------------------------------------------
@register("impute_features", S.linear_ctes() + "\nSELECT uid, price_pln, "
          + ", ".join(C.FEATURE_COLUMNS) + " FROM imp")
def q_impute_features(spark: SparkSession, sf: str) -> DataFrame:
    """K3: every panel row imputed with train medians; 24 features + uid + target."""
    split, model = linear_setup(spark, sf)
    return impute(split, model.medians, keep=("uid", C.TARGET)).select(
        "uid", C.TARGET, *C.FEATURE_COLUMNS)


# --- K1 -------------------------------------------------------------------
@register("exact_split", S.split_ctes() + "\nSELECT uid, part FROM split")
def q_exact_split(spark: SparkSession, sf: str) -> DataFrame:
    """K1: exact seeded train/cal/test split of the whole panel."""
    return exact_split(panel(spark, sf)).select("uid", "part")


# --- K2 -------------------------------------------------------------------
@register("group_split", panel_sql() + """
SELECT uid, id, CASE WHEN u < 0.2 THEN 'test' WHEN u < 0.4 THEN 'cal' ELSE 'train' END AS part
FROM (SELECT uid, id, CAST(('0x' || substr(md5(concat_ws('|', '42', id)), 1, 8))::BIGINT AS DOUBLE)
                      / 4294967296.0 AS u FROM panel)""")
def q_group_split(spark: SparkSession, sf: str) -> DataFrame:
    """K2: split by listing id (all months of an id together)."""
    return group_split(panel(spark, sf)).select("uid", "id", "part")


# --- K9 -------------------------------------------------------------------
@register("kfold_assign", panel_sql() + """,
ranked AS (SELECT uid, row_number() OVER (ORDER BY md5(concat_ws('|', '42', uid)), uid) AS rk,
                  count(*) OVER () AS n FROM panel),
b AS (SELECT uid, rk, n, n // 5 AS q, n % 5 AS r FROM ranked)
SELECT uid, CAST(CASE WHEN rk <= r * (q + 1) THEN (rk - 1) // (q + 1)
                      ELSE r + (rk - 1 - r * (q + 1)) // q END AS INTEGER) AS fold FROM b""")
def q_kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    """K9: exact seeded 5-fold assignment over the whole panel."""
    return kfold_assign(panel(spark, sf), "uid", 5).select("uid", F.col("fold").cast("int"))


# --- E4 -------------------------------------------------------------------
@register("global_rank", panel_sql() + """
SELECT uid, price_pln, row_number() OVER (ORDER BY price_pln, uid) AS rank FROM panel""")
def q_global_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Exact global rank of all panel rows by (price, uid), no single-partition window."""
    p = materialize(panel(spark, sf).select("uid", C.TARGET))
    return global_rank(p, [C.TARGET, "uid"], "rank").select(
        "uid", C.TARGET, F.col("rank").cast("long"))


# --- D4 / D5 ----------------------------------------------------------------
@register("regression_metrics", S.linear_ctes() + "\nSELECT " + S.metrics_select("price_pln", "prediction")
          + " FROM pred WHERE part = 'test'")
def q_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """MAE/RMSE/MAPE/R2 of the linear model on the test part."""
    scored, _ = linear_scored(spark, sf)
    return _rm(regression_metrics(scored.filter(F.col("part") == "test"), C.TARGET, "prediction"))


@register("metrics_by_group", S.linear_ctes() + "\nSELECT city, "
          + S.metrics_select("price_pln", "prediction") + " FROM pred WHERE part = 'test' GROUP BY city")
def q_metrics_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """The test metrics per city segment."""
    scored, _ = linear_scored(spark, sf)
    return _rm(regression_metrics(scored.filter(F.col("part") == "test"), C.TARGET, "prediction",
                                  by=["city"]))


# --- K6 / K7 / K8 -------------------------------------------------------------
@register("conformal_quantile", S.linear_ctes() + S.conformal_ctes()
          + "\nSELECT n_cal, rnk AS rank, round(q, 4) AS q FROM qv")
def q_conformal_quantile(spark: SparkSession, sf: str) -> DataFrame:
    """Calibrated half-width on the calibration part (alpha 0.1)."""
    scored, _ = linear_scored(spark, sf)
    n, rank, q = conformal.calibrated(scored.filter(F.col("part") == "cal"), C.TARGET, "prediction", C.CONFORMAL_ALPHA)
    return spark.createDataFrame([(n, rank, round(q, 4))], "n_cal long, rank long, q double")


def _with_interval(spark: SparkSession, sf: str) -> DataFrame:
    scored, _ = linear_scored(spark, sf)
    q = conformal.calibrate(scored.filter(F.col("part") == "cal"), C.TARGET, "prediction")
    return conformal.interval(scored.filter(F.col("part") == "test"), q)


@register("conformal_interval", S.linear_ctes() + S.conformal_ctes() + """
SELECT uid, round(prediction, 4) AS prediction, round(prediction - q, 4) AS lower,
       round(prediction + q, 4) AS upper
FROM pred CROSS JOIN qv WHERE part = 'test'""")
def q_conformal_interval(spark: SparkSession, sf: str) -> DataFrame:
    """K7: point and +-q band for every test row."""
    out = _with_interval(spark, sf)
    return out.select("uid", *[F.round(c, 4).alias(c) for c in ("prediction", "lower", "upper")])


@register("interval_coverage", S.linear_ctes() + S.conformal_ctes() + """
SELECT round(avg(CASE WHEN CAST(price_pln AS DOUBLE) BETWEEN prediction - q AND prediction + q
                      THEN 1.0 ELSE 0.0 END), 6) AS coverage, CAST(count(*) AS BIGINT) AS n_samples
FROM pred CROSS JOIN qv WHERE part = 'test'""")
def q_interval_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """K8: share of test rows inside their conformal interval."""
    out = interval_coverage(_with_interval(spark, sf), C.TARGET)
    return out.withColumn("coverage", F.round("coverage", 6))


# --- K12 -------------------------------------------------------------------
@register("batch_score", S.linear_ctes() + S.conformal_ctes() + f"""
, px AS (SELECT uid, CAST(round_even(prediction, 0) AS BIGINT) AS p, q FROM pred CROSS JOIN qv)
SELECT uid, p AS predicted_price,
       greatest(CAST(round_even(CAST(p AS DOUBLE) - q, 0) AS BIGINT), 0) AS interval_low,
       CAST(round_even(CAST(p AS DOUBLE) + q, 0) AS BIGINT) AS interval_high,
       'price-linear' AS model_name, '1' AS model_version, {AS_OF_SQL} AS predicted_at
FROM px""")
def q_batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """Score every panel row as a request (price column ignored) with its interval."""
    split, model = linear_setup(spark, sf)
    scored_cal = model.predict(split.filter(F.col("part") == "cal"), keep=(C.TARGET,))
    model.q = conformal.calibrate(scored_cal, C.TARGET, "prediction")
    return batch_score(model, split, "price-linear", "1", keep=("uid",),
                       predicted_at=F.lit(AS_OF).cast("timestamp"))


# --- D6 -------------------------------------------------------------------
@register("cv_mean_score", S.split_ctes() + ",\n" + S.medians_cte() + """,
imp AS (SELECT s.uid, s.price_pln, coalesce(CAST(s.square_meters AS DOUBLE), med.square_meters) AS x
        FROM split s CROSS JOIN med WHERE s.part = 'train'),
rk AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', uid)), uid) AS r,
              count(*) OVER () AS n FROM imp),
fo AS (SELECT *, CASE WHEN r <= (n % 5) * (n // 5 + 1) THEN (r - 1) // (n // 5 + 1)
                      ELSE (n % 5) + (r - 1 - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM rk),
folds AS (SELECT DISTINCT fold FROM fo),
coef AS (SELECT f.fold, regr_slope(CAST(o.price_pln AS DOUBLE), o.x) AS slope,
                regr_intercept(CAST(o.price_pln AS DOUBLE), o.x) AS icpt
         FROM folds f JOIN fo o ON o.fold <> f.fold GROUP BY f.fold),
per AS (SELECT o.fold, avg(abs(CAST(o.price_pln AS DOUBLE) - (c.icpt + c.slope * o.x))) AS mae
        FROM fo o JOIN coef c ON o.fold = c.fold GROUP BY o.fold)
SELECT CAST(0 AS BIGINT) AS trial, round(avg(mae), 2) AS cv_mae, CAST(count(*) AS BIGINT) AS n_folds FROM per""")
def q_cv_mean_score(spark: SparkSession, sf: str) -> DataFrame:
    """D6 (+K9): mean over 5 exact folds of the train part of the per-fold MAE."""
    split, model = linear_setup(spark, sf)
    train = impute(split.filter(F.col("part") == "train"), model.medians, keep=("uid", C.TARGET))
    folds = kfold_assign(train, "uid", 5, check_unique=False)  # the split has asked
    per = cv_fold_scores(folds, "square_meters", C.TARGET).withColumn("trial", F.lit(0).cast("long"))
    return cv_mean_score(per).withColumn("cv_mae", F.round("cv_mae", 2))


# --- K4 -------------------------------------------------------------------
@register("one_hot", S.linear_ctes() + """,
lg AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS category FROM imp WHERE part = 'train'"
    for c in C.CATEGORICAL_FEATURES) + """)
SELECT "column", category, CAST(count(*) AS BIGINT) AS n,
       CAST(row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS BIGINT) AS idx
FROM lg GROUP BY "column", category""")
def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """K4: the fitted encoder run over the train rows: each category's slot in the one-hot block, and how many
    vectors have a one there."""
    split, model = linear_setup(spark, sf)
    train = impute(split.filter(F.col("part") == "train"), model.medians)
    return encoded_slots(train)


# --- K11 ------------------------------------------------------------------
#: What the flow asks of the panel: strict columns, keys and target present, positive areas and prices.
FLOW_CONTRACT = Contract({c: ColumnSpec() for c in C.LISTING_COLUMNS} | {
    "id": ColumnSpec(nullable=False), "city": ColumnSpec(nullable=False), "snapshot_month": ColumnSpec(nullable=False),
    "square_meters": ColumnSpec(lo=0.1), "price_pln": ColumnSpec(nullable=False, lo=1)})


@register("train_flow", S.linear_ctes() + S.conformal_ctes() + """,
m AS (SELECT """ + S.metrics_select("price_pln", "prediction") + """ FROM pred WHERE part = 'test'),
sz AS (SELECT sum(CASE WHEN part = 'train' THEN 1 ELSE 0 END) AS n_train,
              sum(CASE WHEN part = 'cal' THEN 1 ELSE 0 END) AS n_cal,
              sum(CASE WHEN part = 'test' THEN 1 ELSE 0 END) AS n_test FROM split)
SELECT CAST(n_train AS BIGINT) AS n_train, CAST(sz.n_cal AS BIGINT) AS n_cal, CAST(n_test AS BIGINT) AS n_test,
       round(fit.slope, 4) AS slope, round(fit.icpt, 4) AS intercept, round(qv.q, 4) AS q,
       m.mae, m.rmse, m.mape, m.r2, run AS version, m.mae AS registered_mae, run = 1 AS should_promote,
       CASE WHEN run = 1 THEN 'production' ELSE 'none' END AS stage, broken.n AS contract_failures
FROM sz CROSS JOIN fit CROSS JOIN qv CROSS JOIN m CROSS JOIN (VALUES (1::BIGINT), (2)) AS r(run)
CROSS JOIN (SELECT count(*) AS n FROM panel WHERE id IS NULL OR city IS NULL OR price_pln IS NULL OR snapshot_month IS NULL
            OR square_meters <= 0 OR price_pln < 1) AS broken""")
def q_train_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Contract -> split -> impute -> fit -> calibrate -> evaluate -> register -> advise, twice over the whole panel:
    the first version has no incumbent and goes to production, the second is no better and is held."""
    listings = materialize(panel(spark, sf))
    reg = Registry(spark, scratch_path(spark, "registry"))
    rows = []
    for _ in (1, 2):
        run = train_flow(listings, contract=FLOW_CONTRACT, registry=reg)
        if run.recommendation["should_promote"]:
            reg.transition_stage("price", run.version["version"], "production")
        m, s = run.metrics, run.sizes
        rows.append((s.get("train", 0), s.get("cal", 0), s.get("test", 0), round(run.model.slope, 4),
                     round(run.model.intercept, 4), round(run.model.q, 4), round(m["mae"], 4),
                     round(m["rmse"], 4), round(m["mape"], 6), round(m["r2"], 6), int(run.version["version"]),
                     run.recommendation["should_promote"], len(FLOW_CONTRACT.validate(listings, ignore=("uid",)))))
    flow = spark.createDataFrame(rows, "n_train long, n_cal long, n_test long, slope double, intercept double, q double, "
                                       "mae double, rmse double, mape double, r2 double, version long, should_promote boolean, "
                                       "contract_failures long")
    stored = reg.versions().select("version", F.round(F.element_at("metrics", "mae"), 4).alias("registered_mae"), "stage")
    return flow.join(stored, "version")


# --- K5 --------------------------------------------------------------------
RIDGE = 1000.0
BOOSTED_FLOOR = 0.5


@register("fit_regressor", S.linear_ctes() + S.ridge_ctes(RIDGE) + S.conformal_ctes(src="rpred") + f""",
me AS (SELECT avg(abs(price_pln - prediction)) AS mae, sqrt(avg((price_pln - prediction) ** 2)) AS rmse,
              1 - sum((price_pln - prediction) ** 2) / (count(*) * var_pop(price_pln)) AS r2, count(*) AS n
       FROM rpred WHERE part = 'test')
SELECT 'linear' AS estimator, round(mae, 1) AS mae, round(rmse, 1) AS rmse, round(r2, 6) AS r2, n AS n_samples,
       round(q, 1) AS q, r2 > {BOOSTED_FLOOR} AS above_floor FROM me CROSS JOIN qv
UNION ALL SELECT 'gbt', NULL, NULL, NULL, n, NULL, true FROM me""")
def q_fit_regressor(spark: SparkSession, sf: str) -> DataFrame:
    """K5: two estimators through the full feature pipeline: the linear one with its test metrics and half-width, and
    gradient-boosted trees, whose R2 is held against a floor."""
    listings = materialize(panel(spark, sf))
    rows = []
    for name, params in (("linear", {"reg_param": RIDGE}),
                         ("gbt", {"n_estimators": 20, "max_depth": 5, "learning_rate": 0.1, "seed": 42})):
        run = train_flow(listings, estimator=name, params=params)
        m, exact = run.metrics, name == "linear"
        rows.append((name, *(round(m[c], k) if exact else None for c, k in (("mae", 1), ("rmse", 1), ("r2", 6))),
                     m["n_samples"], round(run.model.q, 1) if exact else None, m["r2"] > BOOSTED_FLOOR))
    return spark.createDataFrame(rows, "estimator string, mae double, rmse double, r2 double, n_samples long, q double, "
                                       "above_floor boolean")


# --- K10 (rows) -----------------------------------------------------------
@register("tune")
def q_tune(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded search (3 trials) over the default space and folds on the train part."""
    split = materialize(exact_split(panel(spark, sf)))
    _, trials = tune(split.filter(F.col("part") == "train"), n_trials=3, timeout_seconds=float("inf"),
                     estimator="gbt")
    return trials

"""Queries: registry and promotion.

The version table is derived from the panel: one model name per city, one version per
shipping year, metrics = the linear model's test metrics on that city-year (computed with
the library's own metrics operator); stages follow a fixed rule by version recency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import ModelNotLoadedError
from domus.functions.maps import epoch_ms_to_ts, lower_stage, map_lookup, map_merge, metric_tags
from domus.operators import promotion as P
from domus.operators import registry as R
from domus.operators.metrics import regression_metrics
from domus.plans import sqlparts as S
from domus.plans.catalog import register
from domus.plans.q_training import linear_scored
from domus.session import materialize, scratch_path

METRIC_KEYS = ("mae", "rmse", "mape", "r2")


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """(name, version, stage, run_id, metrics, created_at) — stand-in registry rows."""
    scored, _ = linear_scored(spark, sf)
    test = scored.filter(F.col("part") == "test").withColumn("year", F.substring("snapshot_month", 1, 4).cast("int"))
    # city is not among the kept columns; re-derive it from the imputed features
    m = regression_metrics(test, C.TARGET, "prediction", by=["city", "year"])
    w = Window.partitionBy("city").orderBy("year")
    wmax = Window.partitionBy("city")
    v = (m.withColumn("version", F.dense_rank().over(w).cast("long"))
         .withColumn("_max", F.max("version").over(wmax)))
    stage = (F.when(F.col("version") == F.col("_max"), "staging")
             .when(F.col("version") == F.col("_max") - 1, "production")
             .when(F.col("version") == F.col("_max") - 3, "production")
             .when(F.col("version") == 1, "none").otherwise("archived"))
    metrics = F.create_map(*[x for k in METRIC_KEYS for x in (F.lit(k), F.round(k, 4))],
                           F.lit("n"), F.col("n_samples").cast("double"))
    name = F.concat(F.lit("price-"), F.lower("city"))
    # a row for each city and year, read several times: written, so that the panel is scored once
    return materialize(v.select(
                    name.alias("name"), "version", stage.alias("stage"),
                    F.md5(F.concat_ws("|", name, F.col("version"))).alias("run_id"),
                    metrics.alias("metrics"),
                    F.make_timestamp(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("created_at")))


VERSIONS_SQL = S.linear_ctes() + """,
mt AS (SELECT city, CAST(substr(snapshot_month, 1, 4) AS INTEGER) AS year,
              round(avg(abs(CAST(price_pln AS DOUBLE) - prediction)), 4) AS mae,
              round(sqrt(avg((CAST(price_pln AS DOUBLE) - prediction) * (CAST(price_pln AS DOUBLE) - prediction))), 4) AS rmse,
              round(coalesce(avg(CASE WHEN price_pln <> 0 THEN abs((CAST(price_pln AS DOUBLE) - prediction) / price_pln) END), 0.0), 4) AS mape,
              round(CASE WHEN count(*) * var_pop(CAST(price_pln AS DOUBLE)) = 0 THEN 0.0 ELSE
                    1 - sum((CAST(price_pln AS DOUBLE) - prediction) * (CAST(price_pln AS DOUBLE) - prediction))
                        / (count(*) * var_pop(CAST(price_pln AS DOUBLE))) END, 4) AS r2,
              count(*) AS n
       FROM pred WHERE part = 'test' GROUP BY city, year),
vr AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY city ORDER BY year) AS BIGINT) AS version FROM mt),
vv AS (SELECT *, max(version) OVER (PARTITION BY city) AS mx FROM vr),
versions AS (SELECT 'price-' || lower(city) AS name, version,
       CASE WHEN version = mx THEN 'staging' WHEN version = mx - 1 THEN 'production'
            WHEN version = mx - 3 THEN 'production' WHEN version = 1 THEN 'none' ELSE 'archived' END AS stage,
       mae, rmse, mape, r2, n, year FROM vv)"""


def _flat(df: DataFrame) -> DataFrame:
    return df.select("name", "version", "stage",
                     *[map_lookup(F.col("metrics"), k).alias(k) for k in METRIC_KEYS])


def _stored_registry(spark: SparkSession, sf: str) -> R.Registry:
    """The versions written as a registry's version table and stage events."""
    root = scratch_path(spark, "registry")
    v = versions(spark, sf)
    v.select("name", "version", "run_id", "metrics", "created_at",
             F.lit(None).cast("string").alias("artifact")).write.parquet(f"{root}/versions")
    v.select("name", "version", "stage", "created_at",
             F.lit(1).cast("long").alias("seq")).withColumnRenamed("created_at", "changed_at") \
        .write.parquet(f"{root}/stages")
    return R.Registry(spark, root)


@register("model_version_table", VERSIONS_SQL + "\nSELECT name, version, stage, mae, rmse, mape, r2 FROM versions")
def q_model_version_table(spark: SparkSession, sf: str) -> DataFrame:
    """Versions written as a registry version table + stage events, read back."""
    return _flat(_stored_registry(spark, sf).versions())


@register("register_version", VERSIONS_SQL + """
SELECT name, version, stage, mae, rmse, mape, r2 FROM versions
UNION ALL
SELECT name, version + 1, 'none', mae, rmse, mape, r2 FROM versions
QUALIFY version = max(version) OVER (PARTITION BY name)""")
def q_register_version(spark: SparkSession, sf: str) -> DataFrame:
    """M1: for every model name a new version, with the metrics of its latest one, registered through the registry
    (numbers claimed by create-if-absent); the stored table is read back."""
    reg = _stored_registry(spark, sf)
    stored = reg.versions()
    top = stored.groupBy("name").agg(F.max_by("metrics", "version").alias("metrics"))  # a row for each model name
    reg.register_all({r["name"]: r["metrics"] for r in top.collect()})
    return _flat(reg.versions())


@register("transition_stage", VERSIONS_SQL + """
SELECT name, version, CASE WHEN stage = 'staging' THEN 'production' ELSE stage END AS stage FROM versions""")
def q_transition_stage(spark: SparkSession, sf: str) -> DataFrame:
    """M2: move every name's staging version to production; others untouched."""
    v = versions(spark, sf)
    t = v.filter(F.col("stage") == "staging").select("name", "version", F.lit("production").alias("stage"))
    return R.apply_transitions(v, t).select("name", "version", "stage")


@register("latest_per_stage", VERSIONS_SQL + """
SELECT name, stage, max(version) AS version FROM versions GROUP BY name, stage""")
def q_latest_per_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Highest version per (name, stage)."""
    return R.latest_per_stage(versions(spark, sf)).select("name", "stage", "version")


_C3 = VERSIONS_SQL + """,
lat AS (SELECT name, stage, max(version) AS version FROM versions GROUP BY name, stage),
cand AS (SELECT l.name, l.version AS candidate_version, v.mae AS candidate FROM lat l
         JOIN versions v ON v.name = l.name AND v.version = l.version WHERE l.stage = 'staging'),
inc AS (SELECT l.name, l.version AS incumbent_version, v.mae AS incumbent FROM lat l
        JOIN versions v ON v.name = l.name AND v.version = l.version WHERE l.stage = 'production'),
c3 AS (SELECT cand.*, inc.incumbent_version, inc.incumbent FROM cand LEFT JOIN inc ON cand.name = inc.name)"""


@register("candidate_vs_incumbent", _C3 + "\nSELECT * FROM c3")
def q_candidate_vs_incumbent(spark: SparkSession, sf: str) -> DataFrame:
    """Staging candidate matched with the newest production version of the same name."""
    return P.candidate_vs_incumbent(versions(spark, sf))


@register("recommend_promotion", _C3 + """
SELECT name, candidate_version, candidate, incumbent_version, incumbent,
       round(CASE WHEN incumbent IS NULL THEN NULL
                  ELSE (incumbent - candidate) / CASE WHEN incumbent = 0 THEN 1.0 ELSE abs(incumbent) END END, 6)
         AS relative_improvement,
       CASE WHEN candidate IS NULL THEN NULL WHEN incumbent IS NULL THEN true
            ELSE (incumbent - candidate) / CASE WHEN incumbent = 0 THEN 1.0 ELSE abs(incumbent) END > 0.0 END
         AS should_promote
FROM c3""")
def q_recommend_promotion(spark: SparkSession, sf: str) -> DataFrame:
    """M5: promote/hold advice for every staging candidate (lower MAE is better, threshold 0)."""
    r = P.recommend_all(P.candidate_vs_incumbent(versions(spark, sf)))
    return r.select("name", "candidate_version", "candidate", "incumbent_version", "incumbent",
                    F.round("relative_improvement", 6).alias("relative_improvement"), "should_promote")


@register("compare_versions", VERSIONS_SQL + """,
prod AS (SELECT v.name, v.mae AS incumbent FROM versions v
         JOIN (SELECT name, max(version) AS version FROM versions WHERE stage = 'production' GROUP BY name) p
           ON p.name = v.name AND p.version = v.version)
SELECT v.name, v.version, v.mae AS metric,
       CAST(rank() OVER (PARTITION BY v.name ORDER BY v.mae, v.version) AS INTEGER) AS rank,
       round(CASE WHEN incumbent IS NULL THEN NULL
                  ELSE (incumbent - v.mae) / CASE WHEN incumbent = 0 THEN 1.0 ELSE abs(incumbent) END END, 6)
         AS relative_improvement,
       CASE WHEN v.mae IS NULL THEN NULL WHEN incumbent IS NULL THEN true
            ELSE (incumbent - v.mae) / CASE WHEN incumbent = 0 THEN 1.0 ELSE abs(incumbent) END > 0.0 END AS should_promote
FROM versions v LEFT JOIN prod ON prod.name = v.name""")
def q_compare_versions(spark: SparkSession, sf: str) -> DataFrame:
    """M6: all versions ranked by MAE, each judged against the production version."""
    c = P.compare_versions(versions(spark, sf))
    return c.select("name", "version", "metric", F.col("rank").cast("int"),
                    F.round("relative_improvement", 6).alias("relative_improvement"), "should_promote")


def _tags(v: DataFrame):
    return F.create_map(
        F.lit("metric.mae"), map_lookup(F.col("metrics"), "mae").cast("string"),
        F.lit("metric.r2"), map_lookup(F.col("metrics"), "r2").cast("string"),
        F.lit("metric.note"), F.lit("n/a"),
        F.lit("owner"), F.col("name"))


@register("map_metric_tags", VERSIONS_SQL + """
SELECT name, version, 'mae' AS key, mae AS value FROM versions
UNION ALL SELECT name, version, 'r2' AS key, r2 AS value FROM versions""")
def q_map_metric_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tag maps (metric.* text, a junk metric, a non-metric key) parsed to metrics."""
    v = versions(spark, sf)
    parsed = v.select("name", "version", metric_tags(_tags(v)).alias("m"))
    return parsed.select("name", "version", F.explode("m").alias("key", "value"))


@register("map_merge", VERSIONS_SQL + """
SELECT name, version, 'mae' AS key, round(mae, 0) AS value FROM versions
UNION ALL SELECT name, version, 'r2' AS key, r2 AS value FROM versions
UNION ALL SELECT name, version, 'n' AS key, CAST(n AS DOUBLE) AS value FROM versions""")
def q_map_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Tag metrics overridden by passed metrics (passed wins on duplicate keys)."""
    v = versions(spark, sf)
    tags = metric_tags(_tags(v))
    passed = F.create_map(F.lit("mae"), F.round(map_lookup(F.col("metrics"), "mae"), 0),
                          F.lit("n"), map_lookup(F.col("metrics"), "n"))
    return v.select("name", "version", F.explode(map_merge(tags, passed)).alias("key", "value"))


@register("map_lookup", VERSIONS_SQL + "\nSELECT name, version, rmse, CAST(NULL AS DOUBLE) AS missing FROM versions")
def q_map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Metric by name; a missing key gives null (callers raise)."""
    v = versions(spark, sf)
    return v.select("name", "version", map_lookup(F.col("metrics"), "rmse").alias("rmse"),
                    map_lookup(F.col("metrics"), "auc").alias("missing"))


@register("lower_stage", VERSIONS_SQL + """
SELECT name, version, stage FROM versions""")
def q_lower_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Registry spelling (None/Staging/Production/Archived) back to stage names."""
    v = versions(spark, sf)
    disp = F.element_at(F.create_map(*[x for k, d in C.STAGE_DISPLAY.items() for x in (F.lit(k), F.lit(d))]),
                        F.col("stage"))
    return v.select("name", "version", lower_stage(disp).alias("stage"))


@register("epoch_ms_to_ts", VERSIONS_SQL + """
SELECT name, version, make_timestamp(year, 1, 1, 0, 0, 0) AS created_at FROM versions""")
def q_epoch_ms_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Creation time round-tripped through epoch milliseconds (UTC)."""
    v = versions(spark, sf)
    return v.select("name", "version", epoch_ms_to_ts(F.unix_millis("created_at")).alias("created_at"))


@register("artifact_save_load", S.linear_ctes() + S.conformal_ctes() + """
, px AS (SELECT uid, CAST(round_even(prediction, 0) AS BIGINT) AS p, q FROM pred CROSS JOIN qv WHERE part = 'test')
SELECT uid, p AS predicted_price,
       greatest(CAST(round_even(CAST(p AS DOUBLE) - q, 0) AS BIGINT), 0) AS interval_low,
       CAST(round_even(CAST(p AS DOUBLE) + q, 0) AS BIGINT) AS interval_high,
       'price' AS model_name, '1' AS model_version
FROM px""")
def q_artifact_save_load(spark: SparkSession, sf: str) -> DataFrame:
    """Register the linear model (with q), load it back through the registry, score."""
    from domus.operators import conformal
    from domus.plans.q_training import linear_setup

    split, model = linear_setup(spark, sf)
    cal = model.predict(split.filter(F.col("part") == "cal"), keep=(C.TARGET,))
    model.q = conformal.calibrate(cal, C.TARGET, "prediction")
    reg = R.Registry(spark, scratch_path(spark, "registry"))
    ver = reg.log_and_register(model, "price", {"mae": 1.0})
    reg.transition_stage("price", ver["version"], "production")
    pred = R.RegistryPredictor(reg, "price")
    return pred.score(split.filter(F.col("part") == "test"), keep=("uid",)).drop("predicted_at")


@register("load_or_fail", """
SELECT * FROM (VALUES ('before_register', false, 'ModelNotLoadedError'), ('after_register', true, '1'))
  AS t(step, loaded, detail)""")
def q_load_or_fail(spark: SparkSession, sf: str) -> DataFrame:
    """A missing model fails as one error and caches nothing; a registered one loads."""
    reg = R.Registry(spark, scratch_path(spark, "registry"))
    pred = R.RegistryPredictor(reg, "price")
    rows = []
    try:
        pred.ensure_loaded()
        rows.append(("before_register", True, ""))
    except ModelNotLoadedError as exc:
        rows.append(("before_register", False, type(exc).__name__))
    from domus.plans.q_training import linear_setup

    _, model = linear_setup(spark, sf)
    ver = reg.log_and_register(model, "price", {"mae": 1.0})
    reg.transition_stage("price", ver["version"], "production")
    pred.ensure_loaded()
    rows.append(("after_register", pred.describe()["loaded"], pred.describe()["version"]))
    return spark.createDataFrame(rows, "step string, loaded boolean, detail string")

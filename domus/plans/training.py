"""K11 train_flow, D6 cross-validated scores, K12 batch_score (K10 tune is in ``tuning``).

Flow: validate -> exact split -> fit imputer on train only -> fit estimator -> calibrate
half-width on the calibration part -> evaluate on test -> register -> advise.

Two estimator families:

- ``simple_linear``: price ~ square_meters by closed-form least squares (one aggregate);
  exact and checkable against SQL.
- any name of ``build_estimator`` (``gbt`` default, ``random_forest``, ``linear``): the
  imputer, one-hot encoder, assembler and learner as one Spark ML ``Pipeline``.

The driver only ever sees scalars: n, medians, q, metrics.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import ModelNotFoundError, TrainingError
from domus.operators import conformal
from domus.operators.contract import listing_contract
from domus.operators.features import ListingImputer, feature_pipeline, impute
from domus.operators.metrics import evaluate
from domus.operators.model import build_estimator, fit_simple_linear, predict_simple_linear
from domus.operators.split import default_key, exact_split, key_columns
from domus.plans.tuning import spread, tune  # noqa: F401
from domus.session import materialize
from domus.sources.snapshots import load_checked


@dataclass
class FittedModel:
    """A fitted price model: imputer medians + estimator + conformal half-width."""

    kind: str
    medians: dict[str, float]
    slope: float | None = None
    intercept: float | None = None
    pipeline: PipelineModel | None = None
    q: float | None = None
    meta: dict[str, Any] = field(default_factory=dict)

    def predict(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Adds ``prediction`` (double); request columns beyond the features are ignored."""
        if self.kind == "simple_linear":
            feats = impute(df, self.medians, keep)
            return feats.withColumn("prediction",
                                    predict_simple_linear("square_meters", self.slope, self.intercept))
        imp = self.pipeline.stages[0]
        out = self.pipeline.transform(df, {imp.keepCols: list(keep)})
        return out.select(*C.FEATURE_COLUMNS, *keep, "prediction")


def fit(train: DataFrame, estimator: str = "simple_linear", params: dict | None = None,
        target: str = C.TARGET) -> FittedModel:
    if target not in train.columns:
        raise TrainingError(f"training frame has no target column {target!r}")
    if estimator == "simple_linear":
        imp = ListingImputer(keepCols=[target]).fit(train)
        medians = imp.median_map()
        feats = imp.transform(train)
        slope, intercept = fit_simple_linear(feats, "square_meters", target)
        return FittedModel("simple_linear", medians, slope=slope, intercept=intercept)
    learner = build_estimator(estimator, params or {}, label_col="label")
    # the imputer passes the label column through to the learner
    *steps, _ = feature_pipeline(learner, keep=(target, "label")).getStages()
    labelled = train.withColumn("label", F.col(target).cast("double"))
    features = Pipeline(stages=steps).fit(labelled)
    # trees keep their vectors, many times as large as the files: rows are dealt out before they become vectors
    rows = labelled if estimator == "linear" else spread(labelled.select(*C.FEATURE_COLUMNS, target, "label"), train.count())
    model = PipelineModel([*features.stages, learner.fit(features.transform(rows))])
    medians = model.stages[0].median_map()
    return FittedModel(estimator, medians, pipeline=model)


@dataclass
class TrainingRun:
    model: FittedModel
    metrics: dict[str, float]
    sizes: dict[str, int]
    version: dict[str, Any] | None = None
    recommendation: dict[str, Any] | None = None


def _incumbent(registry, model_name: str, metric: str) -> dict[str, float] | None:
    """Metrics of the version in production if they hold ``metric``; only a missing version means none, a
    registry that can't be read is an error."""
    try:
        metrics = registry.get_version(model_name, "production")["metrics"]
    except ModelNotFoundError:
        return None
    return metrics if metric in metrics else None


def train_flow(listings: DataFrame, *, estimator: str = "simple_linear", params: dict | None = None,
               alpha: float = C.CONFORMAL_ALPHA, test_size: float = C.TEST_SIZE,
               calibration_size: float = C.CALIBRATION_SIZE, seed: int = C.SEED,
               key: str | tuple[str, ...] | None = None, contract=None, registry=None, model_name: str = "price",
               primary_metric: str = "mae", materialize_input: bool = True) -> TrainingRun:
    """Validate -> split -> fit -> calibrate -> evaluate -> register -> advise.

    ``key`` (one column or several) tells rows apart: ``uid`` where there is one, else (id, snapshot_month)."""
    conformal.check_alpha(alpha)
    key = key or default_key(listings)
    if contract is not None:
        contract.validate(listings, raise_on_error=True, ignore=tuple(key_columns(key)))
    # one written table of labelled rows serves every later job
    split = exact_split(listings, key, test_size, calibration_size, seed)
    if materialize_input:
        split = materialize(split)
    train = split.filter(F.col("part") == "train")
    model = fit(train, estimator, params)
    scored = model.predict(split.filter(F.col("part") != "train"), keep=(C.TARGET, "part"))
    cal = scored.filter(F.col("part") == "cal")
    model.q = conformal.calibrate(cal, C.TARGET, "prediction", alpha)
    metrics = evaluate(scored.filter(F.col("part") == "test"), C.TARGET, "prediction")
    sizes = {r["part"]: int(r["count"]) for r in split.groupBy("part").count().collect()}
    run = TrainingRun(model, metrics, sizes)
    if registry is not None:
        from domus.operators.promotion import recommend_promotion

        metric_map = {k: float(v) for k, v in metrics.items()}
        run.version = registry.log_and_register(model, model_name, metric_map)
        run.recommendation = recommend_promotion(metric_map, _incumbent(registry, model_name, primary_metric),
                                                 primary=primary_metric)
    return run


def train_on_files(spark: SparkSession, raw_dir: str, **options: Any) -> TrainingRun:
    """K11 from snapshot files: cells that don't parse count as contract failures without being asked for (the
    contract is that of sale listings unless ``contract`` names another)."""
    options.setdefault("contract", listing_contract())
    listings, _ = load_checked(spark, raw_dir)
    return train_flow(listings, **options)


# ---------------------------------------------------------------------------
# K12 batch scoring
# ---------------------------------------------------------------------------
def price_columns(point: Column, q: float | None) -> dict[str, Column]:
    """Half-even rounded price; interval bounds from the *rounded* price, low clipped at 0."""
    price = F.bround(point, 0).cast("long")
    if q is None:
        return {"predicted_price": price, "interval_low": F.lit(None).cast("long"),
                "interval_high": F.lit(None).cast("long")}
    low = F.bround(price.cast("double") - F.lit(float(q)), 0).cast("long")
    high = F.bround(price.cast("double") + F.lit(float(q)), 0).cast("long")
    return {"predicted_price": price, "interval_low": F.greatest(low, F.lit(0).cast("long")),
            "interval_high": high}


def batch_score(model: FittedModel, requests: DataFrame, model_name: str, model_version: str,
                keep: tuple[str, ...] = (), predicted_at: Column | None = None) -> DataFrame:
    """Impute + predict + round/clip + stamp; extra request columns are ignored."""
    scored = model.predict(requests, keep)
    cols = price_columns(F.col("prediction"), model.q)
    stamp = predicted_at if predicted_at is not None else F.current_timestamp()
    return scored.select(*keep, *[c.alias(n) for n, c in cols.items()],
                         F.lit(model_name).alias("model_name"),
                         F.lit(str(model_version)).alias("model_version"),
                         stamp.alias("predicted_at"))


# ---------------------------------------------------------------------------
# Cross-validated MAE of the closed-form model with exact sufficient statistics
# ---------------------------------------------------------------------------
def _merge(stats: list[tuple[float, float, float, float, float]]):
    """Chan et al. pairwise merge of (n, mean_x, mean_y, m2x, cxy)."""
    n, mx, my, m2, c = 0.0, 0.0, 0.0, 0.0, 0.0
    for nb, mxb, myb, m2b, cb in stats:
        if nb == 0:
            continue
        tot = n + nb
        dx, dy = mxb - mx, myb - my
        m2 = m2 + m2b + dx * dx * n * nb / tot
        c = c + cb + dx * dy * n * nb / tot
        mx = mx + dx * nb / tot
        my = my + dy * nb / tot
        n = tot
    return n, mx, my, m2, c


def cv_fold_scores(df: DataFrame, x: str, y: str, fold_col: str = "fold") -> DataFrame:
    """Per-fold MAE of y ~ x fitted on the other folds (two passes over the data)."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    rows = df.groupBy(fold_col).agg(
        F.count(F.lit(1)).alias("n"), F.avg(xs).alias("mx"), F.avg(ys).alias("my"),
        (F.var_pop(xs) * F.count(F.lit(1))).alias("m2"),
        (F.covar_pop(xs, ys) * F.count(F.lit(1))).alias("c")).collect()
    stats = {int(r[fold_col]): (float(r["n"]), r["mx"], r["my"], r["m2"], r["c"]) for r in rows}
    coefs = []
    for f in sorted(stats):
        n, mx, my, m2, c = _merge([s for g, s in stats.items() if g != f])
        if m2 == 0:
            raise TrainingError("fold training data has constant x")
        slope = c / m2
        coefs.append((f, slope, my - slope * mx))
    spark = df.sparkSession
    coef_df = spark.createDataFrame(coefs, f"{fold_col} long, _slope double, _icpt double")
    pred = F.col("_icpt") + F.col("_slope") * xs
    # one row per fold: the coefficient table is k rows, broadcast by construction
    return (df.join(F.broadcast(coef_df), fold_col)
            .groupBy(fold_col).agg(F.avg(F.abs(ys - pred)).alias("mae"),
                                   F.count(F.lit(1)).cast("long").alias("n")))

"""K5 fit_regressor: estimator registry, plus the closed-form one-feature linear model.

Boosting libraries are replaced by Spark ML learners. Names accepted by the registry
and how their parameters map:

- ``gbt`` (also ``xgboost``, ``lightgbm``, ``catboost``) -> ``GBTRegressor``
- ``random_forest`` -> ``RandomForestRegressor``
- ``linear`` -> ``LinearRegression`` with the ``normal`` solver (exact: one Gram-matrix aggregate; at most 4,096
  encoded features)

``n_estimators``/``iterations`` -> ``maxIter`` (or ``numTrees``), ``max_depth``/``depth`` ->
``maxDepth``, ``learning_rate`` -> ``stepSize``, ``subsample`` -> ``subsamplingRate``,
``colsample_bytree`` -> ``featureSubsetStrategy`` (a fraction; per node in Spark),
``random_state``/``seed`` -> ``seed``. A parameter without a Spark
twin (``num_leaves``, ``reg_lambda``) is an error rather than dropped.
"""

from __future__ import annotations

from typing import Any

from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.errors import TrainingError

_GBT_NAMES = ("gbt", "xgboost", "lightgbm", "catboost")
_TREES = {"max_depth", "depth", "subsample", "colsample_bytree", "random_state", "seed", "random_seed", "n_estimators",
          "iterations"}
_PARAMETERS = {"boosted": _TREES | {"learning_rate"}, "random_forest": _TREES, "linear": {"reg_param", "l1_ratio"}}
KNOWN_ESTIMATORS = (*_GBT_NAMES, "random_forest", "linear")


def _common(params: dict[str, Any]) -> dict[str, Any]:
    out: dict[str, Any] = {}
    for k in ("max_depth", "depth"):
        if k in params:
            out["maxDepth"] = int(params[k])
    if "subsample" in params:
        out["subsamplingRate"] = float(params["subsample"])
    if "colsample_bytree" in params:
        out["featureSubsetStrategy"] = str(float(params["colsample_bytree"]))
    for k in ("random_state", "seed", "random_seed"):
        if k in params:
            out["seed"] = int(params[k])
    return out


def build_estimator(name: str, params: dict[str, Any] | None = None,
                    features_col: str = "features", label_col: str = "label"):
    """Unfitted Spark ML regressor by name; unknown name -> ``TrainingError`` listing known ones."""
    params = dict(params or {})
    if name not in KNOWN_ESTIMATORS:
        raise TrainingError(f"no estimator is called {name!r}, only {', '.join(sorted(KNOWN_ESTIMATORS))}")
    group = "boosted" if name in _GBT_NAMES else name
    unknown = sorted(set(params) - _PARAMETERS[group])
    if unknown:
        raise TrainingError(f"estimator {name!r} has no parameters {', '.join(unknown)}")
    kw = dict(featuresCol=features_col, labelCol=label_col)
    if name in _GBT_NAMES:
        kw.update(_common(params))
        for k in ("n_estimators", "iterations"):
            if k in params:
                kw["maxIter"] = int(params[k])
        if "learning_rate" in params:
            kw["stepSize"] = float(params["learning_rate"])
        kw.setdefault("lossType", "squared")
        return GBTRegressor(**kw)
    if name == "random_forest":
        kw.update(_common(params))
        for k in ("n_estimators", "iterations"):
            if k in params:
                kw["numTrees"] = int(params[k])
        return RandomForestRegressor(**kw)
    reg = float(params.get("reg_param", 0.0))
    # one aggregate gives the Gram matrix of the encoded features; the driver solves a system of their number
    return LinearRegression(regParam=reg, elasticNetParam=float(params.get("l1_ratio", 0.0)), solver="normal", **kw)


# ---------------------------------------------------------------------------
# Closed-form simple regression y = intercept + slope * x (exact, SQL-checkable).
# ---------------------------------------------------------------------------
def fit_simple_linear(df: DataFrame, x: str, y: str) -> tuple[float, float]:
    """(slope, intercept) by least squares, one aggregate (``regr_slope``/``regr_intercept``)."""
    row = df.agg(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("s"),
                 F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("i")).collect()[0]
    if row["s"] is None:
        raise TrainingError("cannot fit: fewer than two distinct x values")
    return float(row["s"]), float(row["i"])


def predict_simple_linear(x: Column | str, slope: float, intercept: float) -> Column:
    xc = F.col(x) if isinstance(x, str) else x
    return F.lit(intercept) + F.lit(slope) * xc.cast("double")

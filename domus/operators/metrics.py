"""D4 regression_metrics, D5 metrics_by_group, D6 cv_mean_score, K8 interval_coverage.

All in one aggregate each (partial aggregation on the map side, one small shuffle for
grouped forms). Guards: MAPE averages |e/y| over rows with y != 0 and is 0 when there are
none; R^2 is 0 when the target has zero variance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.errors import TrainingError
from domus.operators.guards import LEAST_ANY, require_rows


def metric_exprs(y: str, p: str) -> list[Column]:
    yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
    e = yc - pc
    n = F.count(F.lit(1))
    ss_tot = n * F.var_pop(yc)
    return [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.coalesce(F.avg(F.when(yc != 0, F.abs(e / yc))), F.lit(0.0)).alias("mape"),
        F.when(ss_tot == 0, F.lit(0.0)).otherwise(1 - F.sum(e * e) / ss_tot).alias("r2"),
        n.cast("long").alias("n_samples"),
    ]


def regression_metrics(df: DataFrame, y: str = "y", p: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    """D4 (``by`` empty) / D5 (``by`` = segment columns): mae, rmse, mape, r2, n_samples."""
    if by:
        return df.groupBy(*by).agg(*metric_exprs(y, p))
    return df.agg(*metric_exprs(y, p))


def evaluate(df: DataFrame, y: str = "y", p: str = "prediction") -> dict[str, float]:
    """D4 as a dict; empty input -> ``TrainingError``."""
    row = regression_metrics(df, y, p).collect()[0]
    require_rows(row["n_samples"], LEAST_ANY, "an evaluation", TrainingError)
    return {k: (int(row[k]) if k == "n_samples" else float(row[k]))
            for k in ("mae", "rmse", "mape", "r2", "n_samples")}


def interval_coverage(df: DataFrame, y: str = "y", lo: str = "lower", hi: str = "upper",
                      by: list[str] | None = None) -> DataFrame:
    """K8: share of rows with lower <= y <= upper."""
    cov = F.avg(F.col(y).between(F.col(lo), F.col(hi)).cast("double")).alias("coverage")
    n = F.count(F.lit(1)).cast("long").alias("n_samples")
    return df.groupBy(*by).agg(cov, n) if by else df.agg(cov, n)


def cv_mean_score(fold_scores: DataFrame, trial_col: str = "trial",
                  score_col: str = "mae") -> DataFrame:
    """Mean over folds of the per-fold score, per trial."""
    return fold_scores.groupBy(trial_col).agg(
        F.avg(score_col).alias("cv_mae"), F.count(F.lit(1)).cast("long").alias("n_folds"))

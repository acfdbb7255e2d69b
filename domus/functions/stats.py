"""Statistics expressions: H14 log_ratio (PSI term) and the two-sample KS p-value.

p-value of D for samples of n1 and n2 values: the exact law where neither side has more than ``EXACT_ROWS``
values, else the asymptotic one.

- Exact: under the null hypothesis every order of the n1 + n2 values is equally likely, an order is a lattice path from
  (0, 0) to (n1, n2), and D stays below d on the paths that keep |i / n1 - j / n2| < d. Such paths are
  counted row by row (``exact_pvalue``); the p-value is the share of the others. It is a pandas UDF, for it is asked
  once for each tested column, on rows that are results already.
- Asymptotic: the Kolmogorov law with effective size en = n1*n2/(n1+n2):
  Q(lambda) = 2 * sum_{k=1..100} (-1)^(k-1) exp(-2 k^2 lambda^2), lambda = sqrt(en) * D, clamped to [0, 1] and
  taken as 1 when lambda < 0.2 (the truncated series is wrong there, and Q is 1 to 12 digits). It is a column
  expression, a Spark ``aggregate`` over ``sequence(1, 100)``.

Null when the statistic is null (a side without values). The DuckDB twin moves probabilities along the diagonals of the
lattice instead of counting paths along its rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus import constants as C

# functions for Python workers travel by value: executors need no copy of this package for them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Largest side for which the exact law is used (fixed value).
EXACT_ROWS = 10_000


def log_ratio(cur_share: Column, ref_share: Column, eps: float = C.PSI_EPS) -> Column:
    """(c - r) * ln(c / r) with eps added to both shares."""
    c = cur_share + F.lit(eps)
    r = ref_share + F.lit(eps)
    return (c - r) * F.log(c / r)


def exact_pvalue(d: float, n1: int, n2: int) -> float:
    """P(D >= d) of two samples of n1 and n2 values from one continuous law."""
    few, many = sorted((n1, n2))
    a, b = few // math.gcd(n1, n2), many // math.gcd(n1, n2)
    reach = round(d * a * many)  # paths stay inside where |i * b - j * a| < reach, i of few and j of many steps
    if reach <= 0:
        return 1.0
    if reach / a * math.log1p(few / many) > 600:  # a row's counts would span more than doubles do; p is below 1e-15
        return 2.0 * math.exp(-2.0 * d * d * few * many / (few + many))
    low, paths, scale = 0, np.ones(min(many, (reach - 1) // a) + 1), 0.0
    for i in range(1, few + 1):
        first = max(0, (i * b - reach) // a + 1)
        last = min(many, (i * b + reach - 1) // a)
        kept = paths[first - low:]
        paths = np.zeros(last - first + 1)
        paths[:len(kept)] = kept
        np.cumsum(paths, out=paths)  # a point is reached from the row below or from its left
        if not paths[-1]:
            return 1.0
        if paths[-1] > 1e200:
            scale += math.log(paths[-1])
            paths /= paths[-1]
        low = first
    every = math.lgamma(n1 + n2 + 1) - math.lgamma(n1 + 1) - math.lgamma(n2 + 1)
    return min(max(1.0 - math.exp(math.log(paths[-1]) + scale - every), 0.0), 1.0)


def _exact(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) else exact_pvalue(float(x), int(p), int(q)) for x, p, q in zip(d, n1, n2, strict=True)],
                     dtype="float64")


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided two-sample KS p-value for statistic ``d``."""
    en = F.try_divide(n1.cast("double") * n2.cast("double"), (n1 + n2).cast("double"))
    lam = F.sqrt(en) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    q = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    law = F.when(lam < 0.2, F.lit(1.0)).when(lam.isNotNull(), q)
    small = F.greatest(n1, n2) <= EXACT_ROWS
    exact = F.pandas_udf(_exact, T.DoubleType())(F.when(small, d), n1.cast("long"), n2.cast("long"))
    return F.when(small, exact).otherwise(law)


def ks_pvalue_sql(d: str, n1: str, n2: str) -> str:
    en = f"(CAST({n1} AS DOUBLE) * CAST({n2} AS DOUBLE) / CAST({n1} + {n2} AS DOUBLE))"
    lam = f"(sqrt({en}) * {d})"
    terms = (f"list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END "
             f"* exp(-2.0 * k * k * {lam} * {lam}))")
    series = f"list_reduce(list_prepend(0.0, {terms}), lambda a, b: a + b)"
    law = (f"(CASE WHEN {lam} < 0.2 THEN 1.0 WHEN {lam} IS NOT NULL "
           f"THEN least(greatest({series}, 0.0), 1.0) END)")
    # a state is [lowest i, probability of (i, t - i) for each i from there on]; step t leads to the next diagonal
    n, reach = f"({n1} + {n2})", f"CAST(round({d} * {n1} * {n2}) AS BIGINT)"
    low = f"greatest(0, x[1] - {n2}, CAST(floor((x[1] * {n1} - {reach}) / {n}) AS BIGINT) + 1)"
    high = f"least({n1}, x[1], CAST(ceil((x[1] * {n1} + {reach}) / {n}) AS BIGINT) - 1)"

    def held(i: str) -> str:
        return f"CASE WHEN {i} >= s[1] THEN coalesce(s[CAST({i} - s[1] AS BIGINT) + 2], 0.0) ELSE 0.0 END"

    step = (f"list_prepend(CAST({low} AS DOUBLE), list_transform(range(CAST({low} AS BIGINT), CAST({high} AS BIGINT) + 1), "
            f"lambda i: (({held('i - 1')}) * ({n1} - i + 1) + ({held('i')}) * ({n2} - x[1] + i + 1)) / ({n} - x[1] + 1)))")
    steps = f"list_prepend([0.0, 1.0], list_transform(range(1, {n} + 1), lambda t: [CAST(t AS DOUBLE)]))"
    inside = f"coalesce(list_reduce({steps}, lambda s, x: {step})[2], 0.0)"
    exact = f"CASE WHEN {d} IS NULL THEN NULL WHEN {reach} <= 0 THEN 1.0 ELSE least(greatest(1.0 - {inside}, 0.0), 1.0) END"
    return f"(CASE WHEN greatest({n1}, {n2}) <= {EXACT_ROWS} THEN {exact} ELSE {law} END)"

"""DuckDB SQL fragments that mirror the Spark queries (oracle side only)."""

from __future__ import annotations

from domus import constants as C
from domus.sources.panel import panel_sql


def split_ctes(seed: int = C.SEED, test: float = C.TEST_SIZE, cal: float = C.CALIBRATION_SIZE) -> str:
    """panel, sizes, ranked, split (exact seeded split by md5 order)."""
    return panel_sql() + f""",
sizes AS (SELECT CAST(round(count(*) * {test}) AS BIGINT) AS n_test,
                 CAST(round(count(*) * {cal}) AS BIGINT) AS n_cal FROM panel),
ranked AS (SELECT p.*, row_number() OVER (ORDER BY md5(concat_ws('|', '{seed}', uid)), uid) AS rk
           FROM panel p),
split AS (SELECT r.*, CASE WHEN rk <= n_test THEN 'test' WHEN rk <= n_test + n_cal THEN 'cal'
                           ELSE 'train' END AS part
          FROM ranked r CROSS JOIN sizes s)"""


def medians_cte(src: str = "split", where: str = "part = 'train'") -> str:
    cols = ",\n  ".join(f"coalesce(median(CAST({c} AS DOUBLE)), 0.0) AS {c}" for c in C.NUMERIC_FEATURES)
    return f"med AS (SELECT\n  {cols}\nFROM {src} WHERE {where})"


def impute_select(alias: str = "s") -> str:
    num = [f"coalesce(CAST({alias}.{c} AS DOUBLE), med.{c}) AS {c}" for c in C.NUMERIC_FEATURES]
    cat = [f"coalesce(CAST({alias}.{c} AS VARCHAR), '{C.MISSING_CATEGORY}') AS {c}"
           for c in C.CATEGORICAL_FEATURES]
    boo = [f"CAST(coalesce({alias}.{c}, false) AS TINYINT) AS {c}" for c in C.BOOL_FEATURES]
    return ",\n  ".join(num + cat + boo)


def linear_ctes(seed: int = C.SEED) -> str:
    """split + med + imp (all rows imputed with train medians) + fit + pred."""
    return split_ctes(seed) + f""",
{medians_cte()},
imp AS (SELECT s.uid, s.id, s.part, s.price_pln, s.snapshot_month, s.latitude, s.longitude,
  {impute_select('s')}
FROM split s CROSS JOIN med),
fit AS (SELECT regr_slope(CAST(price_pln AS DOUBLE), square_meters) AS slope,
               regr_intercept(CAST(price_pln AS DOUBLE), square_meters) AS icpt
        FROM imp WHERE part = 'train'),
pred AS (SELECT i.*, fit.icpt + fit.slope * i.square_meters AS prediction FROM imp i CROSS JOIN fit)"""


def ridge_ctes(reg_param: float) -> str:
    """rpred(uid, part, price_pln, prediction): least squares with an L2 penalty on the standardised, encoded features of
    ``imp``: correlations of all pairs of features, and Gauss-Jordan steps over the list of their rows."""
    plain = "\n  UNION ALL ".join(f"SELECT uid, part, price_pln, '{c}' AS f, CAST({c} AS DOUBLE) AS x FROM imp"
                                 for c in (*C.NUMERIC_FEATURES, *C.BOOL_FEATURES))
    coded = "\n  UNION ALL ".join(f"SELECT uid, part, price_pln, '{c}=' || {c} AS f, 1.0 AS x FROM imp"
                                 for c in C.CATEGORICAL_FEATURES)
    return f""",
enc AS ({plain}
  UNION ALL {coded}),
feat AS (SELECT f, row_number() OVER (ORDER BY f) AS j FROM (SELECT DISTINCT f FROM enc WHERE part = 'train')),
e AS MATERIALIZED (SELECT uid, part, CAST(price_pln AS DOUBLE) AS y, j, x FROM enc JOIN feat USING (f)),
yy AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(CAST(price_pln AS DOUBLE)) AS my, stddev_pop(CAST(price_pln AS DOUBLE)) AS sy
       FROM imp WHERE part = 'train'),
mo AS (SELECT j, sum(x) / any_value(n) AS mu, sqrt(greatest(sum(x * x) / any_value(n) - (sum(x) / any_value(n)) ** 2, 0)) AS sd,
              sum(x * (y - my)) / any_value(n) AS cxy FROM e, yy WHERE part = 'train' GROUP BY j),
gr AS (SELECT a.j AS i, b.j AS j, sum(a.x * b.x) AS s FROM e a JOIN e b ON a.uid = b.uid
       WHERE a.part = 'train' AND b.part = 'train' GROUP BY a.j, b.j),
co AS (SELECT a.j AS i, b.j AS j, CASE WHEN a.sd * b.sd = 0 THEN 0.0
              ELSE (coalesce(s, 0) / n - a.mu * b.mu) / (a.sd * b.sd) END
              + CASE WHEN a.j = b.j THEN {reg_param!r} / sy ELSE 0.0 END AS v
       FROM mo a CROSS JOIN mo b CROSS JOIN yy LEFT JOIN gr ON gr.i = a.j AND gr.j = b.j),
rw AS (SELECT i, list_append(list(v ORDER BY co.j), any_value(CASE WHEN sd = 0 THEN 0.0 ELSE cxy / (sd * sy) END)) AS r
       FROM co JOIN mo ON mo.j = co.i CROSS JOIN yy GROUP BY i),
mat AS (SELECT list(r ORDER BY i) AS a, count(*) AS p FROM rw),
solved AS (SELECT list_reduce(list_prepend(a, list_transform(range(1, p + 1), lambda k: [[CAST(k AS DOUBLE)]])),
  lambda s, k: list_transform(range(1, p + 1), lambda i: list_transform(range(1, p + 2), lambda c:
    CASE WHEN i = k[1][1] THEN s[i][c] / s[i][i]
         ELSE s[i][c] - s[i][CAST(k[1][1] AS BIGINT)] * s[CAST(k[1][1] AS BIGINT)][c]
              / s[CAST(k[1][1] AS BIGINT)][CAST(k[1][1] AS BIGINT)] END))) AS a, p FROM mat),
wt AS (SELECT j, mu, sd, a[j][p + 1] AS w FROM mo CROSS JOIN solved),
base AS (SELECT sum(CASE WHEN sd = 0 THEN 0.0 ELSE w * mu / sd END) AS b FROM wt),
rpred AS (SELECT uid, part, y AS price_pln,
                 any_value(my) + any_value(sy) * (sum(CASE WHEN sd = 0 THEN 0.0 ELSE w * x / sd END) - any_value(b)) AS prediction
          FROM e JOIN wt USING (j) CROSS JOIN yy CROSS JOIN base GROUP BY uid, part, y)"""


def conformal_ctes(alpha: float = C.CONFORMAL_ALPHA, src: str = "pred") -> str:
    """cal residual order statistic at the 'higher' quantile rank -> qv(q, n_cal, rank)."""
    return f""",
cal AS (SELECT abs(CAST(price_pln AS DOUBLE) - prediction) AS r FROM {src} WHERE part = 'cal'),
ncal AS (SELECT count(*) AS n FROM cal),
kk AS (SELECT n, ceil(CAST(n + 1 AS DOUBLE) * CAST(1.0 - {alpha} AS DOUBLE)) AS k FROM ncal),
rr AS (SELECT n, CAST(ceil(CAST(n - 1 AS DOUBLE) * least(k / CAST(n AS DOUBLE), 1.0)) AS BIGINT) + 1 AS rnk FROM kk),
calr AS (SELECT r, row_number() OVER (ORDER BY r) AS rk FROM cal),
qv AS (SELECT calr.r AS q, rr.n AS n_cal, rr.rnk AS rnk FROM calr JOIN rr ON calr.rk = rr.rnk)"""


def metrics_select(y: str, p: str) -> str:
    e = f"(CAST({y} AS DOUBLE) - {p})"
    yy = f"CAST({y} AS DOUBLE)"
    return f"""round(avg(abs({e})), 4) AS mae,
  round(sqrt(avg({e} * {e})), 4) AS rmse,
  round(coalesce(avg(CASE WHEN {yy} <> 0 THEN abs({e} / {yy}) END), 0.0), 6) AS mape,
  round(CASE WHEN count(*) * var_pop({yy}) = 0 THEN 0.0
        ELSE 1 - sum({e} * {e}) / (count(*) * var_pop({yy})) END, 6) AS r2,
  CAST(count(*) AS BIGINT) AS n_samples"""

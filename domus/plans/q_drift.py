"""Queries: drift split, category shares, ECDFs, KS, PSI, verdicts, reports (L1–L8 and friends).

Drift columns are the 29 contract columns (ids and the month included, like the
reference job). Reference = all months before the latest one, current = the latest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus import constants as C
from domus.functions.stats import ks_pvalue_sql
from domus.operators import drift as D
from domus.operators.guards import row_count_guards
from domus.operators.split import half_split
from domus.plans.catalog import register
from domus.operators.monitoring import histogram_long
from domus.plans.drift_job import drift_by_month, drift_by_month_verdict, drift_job
from domus.session import materialize, scratch_path
from domus.sources.panel import panel, panel_sql
from domus.sources.snapshots import LISTING_TYPES
from pyspark.sql import types as T

COLS = list(C.LISTING_COLUMNS)
NUM = [c for c in COLS if isinstance(LISTING_TYPES[c], T.NumericType)]
CAT = [c for c in COLS if c not in NUM]
CATEGORICAL = list(C.CATEGORICAL_FEATURES)


def sided(spark: SparkSession, sf: str, cols: list[str] = COLS) -> DataFrame:
    """The panel's columns with their side; written once, as the split and each test read it."""
    return D.reference_current(materialize(panel(spark, sf).select(*dict.fromkeys([*cols, "snapshot_month", "uid"]))))


SIDED_SQL = panel_sql() + """,
sided AS (SELECT *, CASE WHEN snapshot_month = (SELECT max(snapshot_month) FROM panel)
                         THEN 'current' ELSE 'reference' END AS side FROM panel)"""


def _ks_sql(cols: list[str], src: str = "sided") -> str:
    longs = "\n  UNION ALL ".join(
        f"SELECT side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)
    return f""",
klong AS ({longs}),
kcnt AS (SELECT feature, value, sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) AS n_ref,
                sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) AS n_cur
         FROM klong WHERE value IS NOT NULL GROUP BY feature, value),
kcum AS (SELECT feature, value,
                sum(n_ref) OVER w AS rc, sum(n_cur) OVER w AS cc,
                sum(n_ref) OVER (PARTITION BY feature) AS tr, sum(n_cur) OVER (PARTITION BY feature) AS tc
         FROM kcnt WINDOW w AS (PARTITION BY feature ORDER BY value
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT feature, max(abs(CAST(rc AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc)) AS statistic,
              CAST(max(tr) AS BIGINT) AS n_ref, CAST(max(tc) AS BIGINT) AS n_cur
       FROM kcum GROUP BY feature),
ksp AS MATERIALIZED (SELECT *, {ks_pvalue_sql('statistic', 'n_ref', 'n_cur')} AS p_value FROM ks)"""


def _psi_sql(cols: list[str], src: str = "sided") -> str:
    longs = "\n  UNION ALL ".join(
        f"SELECT side, '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM {src}" for c in cols)
    return f""",
plong AS ({longs}),
pcnt AS (SELECT feature, category, sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) AS n_ref,
                sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) AS n_cur
         FROM plong GROUP BY feature, category),
ptot AS (SELECT feature, sum(n_ref) AS tr, sum(n_cur) AS tc FROM pcnt GROUP BY feature),
pshare AS (SELECT c.feature, c.category, c.n_ref, c.n_cur,
                  CASE WHEN tr > 0 THEN CAST(c.n_ref AS DOUBLE) / tr ELSE 0.0 END AS ref_share,
                  CASE WHEN tc > 0 THEN CAST(c.n_cur AS DOUBLE) / tc ELSE 0.0 END AS cur_share
           FROM pcnt c JOIN ptot t ON c.feature = t.feature),
psi AS (SELECT feature,
               sum(((cur_share + 1e-6) - (ref_share + 1e-6)) * ln((cur_share + 1e-6) / (ref_share + 1e-6))) AS psi,
               CAST(sum(n_ref) AS BIGINT) AS n_ref, CAST(sum(n_cur) AS BIGINT) AS n_cur
        FROM pshare GROUP BY feature)"""


def _pos_values(cols: list[str]) -> str:
    return ", ".join(f"('{c}', {i})" for i, c in enumerate(cols))


FEATURES_SQL = SIDED_SQL + _ks_sql(NUM) + _psi_sql(CAT) + f""",
pos AS (SELECT * FROM (VALUES {_pos_values(COLS)}) AS t(feature, position)),
feats AS (
  SELECT feature, 'ks' AS test, statistic, p_value, CAST({C.KS_P_VALUE_THRESHOLD!r} AS DOUBLE) AS threshold,
         p_value < {C.KS_P_VALUE_THRESHOLD!r} AS drifted, n_ref, n_cur FROM ksp
  UNION ALL
  SELECT feature, 'psi' AS test, psi AS statistic, CAST(NULL AS DOUBLE) AS p_value,
         CAST({C.PSI_THRESHOLD!r} AS DOUBLE) AS threshold, psi > {C.PSI_THRESHOLD!r} AS drifted, n_ref, n_cur FROM psi),
fp AS (SELECT f.*, pos.position FROM feats f JOIN pos ON f.feature = pos.feature)"""

VERDICT_SQL = FEATURES_SQL + f"""
SELECT CAST(count(*) AS BIGINT) AS n_features, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted,
       round(sum(CASE WHEN drifted THEN 1.0 ELSE 0.0 END) / count(*), 6) AS share_drifted,
       coalesce(string_agg(CASE WHEN drifted THEN feature END, ',' ORDER BY position), '') AS drifted_features,
       sum(CASE WHEN drifted THEN 1.0 ELSE 0.0 END) / count(*) >= {C.DATASET_DRIFT_SHARE!r} AS dataset_drift
FROM fp"""


def _round(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# --- F1 / D3 -----------------------------------------------------------------
@register("latest_month", panel_sql() + "\nSELECT max(snapshot_month) AS latest_month FROM panel")
def q_latest_month(spark: SparkSession, sf: str) -> DataFrame:
    """the latest snapshot month."""
    return spark.createDataFrame([(D.latest_month(panel(spark, sf)),)], "latest_month string")


@register("distinct_months", panel_sql() + "\nSELECT DISTINCT snapshot_month FROM panel")
def q_distinct_months(spark: SparkSession, sf: str) -> DataFrame:
    """D3: distinct snapshot months, sorted."""
    return D.distinct_months(panel(spark, sf))


# --- L1 / L2 / F3 ---------------------------------------------------------------
@register("reference_current_split", SIDED_SQL + "\nSELECT uid, side FROM sided")
def q_reference_current_split(spark: SparkSession, sf: str) -> DataFrame:
    """L1: latest month is current, all earlier months are reference."""
    return sided(spark, sf, []).select("uid", "side")


@register("single_month_split", panel_sql() + """
SELECT uid, CASE WHEN row_number() OVER (ORDER BY uid) <= count(*) OVER () // 2
                 THEN 'reference' ELSE 'current' END AS side FROM panel""")
def q_single_month_split(spark: SparkSession, sf: str) -> DataFrame:
    """L2: the whole panel as one snapshot: first half by uid is reference, the rest current."""
    one = materialize(panel(spark, sf).select("uid").withColumn("snapshot_month", F.lit("one")))
    return D.reference_current(one).select("uid", "side")


@register("half_split", panel_sql() + """
SELECT uid, CASE WHEN row_number() OVER (ORDER BY id, snapshot_month, uid) <= count(*) OVER () // 2
                 THEN 'reference' ELSE 'current' END AS side FROM panel""")
def q_half_split(spark: SparkSession, sf: str) -> DataFrame:
    """first n // 2 rows in (id, month, uid) order vs the rest."""
    return half_split(materialize(panel(spark, sf).select("uid", "id", "snapshot_month")), ["id", "snapshot_month", "uid"]).select("uid", "side")


# --- G3 / D9 ----------------------------------------------------------------------
@register("shared_columns", SIDED_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS position, '{c}' AS \"column\", count(CASE WHEN side = 'reference' THEN {c} END) AS n_ref, "
    f"count(CASE WHEN side = 'current' THEN {c} END) AS n_cur FROM sided" for k, c in enumerate(C.LISTING_COLUMNS)))
def q_shared_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns shared by the reference and current tables, each written and read back by itself, in reference
    order, with the values that each side has in them."""
    s = sided(spark, sf)
    root = scratch_path(spark, "sides")
    s.filter(F.col("side") == D.REF).drop("side", "uid").write.parquet(f"{root}/reference")
    s.filter(F.col("side") == D.CUR).drop("side").write.parquet(f"{root}/current")
    ref, cur = (spark.read.parquet(f"{root}/{n}") for n in ("reference", "current"))
    cols = D.shared_columns(ref.columns, cur.columns)
    filled = [df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "column", n)
              for df, n in ((ref, "n_ref"), (cur, "n_cur"))]
    order = spark.createDataFrame(list(enumerate(cols)), "position int, column string")
    return order.join(filled[0], "column").join(filled[1], "column").select("position", "column", "n_ref", "n_cur")


@register("row_count_guards", panel_sql() + """,
c AS (SELECT city, snapshot_month, count(*) AS n_rows FROM panel GROUP BY ALL),
s AS (SELECT *, CAST(round_even(n_rows * 0.2, 0) AS BIGINT) AS n_cal, CAST(round_even(n_rows * 0.2, 0) AS BIGINT) AS n_test FROM c)
SELECT city, snapshot_month, n_rows, n_rows - n_cal - n_test AS n_train, n_cal, n_test, n_rows >= 1 AS can_fit,
       n_rows >= 2 AS can_compare, least(n_rows - n_cal - n_test, n_cal, n_test) > 0 AS can_split FROM s""")
def q_row_count_guards(spark: SparkSession, sf: str) -> DataFrame:
    """For each city and month the rows, the sizes of an exact split, and the steps they suffice for."""
    return row_count_guards(panel(spark, sf), ["city", "snapshot_month"])


# --- D2 / G2 / C1 ------------------------------------------------------------------
def _cat_long_sql(cols: list[str], src: str) -> str:
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM {src}" for c in cols)


@register("category_shares", panel_sql() + f""",
lg AS ({_cat_long_sql(CATEGORICAL, 'panel')}),
cn AS (SELECT feature, category, count(*) AS n FROM lg GROUP BY feature, category)
SELECT feature, category, CAST(n AS BIGINT) AS n,
       round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY feature), 6) AS share FROM cn""")
def q_category_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised value counts of the 5 categorical columns (null is a value)."""
    out = D.category_shares(panel(spark, sf), CATEGORICAL)
    return _round(out.withColumn("n", F.col("n").cast("long")), ["share"])


@register("category_union", SIDED_SQL + f""",
lg AS ({_cat_long_sql(CATEGORICAL, "sided WHERE side = 'reference'")}
  UNION ALL {_cat_long_sql(CATEGORICAL, "sided WHERE side = 'current'")})
SELECT DISTINCT feature, category FROM lg""")
def q_category_union(spark: SparkSession, sf: str) -> DataFrame:
    """Union of the categories seen on either side (null included)."""
    s = sided(spark, sf, CATEGORICAL)
    ref = s.filter(F.col("side") == D.REF).select(*CATEGORICAL)
    cur = s.filter(F.col("side") == D.CUR).select(*CATEGORICAL)
    def long(df):
        return df.select(*[F.col(c).cast("string") for c in CATEGORICAL]).unpivot(
            [], CATEGORICAL, "feature", "category")
    return long(ref).union(long(cur)).distinct()


@register("category_share_compare", SIDED_SQL + _psi_sql(CATEGORICAL) + """
SELECT feature, category, round(ref_share, 6) AS ref_share, round(cur_share, 6) AS cur_share FROM pshare""")
def q_category_share_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Full outer match of reference and current category shares (missing = 0)."""
    cmp = D.share_compare(D.category_counts(sided(spark, sf, CATEGORICAL), CATEGORICAL))
    return _round(cmp.select("feature", "category", "ref_share", "cur_share"), ["ref_share", "cur_share"])


# --- E2 / L3 / L4 -------------------------------------------------------------------
@register("ecdf_two_sample", SIDED_SQL + _ks_sql(NUM) + """
SELECT feature, value, round(CAST(rc AS DOUBLE) / tr, 6) AS F_ref, round(CAST(cc AS DOUBLE) / tc, 6) AS F_cur
FROM kcum""")
def q_ecdf_two_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Both empirical CDFs at every observed value of every numeric column."""
    e = D.ecdf_two_sample(sided(spark, sf, NUM), NUM)
    return _round(e.select("feature", "value", "F_ref", "F_cur"), ["F_ref", "F_cur"])


@register("ks_test", SIDED_SQL + _ks_sql(NUM) + """
SELECT feature, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, n_ref, n_cur FROM ksp""")
def q_ks_test(spark: SparkSession, sf: str) -> DataFrame:
    """L3: two-sample KS statistic and p-value per numeric column."""
    k = D.ks_test(sided(spark, sf, NUM), NUM)
    return _round(k.select("feature", "statistic", "p_value", F.col("n_ref").cast("long"),
                           F.col("n_cur").cast("long")), ["statistic", "p_value"])


@register("psi", SIDED_SQL + _psi_sql(CAT) + """
SELECT feature, round(psi, 6) AS psi, n_ref, n_cur FROM psi""")
def q_psi(spark: SparkSession, sf: str) -> DataFrame:
    """L4: PSI per text/boolean column over the union of categories."""
    p = D.psi(sided(spark, sf, CAT), CAT)
    return _round(p.select("feature", "psi", F.col("n_ref").cast("long"), F.col("n_cur").cast("long")),
                  ["psi"])


# --- L5 / L6 / L7 --------------------------------------------------------------------
@register("drift_verdict", VERDICT_SQL)
def q_drift_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Dataset-level verdict over all 29 columns."""
    feats = D.drift_features(sided(spark, sf).select("side", *COLS), COLS)
    return D.drift_verdict(feats).withColumn("share_drifted", F.round("share_drifted", 6))


REPORT_COLS = ["ref_null_share", "ref_mean", "ref_std", "ref_min", "ref_max",
               "cur_null_share", "cur_mean", "cur_std", "cur_min", "cur_max"]


def _summary_sql() -> str:
    rows = []
    for c in NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts = []
        for s, t in (("reference", "ref"), ("current", "cur")):
            on = f"side = '{s}'"
            parts += [
                f"sum(CASE WHEN {on} AND {x} IS NULL THEN 1.0 ELSE 0.0 END) / sum(CASE WHEN {on} THEN 1.0 ELSE 0.0 END) AS {t}_null_share",
                f"avg(CASE WHEN {on} THEN {x} END) AS {t}_mean",
                f"stddev_samp(CASE WHEN {on} THEN {x} END) AS {t}_std",
                f"min(CASE WHEN {on} THEN {x} END) AS {t}_min",
                f"max(CASE WHEN {on} THEN {x} END) AS {t}_max"]
        rows.append(f"SELECT '{c}' AS feature, " + ", ".join(parts) + " FROM sided")
    return ",\nsumm AS (" + "\n  UNION ALL ".join(rows) + ")"


@register("drift_report_table", FEATURES_SQL + _summary_sql() + """
SELECT fp.feature, fp.position, fp.test, round(fp.statistic, 6) AS statistic, round(fp.p_value, 6) AS p_value,
       fp.threshold, fp.drifted, fp.n_ref, fp.n_cur, """ + ", ".join(f"round(s.{c}, 6) AS {c}" for c in REPORT_COLS) + """
FROM fp LEFT JOIN summ s ON fp.feature = s.feature""")
def q_drift_report_table(spark: SparkSession, sf: str) -> DataFrame:
    """Per-feature tests plus per-side null share, mean, std, min, max."""
    rep = D.drift_report_table(sided(spark, sf).select("side", *COLS), COLS, stored=True)
    return _round(rep.select("feature", "position", "test", "statistic", "p_value", "threshold", "drifted",
                             F.col("n_ref").cast("long"), F.col("n_cur").cast("long"), *REPORT_COLS),
                  ["statistic", "p_value", *REPORT_COLS])


@register("drift_job", VERDICT_SQL)
def q_drift_job(spark: SparkSession, sf: str) -> DataFrame:
    """Load -> split -> gate -> report, returning the verdict row."""
    _, verdict = drift_job(panel(spark, sf))
    return verdict.withColumn("share_drifted", F.round("share_drifted", 6))


# --- L8 --------------------------------------------------------------------------
def _by_month_sql() -> str:
    kl = "\n  UNION ALL ".join(
        f"SELECT snapshot_month AS mon, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM panel" for c in NUM)
    pl = "\n  UNION ALL ".join(
        f"SELECT snapshot_month AS mon, '{c}' AS feature, CAST({c} AS VARCHAR) AS category FROM panel"
        for c in CAT)
    return panel_sql() + f""",
months AS (SELECT DISTINCT snapshot_month AS m FROM panel),
kl AS ({kl}),
kc AS (SELECT feature, value, mon, count(*) AS cnt FROM kl WHERE value IS NOT NULL GROUP BY feature, value, mon),
kj AS (SELECT months.m AS month, kc.feature, kc.value,
              sum(CASE WHEN kc.mon < months.m THEN cnt ELSE 0 END) AS r,
              sum(CASE WHEN kc.mon = months.m THEN cnt ELSE 0 END) AS c
       FROM months JOIN kc ON kc.mon <= months.m GROUP BY months.m, kc.feature, kc.value),
kw AS (SELECT month, feature, sum(r) OVER w AS rc, sum(c) OVER w AS cc,
              sum(r) OVER (PARTITION BY month, feature) AS tr, sum(c) OVER (PARTITION BY month, feature) AS tc
       FROM kj WINDOW w AS (PARTITION BY month, feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT month, feature, max(abs(CAST(rc AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc)) AS statistic,
              CAST(max(tr) AS BIGINT) AS n_ref, CAST(max(tc) AS BIGINT) AS n_cur
       FROM kw WHERE tr > 0 AND tc > 0 GROUP BY month, feature),
ksp AS MATERIALIZED (SELECT *, {ks_pvalue_sql('statistic', 'n_ref', 'n_cur')} AS p_value FROM ks),
pl AS ({pl}),
pc AS (SELECT feature, category, mon, count(*) AS cnt FROM pl GROUP BY feature, category, mon),
pj AS (SELECT months.m AS month, pc.feature, pc.category,
              sum(CASE WHEN pc.mon < months.m THEN cnt ELSE 0 END) AS r,
              sum(CASE WHEN pc.mon = months.m THEN cnt ELSE 0 END) AS c
       FROM months JOIN pc ON pc.mon <= months.m GROUP BY months.m, pc.feature, pc.category),
pt AS (SELECT month, feature, sum(r) AS tr, sum(c) AS tc FROM pj GROUP BY month, feature),
ps AS (SELECT pj.month, pj.feature,
              sum(((CAST(c AS DOUBLE) / tc + 1e-6) - (CAST(r AS DOUBLE) / tr + 1e-6))
                  * ln((CAST(c AS DOUBLE) / tc + 1e-6) / (CAST(r AS DOUBLE) / tr + 1e-6))) AS psi,
              CAST(max(tr) AS BIGINT) AS n_ref, CAST(max(tc) AS BIGINT) AS n_cur
       FROM pj JOIN pt ON pj.month = pt.month AND pj.feature = pt.feature
       WHERE tr > 0 AND tc > 0 GROUP BY pj.month, pj.feature)
SELECT month AS snapshot_month, feature, 'ks' AS test, round(statistic, 6) AS statistic,
       round(p_value, 6) AS p_value, n_ref, n_cur, p_value < {C.KS_P_VALUE_THRESHOLD!r} AS drifted FROM ksp
UNION ALL
SELECT month AS snapshot_month, feature, 'psi' AS test, round(psi, 6) AS statistic,
       CAST(NULL AS DOUBLE) AS p_value, n_ref, n_cur, psi > {C.PSI_THRESHOLD!r} AS drifted FROM ps"""


@register("drift_by_month", _by_month_sql())
def q_drift_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """Every month against all earlier months, KS/PSI for all 29 columns."""
    out = drift_by_month(panel(spark, sf), COLS)
    return _round(out, ["statistic", "p_value"])


def _share_histogram_sql() -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT '{b}' AS le, CAST(sum(CASE WHEN share <= {b!r} THEN 1 ELSE 0 END) AS BIGINT) AS n FROM v"
        for b in C.DRIFT_SHARE_BUCKETS)
    return (f"WITH pf AS ({_by_month_sql()}),\n"
            "v AS (SELECT snapshot_month, avg(CASE WHEN drifted THEN 1.0 ELSE 0.0 END) AS share FROM pf GROUP BY 1),\n"
            f"h AS ({rows}\nUNION ALL SELECT '+Inf' AS le, count(*) AS n FROM v)\n"
            "SELECT le, n, (SELECT count(*) FROM v) AS count, (SELECT round(sum(share), 6) FROM v) AS sum FROM h")


@register("drift_share_histogram", _share_histogram_sql())
def q_drift_share_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """D8 over L8: histogram of the share of drifted columns of each month."""
    months = drift_by_month_verdict(drift_by_month(panel(spark, sf), COLS))
    h = histogram_long(months, F.col("share_drifted"), C.DRIFT_SHARE_BUCKETS)
    return h.select("le", F.col("n").cast("long"), F.col("count").cast("long"), F.round("sum", 6).alias("sum"))

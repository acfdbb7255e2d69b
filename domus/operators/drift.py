"""Drift operators: F1 latest_month, D3 distinct_months, L1/L2 reference-current split,
G3 shared_columns, D2 category_shares, G2 category_union, C1 category_share_compare,
E2 ecdf_two_sample, L3 ks_test, L4 psi, L5 drift_verdict, L6 drift_report_table.

Shape of the computation (one scan, all columns at once):

- rows carry a ``side`` column ('reference' / 'current') instead of being split in two;
- numeric columns are unpivoted to (feature, value) and collapsed to distinct values with
  per-side counts (map-side partial aggregation: a value repeated on a third of all rows
  is one row after the combine) and written once; the two empirical CDFs are running sums over
  those distinct values, computed with ``running_totals`` (buckets cut on (feature, value),
  so one feature never lands in one task); D = max |F_ref - F_cur| per feature;
- text/boolean columns are unpivoted to (feature, category) with per-side counts — the
  full outer match of the two category maps is one ``groupBy``, null is a category;
- per-feature totals are one row per column, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus import constants as C
from domus.errors import MonitoringError
from domus.functions.stats import ks_pvalue, log_ratio
from domus.operators.guards import LEAST_TWO_SIDES, require_rows
from domus.operators.rank import running_totals
from domus.operators.split import half_split
from domus.session import materialize

REF, CUR = "reference", "current"


def latest_month(df: DataFrame, month_col: str = "snapshot_month") -> str | None:
    """max month (one scalar aggregate)."""
    return df.agg(F.max(month_col)).collect()[0][0]


def distinct_months(df: DataFrame, month_col: str = "snapshot_month") -> DataFrame:
    """D3: distinct months, sorted."""
    return df.select(month_col).distinct().orderBy(month_col)


def reference_current(df: DataFrame, month_col: str = "snapshot_month",
                      order_cols: tuple[str, ...] = ("uid",), side_col: str = "side") -> DataFrame:
    """L1/L2: with more than one month, current = latest month and reference = the rest;
    with one month, the first half in ``order_cols`` order is reference (F3)."""
    row = df.agg(F.count_distinct(month_col).alias("m"), F.max(month_col).alias("latest"),
                 F.count(F.lit(1)).alias("n")).collect()[0]
    require_rows(row["n"], LEAST_TWO_SIDES, "a comparison of two sides", MonitoringError)
    if row["m"] > 1:
        return df.withColumn(side_col, F.when(F.col(month_col) == row["latest"], F.lit(CUR))
                             .otherwise(F.lit(REF)))
    return half_split(df, list(order_cols), side_col, n=row["n"])


def shared_columns(reference_cols: list[str], current_cols: list[str]) -> list[str]:
    """Columns present on both sides, in reference order; none -> error."""
    shared = [c for c in reference_cols if c in current_cols]
    if not shared:
        raise MonitoringError("the two sides have no column in common")
    return shared


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers are tested with KS; booleans and text with PSI."""
    return isinstance(dtype, T.NumericType)


def split_columns(df: DataFrame, cols: list[str]) -> tuple[list[str], list[str]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if is_numeric(types[c])]
    cat = [c for c in cols if not is_numeric(types[c])]
    return num, cat


def category_counts(df: DataFrame, cols: list[str], side_col: str = "side") -> DataFrame:
    """D2/G2/C1 core: (feature, category, n_ref, n_cur) over the union of categories of both
    sides, null counted as a category — one unpivot and one aggregate for all columns."""
    return _counts(df, cols, side_col, "category", "string", nulls=True)


def _counts(df: DataFrame, cols: list[str], side_col: str, value: str, kind: str, nulls: bool) -> DataFrame:
    """(feature, value, n_ref, n_cur). Columns travel by number and get their names after the count."""
    numbered = df.select((F.col(side_col) == REF).alias("_ref"), (F.col(side_col) == CUR).alias("_cur"),
                         *[F.col(c).cast(kind).alias(str(k)) for k, c in enumerate(cols)])
    long = numbered.unpivot(["_ref", "_cur"], [str(k) for k in range(len(cols))], "_k", value)
    long = long.withColumn("_k", F.col("_k").cast("int"))
    if not nulls:
        long = long.where(F.col(value).isNotNull())
    counts = long.groupBy("_k", value).agg(F.sum(F.col("_ref").cast("long")).alias("n_ref"),
                                           F.sum(F.col("_cur").cast("long")).alias("n_cur"))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_k") + 1)
    return counts.select(name.alias("feature"), value, "n_ref", "n_cur")


def category_shares(df: DataFrame, cols: list[str]) -> DataFrame:
    """Normalised value counts (feature, category, n, share), null is a value."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "category")
    counts = long.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("_tot"))
    return (counts.join(F.broadcast(totals), "feature")
            .withColumn("share", F.col("n") / F.col("_tot")).drop("_tot"))


def share_compare(counts: DataFrame) -> DataFrame:
    """(feature, category, ref_share, cur_share) with 0 for a side that lacks it."""
    totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("_tr"), F.sum("n_cur").alias("_tc"))
    return (counts.join(F.broadcast(totals), "feature")
            .withColumn("ref_share", F.when(F.col("_tr") > 0, F.col("n_ref") / F.col("_tr")).otherwise(0.0))
            .withColumn("cur_share", F.when(F.col("_tc") > 0, F.col("n_cur") / F.col("_tc")).otherwise(0.0))
            .drop("_tr", "_tc"))


def psi(df: DataFrame, cols: list[str], side_col: str = "side") -> DataFrame:
    """L4: (feature, psi, n_ref, n_cur) — sum over the union of categories of
    (c - r) * ln(c / r), eps added to both shares."""
    # the totals and the shares read the counts
    cmp = share_compare(materialize(category_counts(df, cols, side_col)))
    return cmp.groupBy("feature").agg(
        F.sum(log_ratio(F.col("cur_share"), F.col("ref_share"))).alias("psi"),
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def value_counts(df: DataFrame, cols: list[str], side_col: str = "side") -> DataFrame:
    """(feature, value, n_ref, n_cur) over distinct non-null numeric values."""
    # nulls go, as in the test itself; ``ks_test`` keeps a feature without values
    return _counts(df, cols, side_col, "value", "double", nulls=False)


def ecdf_two_sample(df: DataFrame, cols: list[str], side_col: str = "side") -> DataFrame:
    """Both empirical CDFs at every observed value, per feature:
    (feature, value, F_ref, F_cur)."""
    vc = materialize(value_counts(df, cols, side_col))
    cum = running_totals(vc, ["feature"], ["value"], ["n_ref", "n_cur"])
    totals = vc.groupBy("feature").agg(F.sum("n_ref").alias("_tr"), F.sum("n_cur").alias("_tc"))
    return (cum.join(F.broadcast(totals), "feature").select(
        "feature", "value",
        F.when(F.col("_tr") > 0, F.col("n_ref_cum") / F.col("_tr")).alias("F_ref"),
        F.when(F.col("_tc") > 0, F.col("n_cur_cum") / F.col("_tc")).alias("F_cur"),
        F.col("_tr").alias("n_ref"), F.col("_tc").alias("n_cur")))


def ks_test(df: DataFrame, cols: list[str], side_col: str = "side") -> DataFrame:
    """L3: (feature, statistic, p_value, n_ref, n_cur) per numeric column, nulls dropped. A column without values
    on a side can't be tested: its statistic and p-value are null, it stays in the table."""
    e = ecdf_two_sample(df, cols, side_col)
    d = e.groupBy("feature").agg(F.max(F.abs(F.col("F_ref") - F.col("F_cur"))).alias("statistic"),
                                 F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    d = every.join(d, "feature", "left").withColumns(
        {n: F.coalesce(n, F.lit(0)).cast("long") for n in ("n_ref", "n_cur")})
    return d.withColumn("p_value", ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_cur")))


def drift_features(df: DataFrame, cols: list[str] | None = None, side_col: str = "side",
                   p_threshold: float = C.KS_P_VALUE_THRESHOLD,
                   psi_threshold: float = C.PSI_THRESHOLD) -> DataFrame:
    """Per-feature verdicts: (position, feature, test, statistic, p_value, threshold, drifted).

    ``cols`` defaults to every column but ``side_col`` (the reference passes them all,
    ids and month included); position is the column's place in that list.
    """
    cols = cols or [c for c in df.columns if c != side_col]
    num, cat = split_columns(df, cols)
    pos = {c: i for i, c in enumerate(cols)}
    spark = df.sparkSession
    pos_df = spark.createDataFrame(list(pos.items()), "feature string, position int")
    parts = []
    if num:
        k = ks_test(df, num, side_col)
        parts.append(k.select("feature", F.lit("ks").alias("test"), "statistic", "p_value",
                              F.lit(p_threshold).alias("threshold"),
                              (F.col("p_value") < p_threshold).alias("drifted"), "n_ref", "n_cur"))
    if cat:
        p = psi(df, cat, side_col)
        parts.append(p.select("feature", F.lit("psi").alias("test"), F.col("psi").alias("statistic"),
                              F.lit(None).cast("double").alias("p_value"),
                              F.lit(psi_threshold).alias("threshold"),
                              (F.col("psi") > psi_threshold).alias("drifted"), "n_ref", "n_cur"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # one row per column: the position table is bounded by the column count
    return out.join(F.broadcast(pos_df), "feature")


def drift_verdict(features: DataFrame, dataset_share: float = C.DATASET_DRIFT_SHARE) -> DataFrame:
    """share = drifted / shared; dataset drift when share >= threshold; drifted names
    joined in column order."""
    named = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct("position", "feature"))))
    return features.agg(
        F.count(F.lit(1)).cast("long").alias("n_features"),
        F.sum(F.col("drifted").cast("long")).alias("n_drifted"),
        (F.sum(F.col("drifted").cast("double")) / F.count(F.lit(1))).alias("share_drifted"),
        F.array_join(F.transform(named, lambda s: s["feature"]), ",").alias("drifted_features"),
    ).withColumn("dataset_drift", F.col("share_drifted") >= dataset_share)


def side_summary(df: DataFrame, num_cols: list[str], side_col: str = "side") -> DataFrame:
    """L6 part: per numeric feature and side: null share, mean, std, min, max (one aggregate)."""
    aggs = []
    for c in num_cols:
        x = F.col(c).cast("double")
        for s, tag in ((REF, "ref"), (CUR, "cur")):
            on = F.col(side_col) == s
            xs = F.when(on, x)
            aggs += [
                (F.sum((on & x.isNull()).cast("double")) / F.sum(on.cast("double"))).alias(f"{c}|{tag}_null_share"),
                F.avg(xs).alias(f"{c}|{tag}_mean"), F.stddev_samp(xs).alias(f"{c}|{tag}_std"),
                F.min(xs).alias(f"{c}|{tag}_min"), F.max(xs).alias(f"{c}|{tag}_max")]
    wide = df.agg(*aggs)
    stats = ["null_share", "mean", "std", "min", "max"]
    rows = ", ".join(
        f"'{c}', " + ", ".join(f"`{c}|{t}_{s}`" for t in ("ref", "cur") for s in stats) for c in num_cols)
    names = ", ".join(f"{t}_{s}" for t in ("ref", "cur") for s in stats)
    return wide.selectExpr(f"stack({len(num_cols)}, {rows}) AS (feature, {names})")


def drift_report_table(df: DataFrame, cols: list[str] | None = None, side_col: str = "side",
                       p_threshold: float = C.KS_P_VALUE_THRESHOLD,
                       psi_threshold: float = C.PSI_THRESHOLD, stored: bool = False) -> DataFrame:
    """Per-feature test results plus per-side summaries for numeric features. Both tests and the summary read the
    rows: they are written first, unless the caller says that they are a projection of a written table (``stored``)."""
    cols = cols or [c for c in df.columns if c != side_col]
    if not stored:
        df = materialize(df.select(side_col, *cols))
    feats = drift_features(df, cols, side_col, p_threshold, psi_threshold)
    num, _ = split_columns(df, cols)
    if not num:
        return feats
    return feats.join(F.broadcast(side_summary(df, num, side_col)), "feature", "left")

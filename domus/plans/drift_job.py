"""L7 drift_job and L8 drift_by_month.

L7: load -> reference/current split -> per-feature KS/PSI -> verdict -> report table.

L8 compares every month with *all earlier months*, for all months at once, without
rescanning per month, without pairing rows and without a vector of months for each value. Counts of
(feature, value, month) are written once, and a month is touched only where its counts change:

- KS: between two values of month i its own CDF stands still while that of the earlier months rises, so
  |F_ref - F_cur| is largest at a value of month i or just before one. Each row (feature, value, month i) needs
  two numbers: what month i has up to this value, and what all months before i have. The months are laid
  out in blocks of about the root of their number; running sums for each block, and for each month within
  the row's block, give both in two window passes over the same buckets of (feature, value).
- PSI: a category that month i lacks adds a term that depends on its earlier count alone. Spells in which a
  category has one earlier count are collapsed by (count, first month, last month) before they are spread over
  their months, so millions of ids seen once are a few rows; months in which a category occurs are
  terms of their own.

Buckets are cut at sampled literal boundaries (``rank``); a bucket's sums from earlier buckets come from a table
of at most (buckets + features) x months rows, summed up in the driver and broadcast. The number of columns is
bounded by the table's width.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import MonitoringError
from domus.functions.stats import ks_pvalue, log_ratio
from domus.operators import drift as D
from domus.operators.rank import _BUCKET_COL, with_range_buckets
from domus.operators.split import default_key, key_columns
from domus.session import materialize


def drift_job(df: DataFrame, cols: list[str] | None = None, exclude: tuple[str, ...] = (),
              month_col: str = "snapshot_month", order_cols: tuple[str, ...] | None = None,
              p_threshold: float = C.KS_P_VALUE_THRESHOLD, psi_threshold: float = C.PSI_THRESHOLD,
              dataset_share: float = C.DATASET_DRIFT_SHARE):
    """Returns (per-feature report DataFrame, verdict DataFrame).

    ``cols`` defaults to every column but the row number ``uid`` and ``exclude``: ids and the month are
    tested unless excluded. ``order_cols`` (the key that halves a single month) defaults to ``uid`` where
    there is one, else (id, snapshot_month).
    """
    order_cols = order_cols or tuple(key_columns(default_key(df)))
    wanted = cols or [c for c in df.columns if c != "uid"]
    cols = D.shared_columns([c for c in wanted if c not in exclude], df.columns)
    # the split reads the rows as well as the tests: they are written before it
    df = materialize(df.select(*dict.fromkeys([*cols, month_col, *[c for c in order_cols if c in df.columns]])))
    sided = D.reference_current(df, month_col, order_cols)
    report = D.drift_report_table(sided.select("side", *cols), cols, "side", p_threshold, psi_threshold, stored=True)
    verdict = D.drift_verdict(report, dataset_share)
    return report, verdict


def _months(df: DataFrame, month_col: str) -> list[str]:
    months = [r[0] for r in D.distinct_months(df, month_col).collect()]
    if len(months) < 2:
        raise MonitoringError("drift by month needs at least two months")
    return months


def _month_idx(month_col: str, months: list[str]):
    return (F.array_position(F.array(*[F.lit(m) for m in months]), F.col(month_col)) - 1).cast("int")


def _month_totals(counts: DataFrame) -> DataFrame:
    """feature, month_idx, n_cur, n_ref (rows of all earlier months); a row for each column and month."""
    totals = counts.groupBy("feature", "month_idx").agg(F.sum("cnt").alias("n_cur"))
    before = Window.partitionBy("feature").orderBy("month_idx").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("n_ref", F.coalesce(F.sum("n_cur").over(before), F.lit(0)))


def _earlier_buckets(b: DataFrame, months: int) -> DataFrame:
    """For each bucket, feature and month that has rows there: ``own0``, the month's rows in the feature's earlier buckets,
    and ``ref0``, those of all earlier months. At most (buckets + features) x months rows, summed up in the driver."""
    rows = b.groupBy("feature", _BUCKET_COL, "month_idx").agg(F.sum("cnt")).collect()
    place = {key: k for k, key in enumerate(sorted({(r[0], r[1]) for r in rows}))}
    table = np.zeros((len(place), months), np.int64)
    for f, bucket, month, cnt in rows:
        table[place[f, bucket], month] = cnt
    features = [f for f, _ in place]
    starts = [k for k, f in enumerate(features) if k == 0 or f != features[k - 1]]
    out = []
    for start, end in zip(starts, [*starts[1:], len(features)], strict=True):
        part = table[start:end]
        table[start:end] = np.cumsum(part, axis=0) - part
    ref = np.cumsum(table, axis=1) - table
    for f, bucket, month, _ in rows:
        k = place[f, bucket]
        out.append((f, bucket, month, int(table[k, month]), int(ref[k, month])))
    return b.sparkSession.createDataFrame(out, f"feature string, {_BUCKET_COL} long, month_idx int, own0 long, ref0 long")


def _ks_by_month(counts: DataFrame, months: int) -> DataFrame:
    """feature, month_idx, statistic, n_ref, n_cur from written counts of (feature, value, month_idx)."""
    width = math.isqrt(max(months - 1, 0)) + 1
    b = with_range_buckets(counts, ["feature", "value"])
    early = _earlier_buckets(b, months)
    block, inner = F.floor(F.col("month_idx") / width).cast("int"), (F.col("month_idx") % width).cast("int")
    b = b.withColumns({"block": block, "inner": inner})

    def running(keys: list[str], of: Column) -> Column:
        w = Window.partitionBy(_BUCKET_COL, "feature", *keys).orderBy("value")
        return F.sum(F.when(of, F.col("cnt"))).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))

    def total(parts: list[Column]) -> Column:
        out = F.lit(0)
        for p in parts:
            out = out + F.coalesce(p, F.lit(0))
        return out

    # earlier months with rows at this very value: what just before the value doesn't count yet
    at = Window.partitionBy(_BUCKET_COL, "feature", "value").orderBy("month_idx").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("here", F.coalesce(F.sum("cnt").over(at), F.lit(0)))
    n_blocks = (months - 1) // width + 1
    b = b.withColumns({f"block{k}": running([], F.col("block") == k) for k in range(n_blocks - 1)})
    b = b.withColumn("ref", total([F.when(F.col("block") > k, F.col(f"block{k}")) for k in range(n_blocks - 1)]))
    b = b.select("feature", _BUCKET_COL, "value", "month_idx", "cnt", "block", "inner", "ref", "here")
    b = b.withColumns({f"month{k}": running(["block"], F.col("inner") == k) for k in range(width)})
    ref = F.col("ref") + total([F.when(F.col("inner") > k, F.col(f"month{k}")) for k in range(width - 1)])
    own = total([F.when(F.col("inner") == k, F.col(f"month{k}")) for k in range(width)])
    b = b.select("feature", _BUCKET_COL, "month_idx", "cnt", "here", ref.alias("ref"), own.alias("own"))
    b = b.join(F.broadcast(early), ["feature", _BUCKET_COL, "month_idx"]).join(
        F.broadcast(_month_totals(counts)), ["feature", "month_idx"]).filter("n_ref > 0")
    ref, own = F.col("ref") + F.col("ref0"), F.col("own") + F.col("own0")
    apart = F.abs(ref / F.col("n_ref") - own / F.col("n_cur"))
    before = F.abs((ref - F.col("here")) / F.col("n_ref") - (own - F.col("cnt")) / F.col("n_cur"))
    return b.groupBy("feature", "month_idx").agg(F.max(F.greatest(apart, before)).alias("statistic"),
                                                 F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))


def _psi_by_month(counts: DataFrame, months: int) -> DataFrame:
    """feature, month_idx, statistic, n_ref, n_cur from written counts of (feature, category, month_idx)."""
    w = Window.partitionBy("feature", "category").orderBy("month_idx")
    seen = counts.select(
        "feature", "month_idx", "cnt",
        F.coalesce(F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
        (F.coalesce(F.lead("month_idx").over(w), F.lit(months)) - 1).alias("until"))
    present = seen.groupBy("feature", "month_idx", "earlier", "cnt").agg(F.count(F.lit(1)).alias("times"))
    # spells without the category: its earlier count stands still from the month after this one
    spells = seen.filter(F.col("until") > F.col("month_idx")).groupBy(
        "feature", (F.col("earlier") + F.col("cnt")).alias("earlier"), (F.col("month_idx") + 1).alias("first"),
        "until").agg(F.count(F.lit(1)).alias("times"))
    absent = spells.select("feature", F.explode(F.sequence("first", "until")).alias("month_idx"), "earlier",
                           F.lit(0).cast("long").alias("cnt"), "times")
    terms = present.unionByName(absent).groupBy("feature", "month_idx", "earlier", "cnt").agg(F.sum("times").alias("times"))
    terms = terms.join(F.broadcast(_month_totals(counts)), ["feature", "month_idx"]).filter("n_ref > 0")
    term = log_ratio(F.col("cnt") / F.col("n_cur"), F.col("earlier") / F.col("n_ref"), C.PSI_EPS)
    return terms.groupBy("feature", "month_idx").agg(F.sum(term * F.col("times")).alias("statistic"),
                                                     F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))


def drift_by_month(df: DataFrame, cols: list[str] | None = None, month_col: str = "snapshot_month",
                   exclude: tuple[str, ...] = ("uid",), p_threshold: float = C.KS_P_VALUE_THRESHOLD,
                   psi_threshold: float = C.PSI_THRESHOLD) -> DataFrame:
    """(snapshot_month, feature, test, statistic, p_value, n_ref, n_cur, drifted) for every
    month after the first, each month against all earlier months."""
    spark = df.sparkSession
    cols = [c for c in (cols or df.columns) if c not in exclude]
    num, cat = D.split_columns(df, cols)
    # one written table of the tested columns: the months and both families of counts read it
    df = materialize(df.select(F.col(month_col).alias("_month"), *[F.col(c).cast("double").alias(f"n{k}") for k, c in enumerate(num)],
                               *[F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(cat)]))
    months = _months(df, "_month")
    m = len(months)
    base = df.withColumn("month_idx", _month_idx("_month", months))

    def counted(names: list[str], tag: str, value: str, nulls: bool) -> DataFrame:
        label = F.element_at(F.array(*[F.lit(c) for c in names]), F.substring("k", 2, 9).cast("int") + 1).alias("feature")
        long = base.unpivot(["month_idx"], [f"{tag}{k}" for k in range(len(names))], "k", value)
        if not nulls:
            long = long.filter(F.col(value).isNotNull())
        counts = long.groupBy("k", value, "month_idx").agg(F.count(F.lit(1)).alias("cnt"))
        return materialize(counts.select(label, value, "month_idx", "cnt"))

    parts = []
    if num:
        ks = _ks_by_month(counted(num, "n", "value", nulls=False), m)
        parts.append(ks.select("feature", "month_idx", F.lit("ks").alias("test"), "statistic",
                               ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_cur")).alias("p_value"),
                               "n_ref", "n_cur"))
    if cat:
        p = _psi_by_month(counted(cat, "c", "category", nulls=True), m)
        parts.append(p.select("feature", "month_idx", F.lit("psi").alias("test"), "statistic",
                              F.lit(None).cast("double").alias("p_value"), "n_ref", "n_cur"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # every feature has a row for every month: one without a statistic had no values on a side
    every = spark.createDataFrame([(c, i, t) for t, cs in (("ks", num), ("psi", cat)) for c in cs for i in range(1, m)],
                                  "feature string, month_idx int, test string")
    out = every.join(out, ["feature", "month_idx", "test"], "left")
    drifted = (F.when(F.col("test") == "ks", F.col("p_value") < p_threshold)
               .otherwise(F.col("statistic") > psi_threshold))
    month_name = F.element_at(F.array(*[F.lit(x) for x in months]), F.col("month_idx") + 1)
    return out.select(month_name.alias(month_col), "feature", "test", "statistic", "p_value",
                      F.col("n_ref").cast("long"), F.col("n_cur").cast("long"), drifted.alias("drifted"))


def drift_by_month_verdict(per_feature: DataFrame, month_col: str = "snapshot_month",
                           dataset_share: float = C.DATASET_DRIFT_SHARE) -> DataFrame:
    """Per-month L5 verdict over the L8 rows."""
    return per_feature.groupBy(month_col).agg(
        F.count(F.lit(1)).cast("long").alias("n_features"),
        F.sum(F.col("drifted").cast("long")).alias("n_drifted"),
        (F.sum(F.col("drifted").cast("double")) / F.count(F.lit(1))).alias("share_drifted"),
    ).withColumn("dataset_drift", F.col("share_drifted") >= dataset_share)


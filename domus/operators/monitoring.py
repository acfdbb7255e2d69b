"""Scoring-outcome monitoring: D7 outcome_counts, D8 bucket_histogram, H23 json_request.

``ok``/``error`` counts always carry both series (right join to the two-label dimension);
histograms are cumulative (``le``) with ``+Inf``, count and sum — one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus import constants as C

# FIXED VALUES: default latency buckets of the metrics client (seconds)
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def outcome_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(o,) for o in C.OUTCOMES], "outcome string")


def outcome_counts(df: DataFrame, outcome: Column, by: list[str] | None = None) -> DataFrame:
    """(outcome, n) with both outcomes present even when one has no rows."""
    counts = df.groupBy(*(by or []), outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    dim = outcome_dim(df.sparkSession)
    if by:
        # every key gets both labels: a fixed fan-out of 2, no cross join
        labels = F.explode(F.array(*[F.lit(o) for o in C.OUTCOMES])).alias("outcome")
        keys = counts.select(*by).distinct().select(*by, labels)
        return keys.join(counts, [*by, "outcome"], "left").fillna(0, ["n"])
    return dim.join(F.broadcast(counts), "outcome", "left").fillna(0, ["n"])  # a row per outcome at most


def histogram(df: DataFrame, value: Column, buckets: tuple[float, ...] = LATENCY_BUCKETS,
              by: list[str] | None = None) -> DataFrame:
    """Cumulative bucket counts ``le_<b>`` for each bound, ``le_inf``, count and sum."""
    aggs = [F.sum((value <= F.lit(b)).cast("long")).alias(f"le_{b}") for b in buckets]
    aggs += [F.count(value).alias("le_inf"), F.count(value).alias("count"), F.sum(value).alias("sum")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def histogram_long(df: DataFrame, value: Column, buckets: tuple[float, ...] = LATENCY_BUCKETS) -> DataFrame:
    """D8 in long form: (le, n) rows for each bound plus '+Inf' (one aggregate + unpivot)."""
    wide = histogram(df, value, buckets)
    stack = ", ".join([f"'{b}', `le_{b}`" for b in buckets] + ["'+Inf', `le_inf`"])
    return wide.selectExpr(f"stack({len(buckets) + 1}, {stack}) AS (le, n)", "count", "sum")


PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType(), True)])


def parse_json(col: Column, schema: T.StructType = PROPS_SCHEMA) -> Column:
    """JSON text -> struct (PERMISSIVE: malformed text gives nulls, not a failure)."""
    return F.from_json(col, schema, {"mode": "PERMISSIVE"})


def to_json(*cols: str) -> Column:
    """Request columns -> JSON text."""
    return F.to_json(F.struct(*cols))

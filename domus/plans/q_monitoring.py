"""Queries: scoring outcome monitoring on the events table.

``event_type = 'error'`` is an error outcome, every other event is ok; ``value`` is the
latency of ok requests; ``props`` is the request JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.operators import monitoring as M
from domus.plans.catalog import register
from domus.sources.panel import table

def outcome_col():
    return F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("ok"))


OUTCOME_SQL = "CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END"


@register("outcome_counts", f"""
WITH c AS (SELECT CAST(ts AS DATE) AS day, {OUTCOME_SQL} AS outcome, count(*) AS n FROM events GROUP BY ALL),
d AS (SELECT DISTINCT day FROM c),
o AS (SELECT * FROM (VALUES ('ok'), ('error')) AS t(outcome))
SELECT d.day, o.outcome, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM d CROSS JOIN o LEFT JOIN c ON c.day = d.day AND c.outcome = o.outcome""")
def q_outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ok/error counts per day, both series always present."""
    ev = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    out = M.outcome_counts(ev, outcome_col(), by=["day"])
    return out.select("day", "outcome", F.col("n").cast("long"))


def _hist_sql() -> str:
    parts = [f"SELECT '{b}' AS le, CAST(sum(CASE WHEN value <= {b!r} THEN 1 ELSE 0 END) AS BIGINT) AS n FROM ok"
             for b in M.LATENCY_BUCKETS]
    parts.append("SELECT '+Inf' AS le, CAST(count(value) AS BIGINT) AS n FROM ok")
    return ("WITH ok AS (SELECT value FROM events WHERE event_type <> 'error'),\n"
            "h AS (" + "\n UNION ALL ".join(parts) + ")\n"
            "SELECT h.le, h.n, (SELECT CAST(count(value) AS BIGINT) FROM ok) AS count,\n"
            "       (SELECT round(sum(value), 4) FROM ok) AS sum FROM h")


@register("bucket_histogram", _hist_sql())
def q_bucket_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Cumulative latency histogram (le buckets, +Inf, count, sum) of ok requests."""
    ev = table(spark, sf, "events").filter(F.col("event_type") != "error")
    h = M.histogram_long(ev, F.col("value"))
    return h.select("le", F.col("n").cast("long"), F.col("count").cast("long"), F.round("sum", 4).alias("sum"))


@register("json_request", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       '{"event_type":"' || event_type || '","k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS request_json
FROM events""")
def q_json_request(spark: SparkSession, sf: str) -> DataFrame:
    """Request JSON parsed to a struct and written back to JSON text."""
    ev = table(spark, sf, "events").withColumn("p", M.parse_json(F.col("props")))
    ev = ev.withColumn("k", F.col("p.k"))
    return ev.select("event_id", "k", M.to_json("event_type", "k").alias("request_json"))

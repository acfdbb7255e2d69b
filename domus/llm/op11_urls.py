"""URL filters by a sort-merge range join, in DataFrame expressions only.

A rule names a host and a path; it fits the host and all its subdomains, where the url's path starts with the rule's.
The canonical key of a host is its labels in reverse order (``net.example``), then ``/`` and the path. A url has one key
for each domain above it (``net``, ``net.example``, ``net.example.www``, each with the url's path), so that every rule is
one interval of keys: its own key and all that begin with it. Such intervals are nested or apart. Urls and the
two ends of each interval are sorted together; a running sum of +1 and -1 is the height of the stack of open rules, and
the last rule that opened at a height is what lies on the stack there. The top of the stack at a url's key is the
rule with the longest path for that domain; over a url's keys the longest rule wins.

The sweep runs in buckets of keys. Their boundaries are quantiles of a sample of about ``SAMPLE`` urls (it decides how
even the buckets are, and no result). A rule goes to each bucket that its interval touches: no more rules are open at a
boundary than are nested there. Equal keys are spread over buckets by a hash of the row, so a url that a third of
the rows hold fills several. Only domains with as many labels as some rule has, and as much of a path as the
longest rule has, can meet a rule; no more is put into the keys, however long a url is.

Host: from behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
``?``, ``#`` or the end.

Cases: a null url, or one without ``://``, has an empty host and path. A rule with an empty host fits no url but those
whose host is empty or ends with a full stop. Repeated rows and null ids are judged like any others. Of rules with the
same host and path, block goes before allow; of equally long rules that fit, the one with the longer host wins. Without
rules every url gets the default; without urls there are no rows. Further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from domus.llm.common import table
from domus.operators.rank import with_bucket

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Urls sampled for the bucket boundaries (about), rows a bucket, and buckets at most.
SAMPLE = 16_384
ROWS_PER_BUCKET = 1_000_000
BUCKETS = 2_048

#: A row that occurs many times is written out in pieces of at most this many rows.
REPEAT = 100_000

#: Rules of the query (fixed values): verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))

#: Order of events with one key: rules open, urls are looked at, rules close.
OPENS, URL, CLOSES = 0, 1, 2


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def url_parts(url: str) -> tuple[Column, Column]:
    """(host, path) of a url column."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END")
    return lowered(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column, longest_host: int | None = None) -> Column:
    """Reversed labels of the host, a slash and the path, as UTF-8 bytes. A host beyond the longest one of a rule
    is cut one character behind it, where it equals none."""
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ".")
    if longest_host is not None:
        labels = F.substring(labels, 1, longest_host + 1)
    return F.encode(F.concat(labels, F.lit("/"), path), "UTF-8")


def judged(urls: DataFrame, rules: DataFrame, default: str = "allow", sample: int = SAMPLE,
           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``urls`` (page_id, url); ``rules`` has verdict, host, path."""
    spark = urls.sparkSession
    rules = rules.select(lowered("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").dropna()
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    bound = rules.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
                      F.max(F.length("rule_host")).alias("host"), F.max(F.length("rule_path")).alias("path")).first()
    urls = urls.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = url_parts("url")
    if bound["labels"] is None:
        return urls.select("page_id", host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))

    def keys(rows: DataFrame) -> DataFrame:
        labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
        depth = F.explode(F.sequence(F.lit(1), F.least(labels, F.lit(bound["labels"])))).alias("k")
        found = rows.select("*", host.alias("host"), F.substring(path, 1, bound["path"]).alias("path"))
        found = found.select(*rows.columns, "host", "path", depth)
        found = found.withColumn("key", canonical(F.expr("substring_index(host, '.', -k)"), F.col("path"), bound["host"]))
        spread = F.encode(F.hex(F.xxhash64("page_id", "url")), "UTF-8")
        return found.withColumn("position", F.concat("key", F.lit(b"\0"), spread)).drop("host", "path", "k")

    n_urls = urls.count()
    share = min(1.0, sample / max(n_urls, 1))
    few = urls if share == 1.0 else urls.sample(share, seed=11)
    seen = sorted(bytes(r["position"]) for r in keys(few).select("position").collect())
    wanted = min(BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              math.ceil(len(seen) / share / rows_per_bucket)))
    bounds = [F.lit(b) for b in sorted({seen[len(seen) * k // wanted] for k in range(1, wanted)})] if seen else []

    rows = with_bucket(keys(urls.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("times"))), F.col("position"), bounds,
                       "bucket")
    nothing = "CAST(NULL AS {})"
    swept = rows.select("bucket", "key", F.lit(URL).alias("event"),
                        F.lit(0).alias("step"), "page_id", "url", "times",
                        F.expr(nothing.format("STRUCT<size: INT, host_size: INT, rule: STRING, verdict: STRING>")
                               ).alias("top"))
    whole = F.concat("rule_host", "rule_path")
    opened = rules.select(canonical(F.col("rule_host"), F.col("rule_path")).alias("key"), F.struct(
        F.length(whole).alias("size"), F.length("rule_host").alias("host_size"), whole.alias("rule"), "verdict").alias("top"))
    opened = opened.withColumn("end", F.concat("key", F.lit(b"\xff")))  # above all that begins with the key
    opened = with_bucket(with_bucket(opened, F.col("key"), bounds, "first"), F.col("end"), bounds, "last")
    opened = opened.withColumn("bucket", F.explode(F.sequence("first", "last")))
    ends = opened.select("bucket", F.explode(F.array(
        F.struct("key", F.lit(OPENS).alias("event"), F.lit(1).alias("step"), "top"),
        F.struct(F.col("end").alias("key"), F.lit(CLOSES).alias("event"), F.lit(-1).alias("step"),
                 F.when(F.lit(False), F.col("top")).alias("top")))).alias("e"))
    ends = ends.select("bucket", "e.key", "e.event", "e.step", F.expr(nothing.format("LONG")).alias("page_id"),
                       F.expr(nothing.format("STRING")).alias("url"), F.expr(nothing.format("LONG")).alias("times"), "e.top")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    height = F.sum("step").over(Window.partitionBy("bucket").orderBy("key", "event").rowsBetween(*so_far))
    slot = Window.partitionBy("bucket", "height").orderBy("key", "event").rowsBetween(*so_far)
    met = (swept.union(ends).withColumn("height", height).withColumn("top", F.last("top", ignorenulls=True).over(slot))
           .filter(F.col("event") == URL).groupBy("page_id", "url").agg(F.max("top").alias("top"), F.max("times").alias("times")))
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / REPEAT))).alias("piece")
    met = met.select("page_id", "url", "top", "times", pieces)
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.lit(REPEAT), F.col("times") - F.col("piece") * REPEAT))
    return met.select("page_id", "url", "top", F.explode(copies)).select(
        "page_id", host.alias("host"), path.alias("path"), F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    """Rules (verdict, host, path) as a table."""
    empty = spark.range(0).select(*[F.lit("").alias(c) for c in ("verdict", "host", "path")])
    if not rules:
        return empty
    listed = F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(r, empty.columns, strict=True)]) for r in rules])
    return spark.range(1).select(F.inline(listed))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judged(table(spark, sf_dir, "pages"), rule_table(spark))


OP11_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
                                  ('allow', 'org', '/fr/')),
hp AS (SELECT DISTINCT host, path FROM p),
m AS (SELECT hp.host, hp.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
             arg_max(r.verdict, length(r.host || r.path)) AS verdict
      FROM hp JOIN r ON (hp.host = r.host OR ends_with(hp.host, '.' || r.host)) AND starts_with(hp.path, r.path)
      GROUP BY hp.host, hp.path)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.host = m.host AND p.path = m.path
"""

"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame expressions only.

A test item is a set of five-word shingles (its whole sequence where it is shorter). A document leaks it if it holds at
least ``CONTAINMENT`` of them. Items are partitioned by size: an item of q shingles may miss q - ceil(0.8 q) of them,
so its sketch is one more than that, the shingles with the smallest hashes (a bottom-k MinHash). A document that
leaks the item must hold one of the sketch, however long the document is: the search misses nothing. Each
partition also has a largest sketch hash, above which no shingle of a document needs to be looked up. Documents
that hold a sketch hash are candidates, and are verified on the exact shingle strings.

Words are runs of anything but ASCII blanks, lower-cased. Cases: null and empty texts have no shingles, and items
without any are left out; an item_id with several texts is leaked if one of them is, the largest share counts;
likewise for a repeated doc_id; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import sized, table, words, written

WIDTH = 5
CONTAINMENT = 0.8


def _windows(found: Column, width: Column | int) -> Column:
    """Positions (from 1) at which a window of ``width`` words begins."""
    count = F.size(found) - width + 1
    return F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(found: Column, width: Column | int) -> Column:
    return F.transform(_windows(found, width), lambda i: F.xxhash64(F.slice(found, i, width)))


def shingle_texts(found: Column, width: Column | int) -> Column:
    return F.array_distinct(F.transform(_windows(found, width), lambda i: F.array_join(F.slice(found, i, width), " ")))


def item_sets(benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """item_id, width, shingles, q, part (size partition), sketch (bottom-k hashes) of the test items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.lower("text")).alias("w"))
    items = items.filter(F.size("w") > 0).distinct().withColumn("width", F.least(F.lit(WIDTH), F.size("w")))
    items = items.withColumn("shingles", shingle_texts(F.col("w"), F.col("width")))
    items = items.withColumn("q", F.size("shingles"))
    miss = F.col("q") - F.ceil(F.col("q") * F.lit(containment)).cast("int")
    hashes = F.array_sort(F.array_distinct(shingle_hashes(F.col("w"), F.col("width"))))
    return items.select("item_id", "width", "shingles", "q", F.floor(F.log2("q")).cast("int").alias("part"),
                        F.slice(hashes, F.lit(1), miss + 1).alias("sketch"))


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_shared, containment, for each leaked item of a document."""
    items = written(item_sets(benchmark, containment), "decontam-items")
    sketch = written(items.select("item_id", "width", "part", F.explode("sketch").alias("h")), "decontam-sketch")
    # the largest sketch hash of each size partition; a row for each width and power of two
    tops = sketch.groupBy("width", "part").agg(F.max("h").alias("top"), F.min("h").alias("low")).collect()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for width in sorted({r["width"] for r in tops}):
        top = max(r["top"] for r in tops if r["width"] == width)
        seen = d.select("doc_id", words(F.lower("text")).alias("w"))
        seen = seen.select("doc_id", F.explode(F.filter(shingle_hashes(F.col("w"), width), lambda h: h <= top)
                                               ).alias("h"))
        hits = seen.join(sketch.filter(F.col("width") == width).select("item_id", "h"), "h").select("doc_id", "item_id")
        found = hits if found is None else found.union(hits)
    if found is None:
        found = docs.sparkSession.range(0).select(F.col("id").alias("doc_id"), F.col("id").alias("item_id"))
    pairs = written(found.distinct(), "decontam-pairs")
    held = d.join(pairs, "doc_id").select("doc_id", "item_id", words(F.lower("text")).alias("w"))
    held = held.join(items.select("item_id", "width", "shingles", "q"), "item_id")
    shared = F.size(F.array_intersect("shingles", shingle_texts(F.col("w"), F.col("width"))))
    held = held.select("doc_id", "item_id", F.col("q").cast("long").alias("n_shingles"),
                       shared.cast("long").alias("n_shared"))
    held = held.filter(F.col("n_shared") >= F.ceil(F.col("n_shingles") * F.lit(containment)))
    best = F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shingles", "n_shared"))
    return held.groupBy("doc_id", "item_id").agg(best.alias("m")).select(
        "doc_id", "item_id", "m.n_shingles", "m.n_shared", "m.containment")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns."""
    leaking = written(contaminated(docs, benchmark).select(F.col("doc_id").alias("_id")).distinct(), "decontam-leaking")
    return docs.join(sized(leaking), F.col("doc_id") == F.col("_id"), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaks of benchmark items into documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH i AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
           FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT item_id, w, least(5, len(w)) AS width FROM i WHERE len(w) > 0),
s AS (SELECT DISTINCT item_id, width, w,
             unnest(list_transform(range(1, len(w) - width + 2), lambda k: array_to_string(w[k:k + width - 1], ' '))) AS sh
      FROM iw),
q AS (SELECT item_id, w, count(*) AS n_shingles FROM s GROUP BY item_id, w),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
      FROM documents WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, width,
              unnest(list_transform(range(1, len(w) - width + 2), lambda k: array_to_string(w[k:k + width - 1], ' '))) AS sh
       FROM d, (SELECT DISTINCT width FROM iw)),
m AS (SELECT ds.doc_id, s.item_id, s.w, count(*) AS n_shared
      FROM ds JOIN s ON ds.sh = s.sh AND ds.width = s.width GROUP BY ds.doc_id, s.item_id, s.w)
SELECT doc_id, item_id, n_shingles, n_shared, CAST(n_shared AS DOUBLE) / n_shingles AS containment
FROM m JOIN q USING (item_id, w) WHERE n_shared >= ceil(n_shingles * 0.8)
"""

"""Mixing sources to target weights by pivotal dependent rounding.

``source_targets`` shares the total size out by weight, no source above a multiple of its own size. A
document of a source with target t and size s should appear t/s times on average: the whole part is taken
as it is, the fraction is rounded by pivotal duels. Two documents with fractions duel: mass counted in words
moves from one to the other, in a random direction whose odds keep each one's expected copies, until one of
them has a whole number of copies. The words of the pair stay the same, so a block of duels ends with at most
one open document and exactly the words it should have. Open documents of many blocks duel again one level up
(a reduction tree with a fixed fan-in), until one per source is left, which is rounded to the nearer side. So a
source's words miss its target by at most half a document; large documents duel first, so that it is seldom a
large one.

Blocks are (source, hash of the document), so a source with a third of all rows fills as many blocks as it
needs, and no block holds more than about ``BLOCK`` rows. All randomness is hashed from the seed and the
document id: reruns agree.

Cases: null text has size 0 and is taken 0 times; a null source is a source of its own, last in order; rows
repeated with one doc_id are separate rows; an empty table gives no rows; further columns are ignored by
``mix`` and kept by the pipeline.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import WORD, table, written

#: Rows of a leaf block, and open documents that meet at an inner node of the tree.
BLOCK = 4096
FAN_IN = 1024
MAX_REPEAT = 3.0


def size_in_words(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text; null: 0)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """source, n_docs, source_size, weight, target.

    Weights are 1, 2, 3, repeating over the sources by code point, null last. The size of all sources is
    shared out by weight; what exceeds ``max_repeat`` times a source's size is shared again among the others
    by weight, until nothing does. Each round is one aggregate over a row per source.
    """
    spark = sized.sparkSession
    per = written(sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
                  .orderBy(F.asc_nulls_last("source")), "mix-sources")
    ranked = per.orderBy(F.asc_nulls_last("source")).rdd.zipWithIndex().map(lambda x: (*x[0], x[1] % 3 + 1.0))
    per = written(spark.createDataFrame(ranked, "source string, n_docs long, source_size long, weight double"),
                  "mix-weights")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    ceiling = F.col("source_size") * F.lit(max_repeat)
    level, full = 0.0, None
    while True:
        # level: words per unit of weight; sources whose ceiling lies below it are full
        over = ceiling < F.col("weight") * F.lit(level)
        row = per.agg(F.sum(F.when(over, ceiling).otherwise(0.0)), F.sum(F.when(~over, F.col("weight")).otherwise(0.0)),
                      F.sum(over.cast("int"))).first()
        if row[2] == full or not row[1]:
            break
        full, level = row[2], (total - row[0]) / row[1]
    return per.withColumn("target", F.least(ceiling, F.col("weight") * F.lit(level)))


def _odds(seed: int, ids: np.ndarray, level: int) -> np.ndarray:
    """Numbers in [0, 1) from the seed, the level and the ids."""
    mask = (1 << 64) - 1
    h = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + level * 0xD1B54A32D192ED03) & mask)
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def _rounding(seed: int, level: int, last: bool):
    return lambda part: _duels(part, seed, level, last)


def _duels(part: pd.DataFrame, seed: int, level: int, last: bool) -> pd.DataFrame:
    """Round one block: at most one row keeps a fraction (none if ``last``)."""
    part = part.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable")
    size, frac = part["size"].to_numpy(float), part["frac"].to_numpy(float).copy()
    odds = _odds(seed, part["doc_id"].fillna(-1).to_numpy(np.int64), level)
    tiny = 1e-9
    held = -1
    for j in np.flatnonzero((frac > tiny) & (frac < 1 - tiny)):
        if held < 0:
            held = j
            continue
        i = held
        # words that can move from j to i, and from i to j, before one copy count is whole
        to_i = min((1 - frac[i]) * size[i], frac[j] * size[j])
        to_j = min(frac[i] * size[i], (1 - frac[j]) * size[j])
        move = to_i if odds[j] * (to_i + to_j) < to_j else -to_j
        frac[i] += move / size[i]
        frac[j] -= move / size[j]
        open_i, open_j = tiny < frac[i] < 1 - tiny, tiny < frac[j] < 1 - tiny
        held = i if open_i else j if open_j else -1
    if last and held >= 0:
        frac[held] = np.round(frac[held])
    whole = (frac <= tiny) | (frac >= 1 - tiny)
    frac[whole] = np.round(frac[whole])
    return part.assign(frac=frac, open=~whole)


def mix(docs: DataFrame, max_repeat: float = MAX_REPEAT, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (long): how often the mix takes each document."""
    sized = written(size_in_words(docs), "mix-sizes")
    targets = source_targets(sized, max_repeat)
    rows = sized.join(targets, sized.source.eqNullSafe(targets.source)).drop(targets.source)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.select("doc_id", "source", "size", "source_size", "target",
                       F.when(F.col("size") > 0, F.floor(rate)).otherwise(0).cast("long").alias("base"),
                       F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0).alias("frac"),
                       F.ceil(F.col("n_docs") / F.lit(BLOCK)).cast("long").alias("blocks"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("blocks")))
    schema = ("doc_id long, source string, size long, source_size long, target double, base long, frac double, "
              "blocks long, block long, open boolean")
    settled, level = None, 0
    while True:
        last = level > 0 and rows.filter("blocks > 1").isEmpty()
        rows = written(rows.groupBy("source", "block").applyInPandas(_rounding(seed, level, last), schema), f"mix-level{level}")
        done = rows if last else rows.filter("not open")
        settled = done if settled is None else settled.union(done)
        if last:
            break
        # the open documents, at most one of each block, meet in a FAN_IN-th as many blocks
        rows = (rows.filter("open").withColumn("block", F.floor(F.col("block") / FAN_IN))
                .withColumn("blocks", F.ceil(F.col("blocks") / FAN_IN)).drop("open"))
        level += 1
    return settled.select("doc_id", "source", "size", "source_size", "target",
                          (F.col("base") + F.col("frac").cast("long")).alias("copies"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: words of each that the mix takes."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")

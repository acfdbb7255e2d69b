"""Substring dedup by seed and extend: passages of 13 words or more that a smaller document holds too are removed.

1. Seeds: every run of 13 words holds eight 6-word shingles; the smallest hash of the eight is an anchor (winnowing), so two
   documents that share a run share an anchor. Documents with the same words are merged first. Anchors are joined
   across documents, and those in two different texts or more are seeds.
2. Extend: a document grows each of its seeds to the left and right into all runs of 13 words around it. Runs are
   matched across documents by a 128-bit hash, and each run belongs to the smallest document that holds it.
3. Runs of a document that belong to a smaller one are removed; neighbouring and overlapping runs join into maximal
   repeats. Whatever the number of documents that share a passage, each sends its runs once, partial
   aggregation merges them in every task, and no pairs of documents are made.

Words are runs of anything but ASCII blanks, unchanged. Cases: null and empty texts have no words; texts under 13 words
lose nothing; a null doc_id is neither smaller nor larger than another, so its row loses nothing; rows with one doc_id
don't take from each other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import binary_column, mixed, runs_of, sized, table, word_hashes, written

LENGTH = 13
SEED = 6


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    out, span = x, 1
    while 2 * span <= width:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    if span < width:
        out = np.minimum(out[:len(out) - (width - span)], out[width - span:])
    return out


def anchors(hashes: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Distinct winnowed shingle hashes of a document: one at least in every run of ``length`` words."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    return np.unique(_sliding_min(runs_of(hashes, SEED), length - SEED + 1))


def seeded_runs(hashes: np.ndarray, seeds: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """First words of the runs of ``length`` words that hold a seed."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(np.isin(runs_of(hashes, SEED), seeds))
    mark = np.zeros(len(hashes) + 2, np.int64)
    np.add.at(mark, np.maximum(at - (length - SEED), 0), 1)
    np.add.at(mark, at + 1, -1)
    return np.flatnonzero(np.cumsum(mark)[:n] > 0)


def covered(n_words: int, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which words the runs that begin at ``starts`` cover."""
    mark = np.zeros(n_words + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + length, -1)
    return np.cumsum(mark)[:n_words] > 0


def _fingerprints(batches):
    for batch in batches:
        sizes, digests = [], []
        for data in binary_column(batch, "text"):
            found = (data or b"").split()
            sizes.append(len(found))
            digests.append(hashlib.sha256(b" ".join(found)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                         names=["doc_id", "n_words", "sha"])


def _anchors(length):
    def run(batches):
        for batch in batches:
            same, found = [], []
            for data in binary_column(batch, "text"):
                same.append(xxhash.xxh3_64_intdigest(b" ".join((data or b"").split())) - (1 << 63))
                found.append(anchors(word_hashes(data or b""), length).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(same, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "t", "anchors"])
    return run


def _runs(length):
    def run(batches):
        for batch in batches:
            ids, seeds = batch.column(0).to_pylist(), batch.column(2)
            for k, data in enumerate(binary_column(batch, "text")):
                h = word_hashes(data or b"")
                at = seeded_runs(h, np.array(seeds[k].values, np.int64).view(np.uint64), length)
                if not len(at):
                    continue
                one, two = runs_of(h, length)[at], runs_of(mixed(h ^ np.uint64(0x5851F42D4C957F2D)), length)[at]
                _, first = np.unique(one, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[first].view(np.int64)), pa.array(two[first].view(np.int64)),
                     pa.array(np.full(len(first), ids[k], np.int64))], names=["h1", "h2", "doc_id"])
    return run


def _removals(length):
    def run(batches):
        for batch in batches:
            seeds, owned = batch.column(2), batch.column(3)
            rows = ([], [], [])
            for k, data in enumerate(binary_column(batch, "text")):
                found, h = (data or b"").split(), word_hashes(data or b"")
                at = seeded_runs(h, np.array(seeds[k].values, np.int64).view(np.uint64), length)
                own = np.array(owned[k].values if owned[k].is_valid else [], np.int64).view(np.uint64)
                gone = covered(len(found), at[~np.isin(runs_of(h, length)[at], own)], length)
                rows[0].append(hashlib.sha256(b" ".join(found)).hexdigest())
                rows[1].append(int(gone.sum()))
                rows[2].append(hashlib.sha256(b" ".join([w for w, g in zip(found, gone.tolist(), strict=True) if not g]
                                                        )).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows)],
                                             schema=pa.schema([("doc_id", pa.int64()), ("sha", pa.string()),
                                                               ("n_removed", pa.int64()), ("kept", pa.string())]))
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    prints = written(d.mapInArrow(_fingerprints, "doc_id long, n_words long, sha string"), "sub-prints")
    # written, so that the join deals both sides anew and a very common text can be split over tasks
    first = written(prints.groupBy(F.col("sha").alias("same")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias(
        "times")).filter("times > 1").select("same", "first_id"), "sub-first")
    base = written(prints.select("doc_id", "n_words", "sha").join(first, F.col("sha") == F.col("same"), "left").select(
        "doc_id", "n_words", "sha", F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False)).alias("copy")),
        "sub-base")
    # computed twice rather than kept: the anchors of all documents are as large as a third of the texts
    each = d.filter("doc_id is not null").mapInArrow(_anchors(length), "doc_id long, t long, anchors array<long>").select(
        "doc_id", "t", F.explode("anchors").alias("anchor"))
    seeds = written(each.groupBy("anchor").agg(F.min("t").alias("low"), F.max("t").alias("high"))
                    .filter("low != high").select("anchor"), "sub-seeds")
    seeded = each.join(sized(seeds), "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("seeds"))
    originals = base.filter("not copy").select("doc_id").distinct()
    seeded = written(seeded.join(originals, "doc_id", "left_semi"), "sub-seeded")
    ids = seeded.select("doc_id")
    involved = d.join(sized(ids), "doc_id", "left_semi")
    runs = involved.join(seeded, "doc_id").select("doc_id", "text", "seeds").mapInArrow(
        _runs(length), "h1 long, h2 long, doc_id long")
    owned = runs.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"))
    owned = written(owned.groupBy("doc_id").agg(F.collect_list("h1").alias("owned")), "sub-owned")
    removed = involved.join(seeded, "doc_id").join(owned, "doc_id", "left").select("doc_id", "text", "seeds", "owned")
    removed = removed.mapInArrow(_removals(length), "doc_id long, sha string, n_removed long, kept string")
    removed = written(removed, "sub-removed").dropDuplicates(["doc_id", "sha"])
    out = base.join(removed, ["doc_id", "sha"], "left")
    whole = F.col("copy") & (F.col("n_words") >= length)
    return out.select("doc_id", "n_words",
                      F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                      F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove from all documents the passages that a smaller one holds."""
    return remove_repeats(table(spark, sf_dir, "documents"))

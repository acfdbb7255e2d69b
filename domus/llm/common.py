"""Helpers that the operators of this package share: words, written tables, linked components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.session import scratch_path

#: A word is a run of anything but the six ASCII blanks (space, tab, LF, VT, FF, CR).
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

_MUL = np.uint64(0x9E3779B97F4A7C15)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back: the lineage ends
    there, and a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Ids are broadcast up to this many (8 bytes each), and joined by shuffle beyond.
BROADCAST_ROWS = 2_000_000


def sized(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it is counted to be small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 bytes (``bytes.split`` cuts at the six ASCII blanks)."""
    found = data.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` consecutive word hashes (empty when there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _MUL + hashes[j:n + j]
    return mixed(out)


def binary_column(batch: pa.RecordBatch, name: str) -> list:
    """UTF-8 bytes (or None) of a text column of an Arrow batch."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def _local_stars(batches):
    """Union-find over one partition's links: at most one link per node leaves the task."""
    parent: dict = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:  # memory stays bounded: what is known so far leaves, and links again later
            yield _stars(parent, root)
            parent.clear()
    if parent:
        yield _stars(parent, root)


def _stars(parent, root):
    nodes = [x for x in parent if root(x) != x]
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())],
                                      names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable from each linked node: columns ``node``, ``component`` (nodes without a
    link to another node are absent).

    ``links`` has two long columns. Each round every node points at its smallest neighbour, pointers
    are followed to their roots by doubling, and links are redrawn between roots; rounds at least
    halve the nodes that still have links. Links inside one task are merged there first, so a
    node with very many links leaves each task as few rows. All state is in written tables.
    """
    a, b = links.columns
    schema = "a long, b long"
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a != b")
    edges = written(edges.mapInArrow(_local_stars, schema), "links")
    label = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = written(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "up")
        while True:
            step = up.select(F.col("node").alias("n2"), F.col("up").alias("up2"))
            nxt = up.join(step, up.up == step.n2).select("node", F.col("up2").alias("to"), "up")
            nxt = written(nxt, "up")
            moved = nxt.filter("to != up").isEmpty()
            up = nxt.select("node", F.col("to").alias("up"))
            if moved:
                break
        if label is None:
            label = up.select("node", F.col("up").alias("component"))
        else:
            new = up.select(F.col("node").alias("component"), F.col("up").alias("top"))
            label = (label.join(new, "component", "left")
                     .select("node", F.coalesce("top", "component").alias("component")))
        label = written(label, "label")
        x = up.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        y = up.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        edges = (edges.join(x, "a").join(y, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                 .filter("a != b").distinct())
        edges = written(edges.mapInArrow(_local_stars, schema), "links")
    if label is None:
        label = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label

"""Near-duplicate vectors by PCA-ordered tiled comparison.

Equal vectors are merged first and counted. The others are rotated onto principal axes (fitted on a bounded sample;
any rotation gives the same products, the axes only decide how early a comparison can stop), cut into tiles of
nearby vectors by the leading axes, and compared tile by tile:

* Two tiles are compared only if their boxes on the leading axes come close enough: unit vectors with cosine c lie
  sqrt(2 - 2c) apart, on every set of axes at most that. Tiles are never shuffled to meet: each task reads two files' worth
  of the written tiles (a Cartesian product of its partitions) and looks at the pairs of tiles between them, so the disk holds
  the vectors a fixed number of times, however many pairs there are.
* Inside a pair of tiles, products of the leading axes are summed first. What is left is at most the product of the
  two suffix norms (Cauchy-Schwarz); once sum and bound together stay below the threshold the pair of vectors
  is dropped. Sum and bound are one matrix product; where many pairs stay, it is made again on more axes. The
  survivors are confirmed in double precision on the vectors as given.

A tile holds at most about ``tile_rows`` vectors: crowded regions are cut further by hash, and all their tiles meet.
A task returns one count for each vector and the links of a spanning forest, never all links of a crowd. Afterwards vectors
are told apart by 128-bit hashes, and travel no more.

Cases: vectors that are null, zero or hold null or non-finite components link with nothing; vectors of different
length never link; rows with one vec_id are one node of the components, their links are added up; equal vectors link;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import components, table, written

THRESHOLD = 0.95
#: Vectors a tile: this many, or more of short vectors, up to so many values, as each tile travels to all that are near.
TILE = 2048
TILE_VALUES = 1 << 19
#: Bytes (about) of vectors in a file of tiles; links that a task gathers before it returns them.
FILE_BYTES = 16 << 20
GATHERED = 1 << 20
#: Vectors that the axes and the cuts between tiles are fitted on.
SAMPLE = 16384
CUT_AXES = 6
STEPS = (8, 16, 32)
SLACK = 1e-9
#: Pairs are confirmed one by one where a step leaves less than one in so many.
FEW = 200


class Tiling:
    """Principal axes and a tree of cuts along the leading ones, from a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, depth: int):
        _, axes = np.linalg.eigh(sample.T @ sample)
        self.axes = np.ascontiguousarray(axes[:, ::-1])
        self.depth = depth
        self.cuts = np.zeros(1 << depth)
        lead = sample @ self.axes[:, :CUT_AXES]
        self._fit(lead, 1, 0)

    def _fit(self, lead: np.ndarray, node: int, level: int) -> None:
        if level == self.depth:
            return
        along = lead[:, level % lead.shape[1]]
        cut = np.median(along) if len(along) else 0.0
        self.cuts[node] = cut
        self._fit(lead[along < cut], 2 * node, level + 1)
        self._fit(lead[along >= cut], 2 * node + 1, level + 1)

    def leaf(self, unit: np.ndarray) -> np.ndarray:
        lead = unit @ self.axes[:, :CUT_AXES]
        node = np.ones(len(unit), np.int64)
        for level in range(self.depth):
            node = 2 * node + (lead[:, level % lead.shape[1]] >= self.cuts[node])
        return node - (1 << self.depth)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(column, dim: int) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in column]) if len(column) else np.zeros((0, dim))


def _suffix_norms(x: np.ndarray, k: int) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x[:, k:], x[:, k:]))


def _bounded(u: np.ndarray, k: int) -> np.ndarray:
    """The leading ``k`` axes and, as one more, the norm of the others: products of such rows are the sums on the leading
    axes plus the most that the others can add (Cauchy-Schwarz)."""
    if k >= u.shape[1]:
        return u.astype(np.float32)
    return np.concatenate([u[:, :k], _suffix_norms(u, k)[:, None]], 1).astype(np.float32)


def similar_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, upper: bool):
    """Rows (i, j) of two blocks of vectors with cosine at or above the threshold; ``upper``: only i < j.

    Bounds are products in single precision, with more slack than their rounding; while many pairs are left, all are
    bounded again on more axes, and what is left then is confirmed in double precision."""
    dim = a.shape[1]
    ua, ub = _unit(a) @ axes, _unit(b) @ axes
    steps = [*(k for k in STEPS if k < dim), dim]
    sides = {}  # step: both blocks on its axes
    floor = np.float32(threshold - SLACK - 4e-7 * (dim + 16))  # rows are at most units: rounding adds less than this
    na, nb = np.sqrt(np.einsum("ij,ij->i", a, a)), np.sqrt(np.einsum("ij,ij->i", b, b))
    out_i, out_j = [], []
    first = 0
    for at in range(0, len(a), 256):
        last = at + 1 if upper else 0
        for step in range(first, len(steps)):
            if step not in sides:
                sides[step] = _bounded(ua, steps[step]), _bounded(ub, steps[step]).T
            xa, xb = sides[step]
            hit = np.flatnonzero(xa[at:at + 256] @ xb[:, last:] >= floor)
            if len(hit) * FEW <= xa[at:at + 256].shape[0] * (len(b) - last):
                break
            first = min(step + 1, len(steps) - 1)  # the next rows of the block begin where these ended
        i, j = np.divmod(hit, max(1, len(b) - last))
        j = j + last
        if upper:
            keep = at + i < j
            i, j = i[keep], j[keep]
        for lo in range(0, len(i), 1 << 16):  # survivors in blocks: memory stays bounded in a crowd
            bi, bj = at + i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
            cosine = np.einsum("ij,ij->i", a[bi], b[bj]) / (na[bi] * nb[bj])
            live = cosine >= threshold
            out_i.append(bi[live])
            out_j.append(bj[live])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j])


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links (i, j) lead it to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            return label
        label = new


def _gathered(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, top) rows of several pairs of tiles as one row a node, with the smallest node that it is led to."""
    node, links, top = (np.concatenate(x) for x in zip(*found, strict=True))
    ids, at = np.unique(np.concatenate([node, top]), return_inverse=True)
    i, j = at[:len(node)], at[len(node):]
    total = np.bincount(i, links, len(ids)).astype(np.int64)
    return ids, total, ids[forest(len(ids), i, j)]


def _compare(axes: np.ndarray, threshold: float):
    dim = len(axes)

    def links_of(r) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        same = r.tile_a == r.tile_b
        a = np.frombuffer(r.rows_a, np.float32).reshape(-1, dim).astype(float)
        b = a if same else np.frombuffer(r.rows_b, np.float32).reshape(-1, dim).astype(float)
        ids_a, w_a = np.frombuffer(r.ids_a, np.int64), np.frombuffer(r.copies_a, np.int64)
        ids_b, w_b = np.frombuffer(r.ids_b, np.int64), np.frombuffer(r.copies_b, np.int64)
        i, j = similar_pairs(a, b, axes, threshold, same)
        if not len(i):
            return None
        ids = ids_a if same else np.concatenate([ids_a, ids_b])
        w = w_a if same else np.concatenate([w_a, w_b])
        j = j if same else j + len(ids_a)
        links = np.bincount(i, w[j], len(ids)) + np.bincount(j, w[i], len(ids))
        top = forest(len(ids), i, j)
        touched = np.flatnonzero(links)
        return ids[touched], links[touched].astype(np.int64), ids[top[touched]]

    def run(batches):
        held = []  # of the tiles of a task, each met by many others: a row a node leaves, not one a pair of tiles
        for part in batches:
            for r in part.itertuples(index=False):
                got = links_of(r)
                if got is None:
                    continue
                held.append(got)
                if sum(len(x[0]) for x in held) > GATHERED:
                    held = [_gathered(held)]
                    if len(held[0][0]) > GATHERED // 2:
                        yield pd.DataFrame(dict(zip(("node", "links", "top"), held.pop(), strict=True)))
        if held:
            yield pd.DataFrame(dict(zip(("node", "links", "top"), _gathered(held), strict=True)))
    return run


def _tiles(tiling: Tiling):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(part["embedding"], len(tiling.axes))
        lead = _unit(x) @ tiling.axes[:, :CUT_AXES]
        return pd.DataFrame({"tile": [int(part["tile"].iloc[0])], "ids": [part["rep"].to_numpy(np.int64).tobytes()],
                             "copies": [part["copies"].to_numpy(np.int64).tobytes()],
                             "rows": [x.astype(np.float32).tobytes()],
                             "low": [lead.min(0).tolist()], "high": [lead.max(0).tolist()]})
    return run


def tile_rows(dim: int) -> int:
    return max(TILE, min(4 * TILE, TILE_VALUES // max(1, dim)))


def _linked(reps: DataFrame, dim: int, threshold: float) -> DataFrame:
    """node, links, top rows of the distinct vectors of one length."""
    count = reps.count()
    rows = reps.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("embedding").collect()
    sample = _unit(_matrix([r[0] for r in rows], dim))
    depth = max(0, min(int(np.ceil(np.log2(max(1, count) / tile_rows(dim)))) + 1, 11))
    tiling = Tiling(sample, depth)

    def leaves(batches):
        for batch in batches:
            x = batch.column(batch.schema.get_field_index("embedding")).flatten().to_numpy().reshape(-1, dim).astype(float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tiling.leaf(_unit(x)), pa.int64())],
                                             names=[*batch.schema.names, "leaf"])

    # leaves are found twice, to be counted and to deal the vectors: that is cheaper than another table of vectors
    with_leaf = reps.select("rep", "copies", "embedding").mapInArrow(
        leaves, "rep long, copies long, embedding array<float>, leaf long")
    crowd = written(with_leaf.groupBy("leaf").agg(F.ceil(F.count("*") / tile_rows(dim)).cast("long").alias("cuts")),
                    "vec-crowds")
    cuts = F.coalesce("cuts", F.lit(1))  # a vector on a cut may fall to the other side, where none was counted
    with_tile = with_leaf.join(F.broadcast(crowd), "leaf", "left").withColumn(
        "tile", F.xxhash64("leaf", F.pmod(F.xxhash64("rep"), cuts)))  # at most 2,048 leaves
    n = crowd.agg(F.coalesce(F.sum("cuts"), F.lit(1))).first()[0]
    files = max(1, min(n, 64), -(-count * dim * 4 // FILE_BYTES))
    axes_schema = ("tile long, ids binary, copies binary, rows binary, low array<double>, high array<double>")
    tiles = written(with_tile.drop("leaf", "cuts").repartition(files, "tile").groupBy("tile").applyInPandas(
        _tiles(tiling), axes_schema), "vec-tiles")
    # each task reads two partitions of the tiles, and nothing is shuffled
    reach = float(np.sqrt(2 - 2 * threshold)) + SLACK
    side = lambda s: tiles.select(*(F.col(c).alias(f"{c}_{s}") for c in tiles.columns))
    gap = sum((F.pow(F.greatest(F.col("low_a")[k] - F.col("high_b")[k], F.col("low_b")[k] - F.col("high_a")[k],
                                F.lit(0.0)), 2) for k in range(min(CUT_AXES, dim))), F.lit(0.0))
    both = side("a").join(side("b").hint("shuffle_replicate_nl"),
                          (F.col("tile_a") <= F.col("tile_b")) & (gap <= reach * reach))
    both = both.drop("low_a", "high_a", "low_b", "high_b")
    return both.mapInPandas(_compare(tiling.axes, threshold), "node long, links long, top long")


def _hashes(vector: Column) -> list[Column]:
    """Two 64-bit hashes of a vector with different seeds (-0.0 has the hash of 0.0)."""
    return [F.xxhash64(vector).alias("one"), F.xxhash64(F.lit(8), vector).alias("two")]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<float>").alias("embedding"))
    good = F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(
        "embedding", lambda x: x != 0)
    v = v.withColumn("good", F.coalesce(good, F.lit(False)))
    reps = written(v.filter("good").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
                   .select("rep", "copies", "embedding", *_hashes(F.col("embedding"))), "vec-reps")
    found = None
    for (dim,) in reps.select(F.size("embedding")).distinct().collect():  # vectors of one length, usually all
        part = _linked(reps.filter(F.size("embedding") == dim), dim, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.lit(True).alias("kept"))
    found = written(found, "vec-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    tops = components(found.select("node", "top"))
    per = reps.drop("embedding").join(links, reps.rep == links.node, "left").drop("node")
    per = per.join(tops, per.rep == tops.node, "left").select(
        "one", "two", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    per = written(per, "vec-per")
    # rows without a good vector have no hashes, and find nothing
    out = v.select("vec_id", *(F.when(v.good, h).alias(k) for h, k in zip(_hashes(v.embedding), ("one", "two"), strict=True)))
    out = out.join(per, ["one", "two"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return near_vectors(table(spark, sf_dir, "embeddings"))

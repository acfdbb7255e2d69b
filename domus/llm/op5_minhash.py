"""MinHash near-dedup with an LSH forest.

1. Every document becomes the set of its distinct five-word shingles. Documents with one set are merged first, under their
   smallest id.
2. A coarse pass keeps the sets that share three MinHashes in a row with another one in some tree; the others have no
   partner (a pair at the threshold is missed by all ``GATE_TREES`` trees with odds of about 1 in 90,000).
3. The forest: each tree sorts the signatures in an order of its own. A region is a run of signatures with a common prefix:
   three hashes at first, more where a region is crowded (adaptive depth), so no region holds more than about
   ``CROWD`` rows. Inside a region the neighbours in sorted order, which have the longest common prefixes, are
   candidates if their sketches can still reach the threshold. Sets that have met all that share three hashes with them
   in every tree, and found no candidate, are done then.
4. Candidates are confirmed on the full sets. Links become components, and the forest grows: further rounds take
   new trees and look only at neighbours of different components, so a crowd that is already one component costs
   nothing and what stands aside in it meets new neighbours. The rounds go on with the
   other sets, and end when one brings no new link.
5. An exact pass over the sets that weren't done after the first round, as neighbours and chunks leave some pairs of a
   crowd unmet: a join on the first shingles of each set, rarest first, as many as any partner has to share one of.
   Only pairs of different components are joined, and confirmed on the full sets.

The first round confirms the ``BEST`` most similar neighbours of each signature, which joins most groups with few
comparisons; later rounds confirm all that are left. Links inside a component need not all be listed.

Words are runs of anything but ASCII blanks, A-Z lower-cased. Cases: texts of one to four words are one shingle; null, empty and
blank texts have no shingles and link with nothing; repeated rows share their component; a null doc_id never is the
smallest of a component and stays on its own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import binary_column, components, runs_of, sized, table, word_hashes, written

WIDTH = 5
PERCENT = 85
GATE_TREES = 12
PREFIX = 3
HASHES = 192
SIGNATURE = 96
DEPTH = 12
ROUND_TREES = (12, 24)
NEIGHBOURS = (8, 24)
BEST = 2
CROWD = 2048
#: Share of equal sketch bytes that a pair at the threshold reaches but for odds of about 1 in 10 million.
SKETCH_SLACK = 0.15
#: In later rounds, whose sets all go through the exact pass.
LATE_SLACK = 0.08
#: Shingles (about) that are counted to tell rare from common ones; their order decides the work of the exact pass, not
#: what it finds.
COUNTED = 1 << 22

_MULTIPLIERS = (np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 62, HASHES, dtype=np.uint64)
                * np.uint64(2) + np.uint64(1))


def shingle_set(data: bytes | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text given in UTF-8."""
    h = word_hashes((data or b"").lower())
    if not len(h):
        return np.zeros(0, np.uint64)
    k = min(WIDTH, len(h))
    return np.unique(runs_of(h, k) + np.uint64(WIDTH - k))


def minhashes(shingles: np.ndarray, count: int) -> np.ndarray:
    """The smallest of ``count`` permutations of the set, in blocks of bounded size."""
    out = np.full(count, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 1 << 14):
        np.minimum(out, (shingles[None, at:at + (1 << 14)] * _MULTIPLIERS[:count, None]).min(1), out=out)
    return out


def _key(rows: np.ndarray, tree: int) -> np.ndarray:
    """One 64-bit key of each row of hashes, different in each tree."""
    out = np.full(len(rows), (tree * 2 + 1) * 0xD6E8FEB86659FD93 % (1 << 64), np.uint64)
    for column in rows.T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _prints(batches):
    for batch in batches:
        size, one, two, gates = [], [], [], []
        for data in binary_column(batch, "text"):
            s = shingle_set(data)
            size.append(len(s))
            both = xxhash.xxh3_128_intdigest(s.tobytes())
            one.append((both >> 64) - (1 << 63))
            two.append((both & ((1 << 64) - 1)) - (1 << 63))
            gates.append(None)
            if len(s):
                rows = minhashes(s, GATE_TREES * PREFIX).reshape(GATE_TREES, PREFIX)
                gates[-1] = np.concatenate([_key(rows[t:t + 1], t) for t in range(GATE_TREES)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
             pa.array(gates, pa.list_(pa.int64()))], names=["doc_id", "n", "one", "two", "gates"])


def _signatures(batches):
    for batch in batches:
        rows = ([], [], [], [])
        for data in binary_column(batch, "text"):
            s = shingle_set(data)
            h = minhashes(s, HASHES)
            rows[0].append(len(s))
            rows[1].append((h[:SIGNATURE] >> np.uint64(32)).astype(">u4").tobytes())
            rows[2].append((h >> np.uint64(16)).astype(np.uint8).tobytes())
            rows[3].append(s.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()),
             pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.list_(pa.int64()))],
            names=["rep", "n", "signature", "sketch", "shingles"])


def tree_columns(tree: int) -> np.ndarray:
    """Which hashes, in which order, a tree sorts by."""
    return np.random.Generator(np.random.PCG64(tree)).permutation(SIGNATURE)[:DEPTH]


def _planted(trees: range):
    """Rows of the trees: keys of prefixes of growing depth, and the signature in the tree's order."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), ">u4").reshape(-1, SIGNATURE)
            for t in trees:
                own = sig[:, tree_columns(t)]
                wide = own.astype(np.uint64)
                keys = [pa.array(_key(wide[:, :d], t).view(np.int64)) for d in (PREFIX, 2 * PREFIX, DEPTH)]
                order = pa.array([r.tobytes() for r in np.ascontiguousarray(own)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(4), *keys, order, batch.column(3)],
                    names=["rep", "n", "component", "k1", "k2", "k3", "ordering", "sketch"])
    return run


def _neighbours(reach: int, best: int | None, percent: int, slack: float):
    """Candidates among the rows next to each other in a region; rows come sorted by region and signature."""
    share = percent / 100

    def pairs(region, ordering, rep, n, component, sketch):
        found = []
        for w in range(1, min(reach, len(rep) - 1) + 1):
            i = np.flatnonzero((region[w:] == region[:-w]) & (component[w:] != component[:-w])
                               & (100 * np.minimum(n[w:], n[:-w]) >= percent * np.maximum(n[w:], n[:-w])))
            for lo in range(0, len(i), 1 << 14):
                part = i[lo:lo + (1 << 14)]
                alike = (sketch[part] == sketch[part + w]).mean(1)
                ok = alike >= share - slack
                found.append(np.c_[part[ok], part[ok] + w, alike[ok] * 1000])
        if not found:
            return None
        at = np.concatenate(found)
        if best is not None and len(at):
            ends = np.concatenate([at, at[:, [1, 0, 2]]])
            line = np.tile(np.arange(len(at)), 2)
            order = np.lexsort((-ends[:, 2], ends[:, 0]))
            first = ends[order, 0]
            start = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            rank = np.arange(len(first)) - np.repeat(start, np.diff(np.r_[start, len(first)]))
            at = at[np.unique(line[order[rank < best]])]
        i, j = at[:, 0].astype(np.int64), at[:, 1].astype(np.int64)
        return np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            sketch = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, HASHES)
            cols = [*new, sketch]
            if held is not None:  # the last rows again: neighbours across the edge of two batches
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            region, rep, n, component, sketch = cols
            got = pairs(region, None, rep, n, component, sketch)
            held = [c[-reach:] for c in cols]
            if got is not None and len(got[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=["a", "b"])
    return run


def _regions(rows: DataFrame) -> DataFrame:
    """Give each row its region: the prefix key, a deeper one where more than ``CROWD`` rows share it."""
    crowded = lambda key: (rows.groupBy(F.col(key).alias(f"{key}_at")).agg(F.count("*").alias(f"{key}_n"))
                           .filter(F.col(f"{key}_n") > CROWD))
    one, two = written(crowded("k1"), "forest-crowds"), written(crowded("k2"), "forest-crowds")
    rows = rows.join(one, rows.k1 == one.k1_at, "left").join(two, F.col("k2") == two.k2_at, "left")
    chunk = F.pmod(F.xxhash64("rep"), F.ceil(F.coalesce("k2_n", F.lit(1)) / CROWD))
    region = (F.when(F.col("k1_at").isNull(), F.col("k1")).when(F.col("k2_at").isNull(), F.col("k2"))
              .otherwise(F.xxhash64("k3", chunk)))
    return rows.select(region.alias("region"), "rep", "n", "component", "sketch", "ordering", "k1")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs with the flag ``linked``: whether their full sets are similar enough."""
    a = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    b = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return pairs.join(a, "a").join(b, "b").select(
        "a", "b", (100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).alias("linked"))


def _firsts(common: np.ndarray, counts: np.ndarray, percent: int):
    """The first shingles of each set in the order from rare to common. A partner of the set's size or more has one of
    those marked ``few``; a smaller one has one of its own ``few`` among all that are given."""
    def run(batches):
        for batch in batches:
            out = ([], [], [])
            for values in batch.column(3):
                s = values.values.to_numpy()
                at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                times = np.where(common[at] == s, counts[at], 0) if len(common) else np.zeros(len(s), np.int64)
                n = len(s)
                first = s[np.lexsort((s, times))[:n - -(-percent * n // 100) + 1]]
                out[0].append(first)
                out[1].append(np.arange(len(first)))
                out[2].append(np.arange(len(first)) <= n - -(-2 * percent * n // (100 + percent)))
            if not out[0]:
                continue
            row = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in out[0]]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(row) for k in range(3)), *(pa.array(np.concatenate(x)) for x in out)],
                names=["rep", "n", "component", "shingle", "place", "few"])
    return run


def _unmet(sets: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """All pairs of sets of different components that can reach the threshold."""
    rows = sets.join(label, sets.rep == label.node, "left").select(
        "rep", "n", F.coalesce("component", "rep").alias("component"), "shingles")
    total = sets.agg(F.sum("n")).first()[0]
    part = sets.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < max(1, (COUNTED << 20) // total))
    often = part.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("c")).filter("c > 2")
    often = often.toArrow()
    common, counts = (often.column(k).to_numpy() for k in range(2))
    order = np.argsort(common)
    firsts = written(rows.mapInArrow(
        _firsts(common[order], counts[order], percent),
        "rep long, n long, component long, shingle long, place long, few boolean"), "near-firsts")
    # shingles that two components share; sets of the component that has most of one needn't meet each other
    held = firsts.groupBy("shingle", "component").agg(F.count("*").alias("c"), F.max("few").alias("few"))
    shared = held.groupBy("shingle").agg(F.max_by("component", F.struct("c", "component")).alias("main"),
                                         F.count("*").alias("parts"), F.max("few").alias("any"))
    shared = written(shared.filter("parts > 1 and any").select(F.col("shingle").alias("at"), "main"), "near-shared")
    met = written(firsts.join(shared, firsts.shingle == shared.at).drop("at"), "near-met")
    a = met.filter("component != main").select(*(F.col(c).alias(f"{c}_a") for c in firsts.columns))
    b = met.select(*(F.col(c).alias(f"{c}_b") for c in firsts.columns))
    both = a.join(b, (a.shingle_a == b.shingle_b) & (a.component_a != b.component_b))
    # from the first shared shingle on, both have enough shingles left
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    both = both.filter((F.col("few_a") | F.col("few_b"))
                       & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                       & ((100 + percent) * left >= percent * (F.col("n_a") + F.col("n_b"))))
    return both.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    prints = written(d.mapInArrow(_prints, "doc_id long, n long, one long, two long, gates array<long>"), "near-prints")
    known = prints.filter("doc_id is not null and n > 0")
    reps = written(known.groupBy("one", "two").agg(F.min("doc_id").alias("rep")), "near-reps")

    # sets that meet another one at some gate
    rep_gates = known.join(reps.select(F.col("rep").alias("doc_id"), "one", "two"), ["doc_id", "one", "two"], "left_semi")
    gates = rep_gates.select(F.col("doc_id").alias("rep"), F.explode("gates").alias("gate")).distinct()
    met = gates.groupBy("gate").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low != high")
    met = written(met.select("gate"), "near-gates")  # so that the join can split a gate that very many sets share
    ids = written(gates.join(met, "gate", "left_semi").select("rep").distinct(), "near-ids")
    near = sized(ids)
    texts = d.join(near, d.doc_id == near.rep, "left_semi").dropDuplicates(["doc_id"])
    sets = written(texts.mapInArrow(
        _signatures, "rep long, n long, signature binary, sketch binary, shingles array<long>"), "near-sets")

    links, tested, label, trees, active, doubtful = None, None, None, 0, None, None
    while True:
        late = min(trees, 1)
        rows = sets.select("rep", "n", "signature", "sketch")
        if label is None:
            rows = rows.withColumn("component", F.col("rep"))
        else:
            rows = rows.join(sized(active), "rep", "left_semi").join(label, F.col("rep") == label.node, "left").select(
                "rep", "n", "signature", "sketch", F.coalesce("component", "rep").alias("component"))
        forest = rows.mapInArrow(
            _planted(range(trees, trees + ROUND_TREES[late])),
            "rep long, n long, component long, k1 long, k2 long, k3 long, ordering binary, sketch binary")
        trees += ROUND_TREES[late]
        rows = _regions(forest)
        placed = rows.repartition("region").sortWithinPartitions("region", "ordering", "rep")
        pairs = placed.select("region", "rep", "n", "component", "sketch").mapInArrow(
            _neighbours(NEIGHBOURS[late], None if late else BEST, percent, LATE_SLACK if late else SKETCH_SLACK), "a long, b long").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        new = written(confirmed(pairs, sets, percent), "near-confirmed")
        tested = new.select("a", "b") if tested is None else tested.union(new.select("a", "b"))
        fresh = new.filter("linked").select("a", "b")
        if late and fresh.isEmpty():
            break
        links = fresh if links is None else links.union(fresh)
        label = components(links)
        # who may still have a partner: sets that share three hashes with more rows than neighbours were looked at, and,
        # after the first round, those whose further candidates were left for later
        large = rows.groupBy("k1").agg(F.count("*").alias("c")).filter(F.col("c") > NEIGHBOURS[late] + 1)
        active = rows.select("k1", "rep").join(large, "k1", "left_semi").select("rep")
        if not late:
            active = active.union(new.select("a")).union(new.select("b"))
        active = written(active.distinct(), "near-active")
        doubtful = active if doubtful is None else doubtful
        if active.isEmpty():
            break
    if not doubtful.isEmpty():
        pairs = _unmet(sets.join(sized(doubtful), "rep", "left_semi"), label, percent).join(tested, ["a", "b"], "left_anti")
        new = written(confirmed(pairs, sets, percent), "near-confirmed")
        label = components(links.union(new.filter("linked").select("a", "b")))
    reps = reps.join(label, reps.rep == label.node, "left").select(
        "one", "two", F.coalesce("component", "rep").alias("component_id"))
    out = prints.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("one")).alias("one"),
                        "two").join(reps, ["one", "two"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: one of each component. Rows repeated with one doc_id and
    text stay once; a doc_id with different texts stays if one of them does."""
    found = near_duplicates(docs).filter("doc_id is not null").groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.count("*").alias("times"))
    odd = written(found.filter("not kept or times > 1").select(F.col("doc_id").alias("_id"), "kept"), "near-rejected")
    rest = docs.join(sized(odd.select("_id")), F.col("doc_id") == F.col("_id"), "left_anti")
    again = docs.join(sized(odd.filter("kept").select("_id")), F.col("doc_id") == F.col("_id"), "left_semi")
    return rest.unionByName(again.dropDuplicates(["doc_id", "text"]))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))

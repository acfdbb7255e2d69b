"""Order-keeping integers, selection by digits, buckets with literal boundaries, unique keys."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from domus.operators import rank as R
from domus.operators.selection import from_bits, medians, order_statistics, with_bits

EDGES = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
         -1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1e16, 2.0**53 + 2, math.nextafter(1.0, 0), math.nextafter(1.0, 2)]


def doubles():
    r = random.Random(1)
    out = EDGES + [math.nextafter(2.0**k, s) for k in range(-1070, 1024, 7) for s in (-math.inf, math.inf)]
    out += [2.0**k for k in range(-1074, 1024, 5)]
    out += [x for x in (struct.unpack(">d", r.randbytes(8))[0] for _ in range(3000)) if x == x]
    return out + [r.uniform(-1000, 1000) for _ in range(500)]


def test_bits_keep_order_and_come_back(spark):
    df = spark.createDataFrame([(x,) for x in doubles()] + [(float("nan"),), (None,)], "x double")
    rows = [(r.x, r.b) for r in with_bits(df, "x", "b").collect()]
    assert all((x is None) == (b is None) for x, b in rows)
    rows = [(x, b) for x, b in rows if x is not None]
    for x, b in rows:
        if math.isnan(x):
            assert math.isnan(from_bits(b)) and b > max(c for y, c in rows if y == y)
        else:
            want = struct.unpack(">q", struct.pack(">d", abs(x)))[0]
            assert b == (want if x >= 0 else -want) and from_bits(b) == x
    ordered = sorted((x, b) for x, b in rows if x == x)
    assert [b for _, b in ordered] == sorted(b for _, b in ordered)


def test_order_statistics_of_many_columns(spark):
    r = random.Random(2)
    rows = [(r.gauss(0, 1), float(r.randint(0, 3)) if r.random() < 0.7 else None, None, r.choice([7.0, r.random()]),
             r.choice(EDGES)) for _ in range(3001)]
    df = spark.createDataFrame(rows, "a double, b double, nothing double, `one value` double, edges double").repartition(5)
    got = order_statistics(df, df.columns, lambda n: [1, n // 3, n // 3, n, n + 5, 0])
    for k, c in enumerate(df.columns):
        values = sorted(row[k] for row in rows if row[k] is not None)
        n = len(values)
        assert got[c] == (n, {q: values[q - 1] for q in {1, n // 3, n} if 0 < q <= n})
    mid = medians(df, df.columns[:4])
    for k, c in enumerate(df.columns[:4]):
        values = [row[k] for row in rows if row[k] is not None]
        assert mid[c] == (float(np.median(values)) if values else 0.0)
    assert medians(df.limit(0), ["a"]) == {"a": 0.0}


def test_selection_moves_counts_only(spark, monkeypatch):
    """No sort of values, no percentile, no checkpoint: the shuffled rows are counts."""
    df = spark.range(200_000).select((F.col("id") % 300).cast("double").alias("v"))
    monkeypatch.setattr(type(df), "checkpoint", lambda *_, **__: pytest.fail("checkpoint"))
    got = order_statistics(df, ["v"], lambda n: [1, n // 2, n])
    assert got["v"] == (200_000, {1: 0.0, 100_000: 149.0, 200_000: 299.0})


def brute_rank(rows, cols):
    return sorted(rows, key=lambda r: R._sort_key([r[c] for c in cols]))


@pytest.mark.parametrize("sample", [16_384, 300])
def test_global_rank_with_ties_nulls_and_text(spark, monkeypatch, sample):
    monkeypatch.setattr(R, "SAMPLE", sample)
    r = random.Random(3)
    rows = [{"v": r.choice([5.0, 5.0, 5.0, None, float("nan"), r.gauss(0, 10)]), "t": f"é{k % 50}" if k % 3 else None, "k": k}
            for k in range(4000)]
    df = spark.createDataFrame([(x["v"], x["t"], x["k"]) for x in rows], "v double, t string, k long").repartition(7)
    ranked = R.global_rank(df, ["v", "t", "k"])
    got = {x.k: x["rank"] for x in ranked.collect()}
    assert got == {x["k"]: i + 1 for i, x in enumerate(brute_rank(rows, ["v", "t", "k"]))}
    sizes = [x["count"] for x in R.with_range_buckets(df, ["v", "t", "k"]).groupBy("_rk_bucket").count().collect()]
    assert len(sizes) >= 16 and max(sizes) < 4000 / 8  # the value that half of the rows hold is spread
    assert R.global_rank(df.limit(0), ["k"]).collect() == []


def test_global_rank_shuffles_once(spark):
    df = spark.createDataFrame([(k, k % 7) for k in range(1000)], "k long, v long")
    ranked = R.global_rank(df, ["v", "k"])
    ranked.write.format("noop").mode("overwrite").save()
    plan = ranked._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") <= 2  # once in the final, once in the first plan
    assert "SinglePartition" not in plan and "rangepartitioning" not in plan


def test_running_totals_of_a_group_over_many_buckets(spark):
    rows = [("big" if k % 3 else "small", float(k), 1 + k % 4) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, v double, n long").repartition(4)
    got = {(x.g, x.v): x.n_cum for x in R.running_totals(df, ["g"], ["v"], ["n"]).collect()}
    acc, want = {}, {}
    for g, v, n in sorted(rows, key=lambda x: x[1]):
        acc[g] = acc.get(g, 0) + n
        want[g, v] = acc[g]
    assert got == want


def test_unique_keys(spark):
    df = spark.createDataFrame([(k, str(k % 10)) for k in range(100)], "a long, b string")
    assert R.repeated_keys(df, ["a"]) == (0, 0)
    assert R.repeated_keys(df, ["b"]) == (90, 0)
    assert R.repeated_keys(df.unionByName(df.limit(3)), ["a", "b"]) == (3, 0)
    assert R.repeated_keys(df.withColumn("a", F.when(F.col("a") > 1, F.col("a"))), ["a"]) == (0, 2)
    R.require_unique(df, "a")
    with pytest.raises(ValueError, match="not unique"):
        R.require_unique(df, ("b",))


def test_splits_and_folds_are_projections(spark, monkeypatch):
    """Once the cuts are known nothing is shuffled, and a table whose key was checked isn't checked again."""
    from domus.operators import split as P

    df = spark.createDataFrame([(f"u{k}", k) for k in range(500)], "uid string, v long")
    for out in (P.exact_split(df), P.kfold_assign(df, "uid", 5), P.half_split(df, ["v", "uid"])):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(P, "require_unique", lambda *_: pytest.fail("asked again"))
    sizes = {r["part"]: r["count"] for r in P.exact_split(df, check_unique=False).groupBy("part").count().collect()}
    assert sizes == {"train": 300, "cal": 100, "test": 100}


def test_cut_buckets_are_found_by_two_comparisons(spark):
    """a filter on the bucket column was expanded through each step of the binary search."""
    keys = spark.range(5000).select(F.format_string("k%05d", "id").alias("a"), (F.col("id") % 3).alias("b"))
    bounds = [F.struct(F.lit(f"k{k:05d}").alias("a"), F.lit(k % 3).cast("long").alias("b")) for k in range(5, 5000, 5)]
    few = R._rows_of_buckets(keys, F.struct("a", "b"), bounds, [0, 7, len(bounds)])
    assert len(few._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    got = {(r.a, r[R._BUCKET_COL]) for r in few.collect()}
    assert got == ({(f"k{k:05d}", 0) for k in range(5)} | {(f"k{k:05d}", 7) for k in range(35, 40)}
                   | {(f"k{k:05d}", 999) for k in range(4995, 5000)})
    everything = R.with_bucket(keys, F.struct("a", "b"), bounds).groupBy(R._BUCKET_COL).count().collect()
    assert len(everything) == 1000 and {r["count"] for r in everything} == {5}
    found, _, n = R.cut_keys(keys, ["a", "b"], lambda total: [total // 2, 1, total])
    assert n == 5000 and found == {2500: ["k02499", 0], 1: ["k00000", 0], 5000: ["k04999", 1]}

"""E4 global_rank and friends: exact order statistics without a one-partition window.

A ``Window`` with no ``partitionBy`` moves the whole dataset into one task. Instead rows
are split into *buckets* that are contiguous in the sort order:

- for hash orders (``md5``) the bucket is the leading hex digits of the hash, which is
  uniform, deterministic and needs no sampling;
- for any other order the boundaries are quantiles of a sample of about ``SAMPLE`` keys. They become
  literals, and the bucket of a row is a function of its whole sort key, so even one value that a
  third of the rows hold is spread over many buckets by the columns that break ties. No row is
  moved or written to find its bucket, and a recompute after executor loss finds the same one.
  The sample decides how even the buckets are, and no result.

Bucket totals are a few thousand numbers at most; their prefix sums are the offsets.
Only the buckets that contain a requested cut are ever sorted when cuts are asked for,
and a full rank sorts each bucket independently, after one shuffle. Sample, totals and result
each read the input: callers hand in a written table or a cheap projection of one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domus.operators.selection import order_statistics

#: Sampled keys, rows a bucket, and buckets at most (a literal each).
SAMPLE = 16_384
ROWS_PER_BUCKET = 1_000_000
BUCKETS = 2_048
_BUCKET_COL = "_rk_bucket"


def hash_order(seed: int, *key_cols: str) -> Column:
    """Seeded pseudo-random order key: ``md5(seed | key...)`` (hex string)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))


def hash_bucket(hash_col: str, digits: int) -> Column:
    """Bucket id from the first ``digits`` hex characters (monotone in the hash order)."""
    return F.conv(F.substring(F.col(hash_col), 1, digits), 16, 10).cast("long")


def with_bucket(df: DataFrame, position: Column, bounds: list[Column], name: str = _BUCKET_COL) -> DataFrame:
    """Add the number of ascending literal boundaries that are not above a row's position.

    A binary search in projections: each halves the span by one comparison, so that rows cost the logarithm of the
    number of boundaries, inside generated code."""
    if not bounds:
        return df.withColumn(name, F.lit(0).cast("long"))
    at, listed = f"{name}_at", f"{name}_bounds"
    df = df.withColumns({at: position, name: F.lit(0), listed: F.array(*bounds)})
    step = 1 << (len(bounds).bit_length() - 1)
    while step:
        upper = F.get(F.col(listed), F.col(name) + (step - 1))  # null behind the last one
        df = df.withColumn(name, F.col(name) + F.when(upper <= F.col(at), step).otherwise(0))
        step //= 2
    return df.withColumn(name, F.col(name).cast("long")).drop(at, listed)


def _sort_key(row) -> tuple:
    """Python twin of Spark's ascending order: nulls first, NaN last, text by code point."""
    return tuple((v is not None, isinstance(v, float) and math.isnan(v), 0 if v is None or v != v else v) for v in row)


def sampled_bounds(df: DataFrame, order_cols: list[str], n: int | None = None) -> list[list]:
    """Distinct boundary keys, ascending, for buckets of about equal size."""
    n = df.count() if n is None else n
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(BUCKETS, max(4 * parts, math.ceil(n / ROWS_PER_BUCKET)))
    keys = df.select(*order_cols)
    if n > SAMPLE:
        keys = keys.sample(SAMPLE / n, seed=17)
    seen = sorted((list(r) for r in keys.collect()), key=_sort_key)
    picked = [seen[len(seen) * k // wanted] for k in range(1, wanted)] if seen else []
    return [b for k, b in enumerate(picked) if k == 0 or b != picked[k - 1]]


def range_bounds(df: DataFrame, order_cols: list[str], n: int | None = None) -> list[Column]:
    """The sampled boundary keys as literals."""
    types = {f.name: f.dataType for f in df.select(*order_cols).schema.fields}
    return [F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order_cols, b, strict=True)])
            for b in sampled_bounds(df, order_cols, n)]


def with_range_buckets(df: DataFrame, order_cols: list[str], n: int | None = None) -> DataFrame:
    """Add ``_rk_bucket``, ascending with the key."""
    return with_bucket(df, F.struct(*order_cols), range_bounds(df, order_cols, n))


def _in_range(position: Column, bounds: list[Column], bucket: int) -> Column:
    """Whether a row's position lies in one bucket: two comparisons. A filter on the bucket column itself would be
    pushed below the binary search, whose steps double the expression each time."""
    inside = F.lit(True)
    if bucket > 0:
        inside = inside & (position >= bounds[bucket - 1])
    if bucket < len(bounds):
        inside = inside & (position < bounds[bucket])
    return inside


def repeated_keys(df: DataFrame, key_cols: list[str]) -> tuple[int, int]:
    """(rows beyond the first of a repeated key, rows with a null in the key).

    Hashes of 64 bits are counted, so that only they are shuffled; keys are compared only among the rows whose
    hash occurs twice."""
    h = F.xxhash64(*key_cols)
    whole = F.lit(True)
    for c in key_cols:
        whole = whole & F.col(c).isNotNull()
    counts = df.select(h.alias("_h"), whole.alias("_whole")).groupBy("_h").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(~F.col("_whole"), 1)).alias("_nulls"))
    odd = counts.filter((F.col("_n") > 1) | (F.col("_nulls") > 0))
    total = odd.agg(F.coalesce(F.sum("_nulls"), F.lit(0)).alias("nulls"), F.count(F.lit(1)).alias("odd")).first()
    if not total["odd"]:
        return 0, 0
    again = df.select(*key_cols, h.alias("_h")).filter(whole).join(odd.select("_h"), "_h", "left_semi")
    groups = again.groupBy(*key_cols).count().filter("count > 1")
    return int(groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]), int(total["nulls"])


def require_unique(df: DataFrame, key: str | list[str] | tuple[str, ...]) -> None:
    """``ValueError`` if the key is null or repeated somewhere. Ask once a table: splits of it take its word."""
    repeated, nulls = repeated_keys(df, [key] if isinstance(key, str) else list(key))
    if repeated or nulls:
        raise ValueError(f"order key {key!r} is not unique and non-null ({repeated} repeated, {nulls} null)")


def _lex_greater(order_cols: list[str], values: list) -> Column:
    """Row key strictly after ``values`` in ascending lexicographic order (non-null keys)."""
    expr = None
    for i in range(len(order_cols) - 1, -1, -1):
        c, v = F.col(order_cols[i]), F.lit(values[i])
        expr = (c > v) if expr is None else ((c > v) | ((c == v) & expr))
    return expr


def _bucket_offsets(df: DataFrame) -> list[tuple[int, int, int]]:
    """Sorted (bucket, offset, total) — one row per non-empty bucket (bounded, collected)."""
    rows = df.groupBy(_BUCKET_COL).agg(F.count(F.lit(1)).alias("_t")).collect()
    out, acc = [], 0
    for r in sorted(rows, key=lambda r: r[_BUCKET_COL]):
        out.append((int(r[_BUCKET_COL]), acc, int(r["_t"])))
        acc += int(r["_t"])
    return out


def _locate(offsets: list[tuple[int, int, int]], rank: int) -> tuple[int, int]:
    """(bucket, local rank) of a 1-based global rank."""
    for b, off, tot in offsets:
        if off < rank <= off + tot:
            return b, rank - off
    raise ValueError(f"rank {rank} outside 1..{offsets[-1][1] + offsets[-1][2] if offsets else 0}")


def with_buckets(df: DataFrame, order_cols: list[str], bucket: Column | None,
                 n: int | None = None) -> DataFrame:
    if bucket is not None:
        return df.withColumn(_BUCKET_COL, bucket)
    return with_range_buckets(df, order_cols, n)


def _rows_of_buckets(keys: DataFrame, position: Column, bounds: list[Column], buckets: list[int]) -> DataFrame:
    """The rows of a few range buckets, with their bucket."""
    inside = [(k, _in_range(position, bounds, k)) for k in buckets]
    chosen = F.coalesce(*[F.when(c, F.lit(k).cast("long")) for k, c in inside])
    return keys.filter(reduce(lambda a, b: a | b, [c for _, c in inside])).withColumn(_BUCKET_COL, chosen)


def cut_keys(df: DataFrame, order_cols: list[str], cuts, bucket: Column | None = None,
             n: int | None = None) -> tuple[dict[int, list], list[int], int]:
    """Order-key values of the rows at the given 1-based ranks (only cut buckets are sorted).

    ``cuts`` is a list of ranks or a function of the row count returning one. Returns
    (keys by rank, the cut ranks, row count).
    """
    keys = df.select(*order_cols)
    position = F.struct(*order_cols)
    bounds = range_bounds(keys, order_cols, n) if bucket is None else []
    b = with_bucket(keys, position, bounds) if bucket is None else keys.withColumn(_BUCKET_COL, bucket)
    offsets = _bucket_offsets(b)
    total = offsets[-1][1] + offsets[-1][2] if offsets else 0
    cuts = list(cuts(total)) if callable(cuts) else list(cuts)
    wanted = {c: _locate(offsets, c) for c in cuts if 0 < c <= total}
    if not wanted:
        return {}, cuts, total
    buckets = sorted({bk for bk, _ in wanted.values()})
    w = Window.partitionBy(_BUCKET_COL).orderBy(*order_cols)
    few = b.filter(F.col(_BUCKET_COL).isin(buckets)) if bucket is not None else _rows_of_buckets(
        keys, position, bounds, buckets)
    local = few.withColumn("_rn", F.row_number().over(w))
    cond = None
    for bk, r in set(wanted.values()):
        c = (F.col(_BUCKET_COL) == bk) & (F.col("_rn") == r)
        cond = c if cond is None else (cond | c)
    got = {(int(r[_BUCKET_COL]), int(r["_rn"])): [r[c] for c in order_cols]
           for r in local.filter(cond).select(_BUCKET_COL, "_rn", *order_cols).collect()}
    return {c: got[pos] for c, pos in wanted.items()}, cuts, total


def segment_by_rank(df: DataFrame, order_cols: list[str], cuts, segment_col: str = "segment",
                    bucket: Column | None = None, n: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Label rows 0..len(cuts) by rank: segment s holds ranks in (cuts[s-1], cuts[s]].

    Exact and partition-independent; order keys must be unique and non-null (``require_unique``). Only the
    buckets containing a cut are sorted; every other row is labelled by comparing its key
    with the (at most ``len(cuts)``) cut keys: a projection, no shuffle. ``cuts`` may be a function of the
    row count, which then comes from the same job that counts the buckets. ``keys`` are the rows' order columns
    where they can be read more cheaply than from ``df``.
    """
    keys, cuts, _ = cut_keys(df if keys is None else keys, order_cols, cuts, bucket, n)
    seg = F.lit(0)
    for c in cuts:
        if c <= 0:
            seg = seg + F.lit(1)
        elif c in keys:
            seg = seg + _lex_greater(order_cols, keys[c]).cast("int")
    return df.withColumn(segment_col, seg)


def global_rank(df: DataFrame, order_cols: list[str], rank_col: str = "rank",
                bucket: Column | None = None, n: int | None = None) -> DataFrame:
    """Exact 1-based ``row_number`` over the whole frame in ``order_cols`` order (nulls first).

    Each bucket is sorted on its own (``Window.partitionBy(bucket)``), then shifted by the
    rows of all earlier buckets. The offsets table has one row per bucket, a size fixed
    by the bucket count, so it is broadcast.
    """
    spark = df.sparkSession
    b = with_buckets(df, order_cols, bucket, n)
    offsets = _bucket_offsets(b)
    off_df = spark.createDataFrame([(bk, off) for bk, off, _ in offsets],
                                   f"{_BUCKET_COL} long, _off long")
    w = Window.partitionBy(_BUCKET_COL).orderBy(*order_cols)
    return (b.join(F.broadcast(off_df), _BUCKET_COL)
            .withColumn(rank_col, F.row_number().over(w) + F.col("_off"))
            .drop(_BUCKET_COL, "_off"))


def running_totals(df: DataFrame, group_cols: list[str], order_cols: list[str],
                   sum_cols: list[str], suffix: str = "_cum") -> DataFrame:
    """Running sums of ``sum_cols`` within each group in ``order_cols`` order, for a bounded number of groups.

    Buckets are cut on (group, order); each computes local running sums and adds the totals of the
    same group in earlier buckets. Works when one group is most of the data (it spans many
    buckets). The offsets have at most a row for each bucket and each group: they are broadcast.
    """
    b = with_range_buckets(df, [*group_cols, *order_cols])
    part = b.groupBy(_BUCKET_COL, *group_cols).agg(*[F.sum(c).alias(c) for c in sum_cols])
    prior = Window.partitionBy(*group_cols).orderBy(_BUCKET_COL).rowsBetween(
        Window.unboundedPreceding, -1)
    offs = part.select(_BUCKET_COL, *group_cols, *[
        F.coalesce(F.sum(c).over(prior), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    local = Window.partitionBy(_BUCKET_COL, *group_cols).orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = b.join(F.broadcast(offs), [_BUCKET_COL, *group_cols])
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(local) + F.col(f"_off_{c}")).alias(f"{c}{suffix}") for c in sum_cols])


def value_at_ranks(df: DataFrame, value_col: str, ranks: list[int]) -> dict[int, float]:
    """Exact order statistics of ``value_col`` (nulls dropped) at 1-based ``ranks``, selected by digits."""
    return order_statistics(df, [value_col], lambda n: ranks)[value_col][1]

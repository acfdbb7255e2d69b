"""Exact order statistics of many columns at once, selected by digits.

Each double becomes a 64-bit integer that keeps its order (the bits of its magnitude, negated below zero), read as four
digits of 16 bits. The first pass counts the leading digits of all columns; the digit that holds a wanted rank is known
from the counts, and the next pass counts the digits behind it, among the values that begin with it. After four passes
the value itself is known. What is shuffled are counts, at most 65,536 a column and wanted rank, whatever the number of
rows; no value moves, nothing is sorted or checkpointed. The input is read once a pass: callers hand in a written
table or a cheap projection of one.

Nulls don't count. NaN ranks above all numbers, and -0.0 equals 0.0, as in Spark's own order.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16
_MANTISSA = 52
_INFINITY = 0x7FF << _MANTISSA
_NAN = 0x7FF8 << 48
_LEAST_NORMAL = 2.0 ** -1022


def _times_power(x: Column, k: Column) -> Column:
    """x * 2**k in two exact steps, so that neither factor leaves the range of doubles."""
    half = F.floor(k / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), k - half)


def with_bits(df: DataFrame, value: str, bits: str) -> DataFrame:
    """Add ``bits``: the 64-bit integer of a double column that keeps its order (null for null)."""
    size, e, m = f"{bits}_size", f"{bits}_exp", f"{bits}_man"
    df = df.withColumn(size, F.abs(F.col(value) + F.lit(0.0)))
    normal = (F.col(size) >= _LEAST_NORMAL) & (F.col(size) < float("inf"))
    df = df.withColumn(e, F.when(normal, F.floor(F.log2(size))))
    # log2 may be off by one beside a power of two: the mantissa tells
    df = df.withColumn(m, F.when(normal, _times_power(F.col(size), F.lit(_MANTISSA) - F.col(e))).when(
        F.col(size) < _LEAST_NORMAL, _times_power(F.col(size), F.lit(1074).cast("long"))))
    lead = F.lit(2.0 ** _MANTISSA)
    up, down = F.col(m) >= 2 * lead, F.col(m) < lead
    exponent = F.col(e) + F.when(up, 1).when(down, -1).otherwise(0)
    mantissa = F.when(up, F.col(m) / 2).when(down, F.col(m) * 2).otherwise(F.col(m)).cast("long")
    magnitude = (F.when(F.isnan(size), F.lit(_NAN)).when(F.col(size) == float("inf"), F.lit(_INFINITY))
                 .when(F.col(size) < _LEAST_NORMAL, F.col(m).cast("long"))
                 .when(normal, (exponent + 1022) * F.lit(1 << _MANTISSA) + mantissa))
    below = (F.col(value) < 0) & ~F.isnan(value)
    return df.withColumn(bits, F.when(below, -magnitude).otherwise(magnitude)).drop(size, e, m)


def from_bits(bits: int) -> float:
    """The double behind an order-keeping integer."""
    value = struct.unpack(">d", struct.pack(">q", abs(bits)))[0]
    return -value if bits < 0 else value


def _range_sql(column: int, prefix: int, shift: int) -> str:
    """Whether a value is of a column and the bits of it, without the last ``shift``, are ``prefix``."""
    terms = [f"c = {column}"]
    for op, bits in ((">=", prefix << shift), ("<=", (prefix << shift) + (1 << shift) - 1)):
        bound = from_bits(bits)
        if bound == bound:  # bits beyond infinity are no number: there the range is open
            terms.append(f"v {op} double('{bound!r}')")
    return f"({' AND '.join(terms)})"


def order_statistics(df: DataFrame, cols: Iterable[str], ranks: Callable[[int], list[int]]
                     ) -> dict[str, tuple[int, dict[int, float]]]:
    """For each column its number of non-null values n, and the values at the 1-based ranks that ``ranks(n)`` names
    (those outside 1..n are left out)."""
    cols = list(cols)
    # columns travel by number: one expanded row a value, of eight bytes and a small integer
    values = df.select(*[F.col(c).cast("double").alias(str(k)) for k, c in enumerate(cols)])
    values = values.unpivot([], [str(k) for k in range(len(cols))], "c", "v").filter(F.col("v").isNotNull())
    values = values.select(F.col("c").cast("int").alias("c"), "v")

    leading = with_bits(values, "v", "b").groupBy("c", F.shiftright("b", 64 - DIGIT).alias("digit")).count().collect()
    per_column: dict[int, list[tuple[int, int]]] = {k: [] for k in range(len(cols))}
    for r in sorted(leading, key=lambda r: (r["c"], r["digit"])):
        per_column[r["c"]].append((r["digit"], r["count"]))
    found = {k: (sum(n for _, n in rows), {}) for k, rows in per_column.items()}
    wanted = []  # (column, digits so far, rank among the values that begin with them, rank)
    for k, (n, _) in found.items():
        for rank in sorted(set(ranks(n))):
            before = 0
            for digit, count in per_column[k]:
                if before < rank <= before + count:
                    wanted.append((k, digit, rank - before, rank))
                before += count
    upto = Window.partitionBy("c", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for shift in range(64 - 2 * DIGIT, -1, -DIGIT):
        if not wanted:
            break
        # a term for each column and wanted rank: values outside their ranges are dropped before their bits are worked out
        near = " OR ".join(_range_sql(k, prefix, shift + DIGIT) for k, prefix in sorted({w[:2] for w in wanted}))
        counts = with_bits(values.filter(near), "v", "b").groupBy(
            "c", F.shiftright("b", shift + DIGIT).alias("prefix"),
            F.shiftright("b", shift).bitwiseAND(F.lit((1 << DIGIT) - 1)).alias("digit")).count()
        counts = counts.withColumn("upto", F.sum("count").over(upto))  # at most 65,536 rows a group
        hit = " OR ".join(f"(c = {k} AND prefix = {prefix} AND upto - count < {local} AND upto >= {local})"
                          for k, prefix, local, _ in wanted)
        rows = counts.filter(hit).collect()
        wanted = [(k, (prefix << DIGIT) + r["digit"], local - (r["upto"] - r["count"]), rank)
                  for k, prefix, local, rank in wanted for r in rows
                  if (r["c"], r["prefix"]) == (k, prefix) and r["upto"] - r["count"] < local <= r["upto"]]
    for k, bits, _, rank in wanted:
        found[k][1][rank] = from_bits(bits)
    return {c: found[k] for k, c in enumerate(cols)}


def medians(df: DataFrame, cols: Iterable[str]) -> dict[str, float]:
    """The middle value of each column, or the mean of both middle ones; 0.0 for a column without values."""
    out = {}
    for c, (n, at) in order_statistics(df, cols, lambda n: [(n + 1) // 2, (n + 2) // 2]).items():
        out[c] = (at[(n + 1) // 2] + at[(n + 2) // 2]) / 2.0 if n else 0.0
    return out

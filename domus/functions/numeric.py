"""Numeric helpers: Python-exact decimal rounding, half-even rounding, clipping.

``F.round(x, 2)`` on a double rounds the *shortest decimal text* of x half-up
(10028.925 -> 10028.93), while Python's ``round(x, 2)`` rounds the *exact binary value*
(10028.92499999999927... -> 10028.92) with ties to even. ``py_round`` reproduces
Python's result with plain double arithmetic, inside codegen:

    p   = x * s                      (s = 10^d, exact)
    err = x * s - p                  (exact, via Veltkamp split of x)
    f   = floor(p); t = (p - f - 0.5) (exact)
    up  = t > 0, or t == 0 and (err > 0, or err == 0 and f odd)
    result = (f + up) / s
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2^27 + 1


def py_round(x: Column, digits: int) -> Column:
    """Python ``round(x, digits)`` for doubles (|x| * 10^digits < 2^52)."""
    s = float(10 ** digits)
    x = x.cast("double")
    p = x * F.lit(s)
    c = x * F.lit(_SPLIT)
    hi = c - (c - x)
    lo = x - hi
    err = (hi * F.lit(s) - p) + lo * F.lit(s)
    f = F.floor(p).cast("double")
    t = (p - f) - F.lit(0.5)
    odd = F.pmod(f, F.lit(2.0)) == 1.0
    up = (t > 0) | ((t == 0) & ((err > 0) | ((err == 0) & odd)))
    return (f + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / F.lit(s)


def py_round_sql(x: str, digits: int) -> str:
    """DuckDB twin of ``py_round``."""
    s = f"{float(10 ** digits)!r}"
    xs = f"CAST({x} AS DOUBLE)"
    p = f"({xs} * {s})"
    c = f"({xs} * {_SPLIT!r})"
    hi = f"({c} - ({c} - {xs}))"
    lo = f"({xs} - {hi})"
    err = f"(({hi} * {s} - {p}) + {lo} * {s})"
    f = f"floor({p})"
    t = f"(({p} - {f}) - 0.5)"
    up = (f"({t} > 0 OR ({t} = 0 AND ({err} > 0 OR ({err} = 0 AND "
          f"(({f} % 2.0) + 2.0) % 2.0 = 1.0))))")
    return f"(({f} + CASE WHEN {up} THEN 1.0 ELSE 0.0 END) / {s})"


def round_half_even(x: Column) -> Column:
    """Python ``round(x)`` to an integer (0.5 -> 0, 1.5 -> 2, 2.5 -> 2)."""
    return F.bround(x, 0)


def clip_low(x: Column, low: float = 0) -> Column:
    """max(x, low), keeping null as null (``greatest`` would skip it)."""
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(x, F.lit(low)))


def clip_high(x: Column, high: float = 1) -> Column:
    """min(x, high), keeping null as null."""
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(x, F.lit(high)))

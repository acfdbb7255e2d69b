"""Map helpers for registry metadata: H20 map_metric_tags, H21 map_merge, H22 map_lookup,
H24 lower_stage. Higher-order map functions run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from domus import constants as C


def metric_tags(tags: Column, prefix: str = C.METRIC_TAG_PREFIX) -> Column:
    """Keep keys starting with ``prefix``, strip it, parse values as double, drop
    values that do not parse."""
    n = len(prefix)
    kept = F.map_filter(tags, lambda k, v: k.startswith(prefix))
    stripped = F.transform_keys(kept, lambda k, v: F.substr(k, F.lit(n + 1)))
    parsed = F.transform_values(stripped, lambda k, v: v.try_cast("double"))
    return F.map_filter(parsed, lambda k, v: v.isNotNull())


def map_merge(base: Column, override: Column) -> Column:
    """``override`` wins on duplicate keys (left map filtered first, so no
    duplicate-key error and no dedup policy needed)."""
    left = F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(override), k))
    return F.map_concat(left, override)


def map_lookup(m: Column, key: str) -> Column:
    """Value for ``key`` or null (callers raise on null where a metric is required)."""
    return F.try_element_at(m, F.lit(key))


def lower_stage(stage: Column) -> Column:
    """Registry stage spelling -> lower-case stage name; unknown -> null."""
    pairs = []
    for low, disp in C.STAGE_DISPLAY.items():
        pairs += [F.lit(disp), F.lit(low)]
    return F.element_at(F.create_map(*pairs), stage)


def epoch_ms_to_ts(ms: Column) -> Column:
    """Creation time from epoch milliseconds (UTC)."""
    return F.timestamp_millis(ms)

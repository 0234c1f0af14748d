"""Distinct counts at every level of a hierarchy, exactly, from one pass over the fact.

Sums of a level add up to those above it; distinct counts don't: an order with two categories counts in both and once above.
The lowest level is counted from its distinct pairs of group and key. Above it a group's keys are a bitmap, and the bitmaps
of a level are joined by OR to those of the level above. Keys are dense integers, so a bitmap of 4 KB holds 32,768 neighbouring
keys; a row is a group and such a stretch of keys, and the bitmaps of a group lie in many tasks. The lowest level, with few keys
to a group, has no bitmaps: there they would outgrow the pairs.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.plans.gold import ORDER_NUMBERS
from storelens.plans.measures import ITEMS
from storelens.plans.metrics import Star, merge, reached

# Measure -> the dense key that it counts.
COUNTED = {"order_count": "order_number", "active_customers": "customer_key"}


def pairs(star: Star, levels: list[str], key: str, where: Mapping[str, Any] | None) -> DataFrame:
    """The different combinations of the lowest level and a key; keys are made distinct before the dimensions are joined."""
    where = dict(where or {})
    rows, foreign, joined = reached(star, ITEMS, [*levels, *where], where, "purchase")
    if key == "order_number":
        rows = rows.join(star.gold(ORDER_NUMBERS), "order_id")
    grain = dict.fromkeys([*foreign, *[c for c in levels if c in rows.columns], key])
    narrow = rows.where(F.col(key).isNotNull()).select(*grain).distinct()
    return joined(narrow).select(*levels, F.col(key).alias("_key")).distinct()


def distinct_up(star: Star, levels: list[str], name: str, where: Mapping[str, Any] | None = None) -> DataFrame:
    """``levels, level_id`` and the measure; ``level_id`` has a bit for each level that is summed over, the lowest in bit 0."""
    found = pairs(star, levels, COUNTED[name], where)
    lowest = found.groupBy(*levels).agg(F.count(F.lit(1)).alias(name)).select(*levels, F.lit(0).alias("level_id"), name)
    upper = levels[:-1]
    stretch = F.bitmap_bucket_number("_key").alias("_stretch")
    maps = found.groupBy(*upper, stretch).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("_map"))
    frames = [lowest]
    for depth in range(len(upper), -1, -1):
        kept = upper[:depth]
        if depth < len(upper):
            maps = maps.groupBy(*kept, "_stretch").agg(F.bitmap_or_agg("_map").alias("_map"))
        counts = maps.groupBy(*kept).agg(F.sum(F.bitmap_count("_map")).alias(name))
        blank = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in levels[depth:]]
        frames.append(counts.select(*kept, *blank, F.lit((1 << (len(levels) - depth)) - 1).alias("level_id"), F.coalesce(name, F.lit(0)).alias(name)))
    return reduce(DataFrame.unionByName, frames)


def distinct_rollup(star: Star, levels: list[str], where: Mapping[str, Any] | None = None) -> DataFrame:
    """Orders and active customers at every level of a hierarchy."""
    return merge([distinct_up(star, levels, name, where) for name in COUNTED], [*levels, "level_id"], list(COUNTED))

"""Latest-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(
    df: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    tie: list[str] | None = None,
) -> DataFrame:
    """One row per key: the last by ``order``, ties settled by the remaining columns.

    The order is total, so the survivor does not depend on partitioning. ``row_number() = 1`` becomes a
    ``WindowGroupLimit`` below the shuffle: each map task sends at most one row per key, which keeps a
    key that holds a large part of the rows from loading a single reducer.
    """
    order = [F.col("_ingested_at").desc_nulls_last()] if order is None else order
    if tie is None:
        tie = [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc_nulls_first() for c in tie])
    return (
        df.withColumn("_position", F.row_number().over(window))
        .where(F.col("_position") == 1)
        .drop("_position")
    )

"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.session import staged

# monotonically_increasing_id() keeps the partition number above this bit and the row number below it.
_ROW_BITS = 33


def dense_key(df: DataFrame, natural_key: str, key_name: str, unique: bool = False) -> DataFrame:
    """Add ``key_name``: the rank 1, 2, 3, ... of ``natural_key`` in ascending order, as ``bigint``.

    Rows are range-partitioned by the key (Spark samples the split points, so the slices are even
    whatever the keys look like), sorted inside each slice and written once with their position. The
    position within the slice plus the number of keys in the slices before it is the dense rank. Only
    the slice counts, one row per partition, meet in one task and are broadcast.

    ``unique`` says that the frame already holds one row per key: its rows are then ranked directly,
    and nothing has to be joined back. NULL keys get no rank.
    """
    if unique:
        return _rank(df, natural_key, key_name).select(key_name, *df.columns)
    keys = df.select(natural_key).where(F.col(natural_key).isNotNull()).distinct()
    return df.join(_rank(keys, natural_key, key_name), natural_key, "left").select(key_name, *df.columns)


def _rank(rows: DataFrame, natural_key: str, key_name: str) -> DataFrame:
    placed = staged(
        rows.repartitionByRange(F.col(natural_key).asc_nulls_last())
        .sortWithinPartitions(F.col(natural_key).asc_nulls_last())
        .withColumn("_place", F.monotonically_increasing_id()),
        f"rank-{key_name}",
    ).withColumn("_slice", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice")
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(key_name, F.when(F.col(natural_key).isNotNull(), F.col("_offset") + position + 1))
        .drop("_slice", "_place", "_offset")
    )

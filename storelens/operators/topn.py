"""Top rows of a frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: Column, n: int, ties: list[str]) -> DataFrame:
    """The first ``n`` rows by ``by``; ``ties`` makes the cut independent of partitioning.

    Plans as ``TakeOrderedAndProject``: every task keeps ``n`` rows, no full sort.
    """
    return df.orderBy(by, *[F.col(c).asc_nulls_last() for c in ties]).limit(n)

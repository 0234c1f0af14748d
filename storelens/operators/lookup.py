"""Join sides that are looked up by key."""

from __future__ import annotations

from pyspark.sql import DataFrame

# What a key takes in a broadcast table beside its columns: row header, pointer and half-filled slots.
_KEY_BYTES = 48
# What a broadcast table may take, in the driver that builds it and again in every executor.
MOST_BYTES = 128 << 20
# Files below this hold too few rows to fill that, however well they are compressed.
LEAST_FILES = 256 << 10


def lookup(rows: DataFrame) -> DataFrame:
    """``rows`` as the side of a join that is looked up by key: merged, not broadcast, where a broadcast would not fit.

    Spark takes a written table for as large as its compressed files, and some of its columns for their share by
    width. A dense key beside a flag is taken for less than a byte a row and fills more than 50 in memory, so that
    millions of rows pass for less than the broadcast size. Where Spark would broadcast by such an estimate the rows
    are counted, by file footers as long as nothing is filtered. What Spark takes for more is shuffled, and
    then AQE knows the true size.
    """
    taken_for = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    broadcast_size = rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if not LEAST_FILES < taken_for <= broadcast_size:
        return rows
    fits = rows.count() * (rows._jdf.schema().defaultSize() + _KEY_BYTES) <= MOST_BYTES
    return rows if fits else rows.hint("merge")

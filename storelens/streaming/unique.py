"""Repeated rows of a stream removed with a state that does not grow with the stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def stream_unique(
    rows: DataFrame, dst: str, checkpoint: str, keys: Sequence[str], event_time: str, lateness: str
) -> StreamingQuery:
    """Append the rows that arrived since the last call, one per key within ``lateness``.

    The watermark is the latest ``event_time`` seen, less ``lateness`` (an interval such as ``2 hours``). Of rows with one key
    the first to arrive is written; another is a repeat as long as its time lies within ``lateness`` of the first. A key is
    forgotten when the watermark passes its first row's time plus ``lateness``, so the state holds the keys of that span and no more.

    A row behind the watermark is late: it is not written, whether or not its key was, and is counted in the query's
    progress as ``numRowsDroppedByWatermark``. Rows without an event time can't be placed; they are not written either.
    Where no row may be lost, and a later row should replace an earlier one, take ``stream_latest`` instead: its table
    needs no watermark.
    """
    timed = rows.where(rows[event_time].isNotNull()).withWatermark(event_time, lateness)
    return (
        timed.dropDuplicatesWithinWatermark(list(keys))
        .writeStream.format("parquet")
        .option("path", dst)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

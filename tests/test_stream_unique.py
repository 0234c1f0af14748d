"""Repeated and late rows of a stream, and the size of the state."""

from __future__ import annotations

from datetime import datetime, timedelta

from storelens.streaming.unique import stream_unique

SCHEMA = "id long, at timestamp, source string"
START = datetime(2024, 1, 1)


class Source:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.batches, self.dropped, self.state = 0, 0, 0

    def add(self, *rows):
        """Rows as (id, minutes, source); streams what is new."""
        made = [(i, None if m is None else START + timedelta(minutes=m), s) for i, m, s in rows]
        self.spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(str(self.folder / "in"))
        return self.run()

    def run(self):
        arriving = self.spark.readStream.schema(SCHEMA).parquet(str(self.folder / "in"))
        query = stream_unique(arriving, str(self.folder / "out"), str(self.folder / "checkpoint"), ["id"], "at", "60 minutes")
        query.awaitTermination()
        for progress in query.recentProgress:
            for state in progress["stateOperators"]:
                self.dropped += state["numRowsDroppedByWatermark"]
                self.state = state["numRowsTotal"]
        return self.rows()

    def rows(self):
        return sorted((r.id, r.source) for r in self.spark.read.parquet(str(self.folder / "out")).collect())


def test_repeated_and_late_rows(spark, tmp_path):
    source = Source(spark, tmp_path)
    assert source.add((1, 0, "a"), (2, 10, "a"), (3, None, "a")) == [(1, "a"), (2, "a")]
    # Repeated within the hour, in another batch; and a row that is old but not behind the watermark.
    assert source.add((1, 30, "b"), (2, 69, "b"), (4, 40, "b"), (4, 41, "c")) == [(1, "a"), (2, "a"), (4, "b")]
    # The watermark moves to 440 minutes: all three are forgotten.
    assert source.add((5, 500, "d")) == [(1, "a"), (2, "a"), (4, "b"), (5, "d")]
    # Late rows are not written, be they new or repeats; a forgotten key comes in again.
    assert source.add((1, 20, "late"), (6, 20, "late"), (1, 510, "again")) == [(1, "a"), (1, "again"), (2, "a"), (4, "b"), (5, "d")]
    assert source.dropped == 2
    # Nothing new: a restart writes nothing.
    before = source.rows()
    assert source.run() == before


def test_state_holds_the_span_and_not_the_stream(spark, tmp_path):
    source = Source(spark, tmp_path)
    for hour in range(0, 24, 4):
        source.add(*[(hour * 1000 + i, hour * 60 + i % 60, "s") for i in range(200)])
    assert len(source.rows()) == 6 * 200
    assert source.state <= 400

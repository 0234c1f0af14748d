"""A table of latest rows that grows by deltas: a batch writes itself and nothing else.

The table is a list of parts: one base, and the deltas since. Each batch writes its own rows, the latest of each key, into
a folder and publishes a list that names it besides the parts before. Reading joins them: rows of the base whose key is in
no delta pass through as they are, and only the others are compared. Which row wins is a total order, so deltas
may come in any order. When the deltas outgrow a share of the base, all is merged into a new base; a byte is then rewritten
so many times as the share says, whatever the number of batches.

Files are sorted by key and carry bounds and a key filter (Parquet's statistics and Bloom filters), which let a lookup of
some keys skip the rest. The list is a version (``plans.versions``): readers keep to the one they opened, a batch
that fails leaves no trace in it, and a batch that is repeated under its id is recognised. One writer at a time; a second one is
noticed when it publishes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storelens.operators import latest
from storelens.plans.versions import Versions
from storelens.session import path_bytes

PARTS = "kind string, path string, batch string, bytes long"
# Deltas are merged into the base when they hold more than this share of its bytes, or are more than so many.
MOST_SHARE = 0.25
MOST_DELTAS = 64


class LatestTable:
    """The latest row of each key under ``root``; ``order`` as in ``latest``, all other columns settle ties."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: list[Column] | None = None):
        self.spark, self.root, self.keys, self.order = spark, root, list(keys), order
        self._versions = Versions(spark, root)

    # Writing

    def merge(self, batch: DataFrame, batch_id: int | str | None = None) -> bool:
        """Add a batch; false if it is empty or already in under its id. Rewrites no row that is in the table."""
        live, parts = self._state()
        name = None if batch_id is None else str(batch_id)
        if name is not None and any(p["batch"] == name for p in parts):
            return False
        folder = self._versions.begin()
        if not self._write(self._latest(batch).repartitionByRange(*self.keys), f"{folder}/rows"):
            return False
        kind = "delta" if parts else "base"
        self._publish(live, folder, [*parts, self._part(kind, f"{folder}/rows", name)])
        deltas = [p for p in self._state()[1] if p["kind"] == "delta"]
        base = next(p["bytes"] for p in self._state()[1] if p["kind"] == "base")
        if len(deltas) > MOST_DELTAS or sum(p["bytes"] for p in deltas) > MOST_SHARE * base:
            self.compact()
        return True

    def compact(self) -> None:
        """Merge all parts into a new base. The ids of its batches stay known."""
        live, parts = self._state()
        if len([p for p in parts if p["path"]]) < 2:
            return
        folder = self._versions.begin()
        self._write(self._merged(parts), f"{folder}/rows")
        merged = [{"kind": "merged", "path": "", "batch": p["batch"], "bytes": 0} for p in parts if p["batch"] is not None]
        self._publish(live, folder, [self._part("base", f"{folder}/rows", None), *merged])

    # Reading

    def read(self) -> DataFrame:
        """All rows of the version that is live now."""
        return self._rows(self._state()[1])

    def lookup(self, wanted: Sequence[Any]) -> DataFrame:
        """The rows whose first key is one of ``wanted``; files and row groups without them are skipped."""
        chosen = F.col(self.keys[0]).isin(list(wanted))
        return self._rows(self._state()[1], lambda rows: rows.where(chosen))

    def delta_bytes(self) -> int:
        return sum(p["bytes"] for p in self._state()[1] if p["kind"] == "delta")

    # Parts

    def _state(self) -> tuple[str | None, list[dict]]:
        live = self._versions.live()
        if live is None:
            return None, []
        return live, [r.asDict() for r in self.spark.read.schema(PARTS).parquet(f"{live}/_parts").collect()]

    def _part(self, kind: str, path: str, batch: str | None) -> dict:
        return {"kind": kind, "path": path, "batch": batch, "bytes": path_bytes(self.spark, path)}

    def _publish(self, before: str | None, folder: str, parts: list[dict]) -> None:
        listed = self.spark.createDataFrame([tuple(p[c] for c in ("kind", "path", "batch", "bytes")) for p in parts], PARTS)
        listed.coalesce(1).write.parquet(f"{folder}/_parts")
        if self._versions.live() != before:
            raise RuntimeError(f"{self.root} was written by another job meanwhile; merge the batch again")
        self._versions.publish(folder)

    def _write(self, rows: DataFrame, path: str) -> bool:
        """Rows that lie in ranges of the key, as files in its order, as many as AQE finds right; false if there is no row."""
        key = self.keys[0]
        placed = rows.sortWithinPartitions(*self.keys)
        # Adaptive: the filter of a small file is small.
        filtered = placed.write.option(f"parquet.bloom.filter.enabled#{key}", "true")
        filtered.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)
        return not self.spark.read.schema(rows.schema).parquet(path).isEmpty()

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest(rows, self.keys, self.order, tie=[c for c in rows.columns if c not in self.keys])

    def _merged(self, parts: list[dict]) -> DataFrame:
        """All rows in ranges of the key, by one shuffle: the ranges keep the rows of a key together, so the latest is chosen there.

        A part has one row per key at most, so a key has no more rows than there are parts.
        """
        held = self.spark.read.parquet(*[p["path"] for p in parts if p["kind"] == "base"])
        added = self.spark.read.schema(held.schema).parquet(*[p["path"] for p in parts if p["kind"] == "delta"])
        return self._latest(held.unionByName(added).repartitionByRange(*self.keys)).select(*held.columns)

    def _rows(self, parts: list[dict], chosen: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        base = [p["path"] for p in parts if p["kind"] == "base"]
        deltas = [p["path"] for p in parts if p["kind"] == "delta"]
        if not base:
            raise FileNotFoundError(f"{self.root} holds no rows yet")
        held = chosen(self.spark.read.parquet(*base))
        if not deltas:
            return held
        added = chosen(self.spark.read.schema(held.schema).parquet(*deltas))
        touched = added.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        match = F.lit(True)
        for key in self.keys:
            match = match & F.col(key).eqNullSafe(F.col(f"_{key}"))
        # Spark broadcasts the touched keys while their size allows it; the base is then never shuffled.
        unchanged = held.join(touched, match, "left_anti")
        rivals = held.join(touched, match, "left_semi").unionByName(added)
        return unchanged.unionByName(self._latest(rivals).select(*held.columns))


def stream_latest(
    rows: DataFrame, table: LatestTable, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Keep a table of latest rows up to date from a stream, a delta per micro-batch; a repeated one is taken once."""

    def merge(batch: DataFrame, batch_id: int) -> Any:
        table.merge(prepare(batch) if prepare else batch, batch_id)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Clustering around centroids, with an equal-average equal-variance search for the nearest one.

Vectors are compared as integers, floor(scale * x), so that every sum and distance is exact. For a vector x of k
components let S be their sum and R = sqrt(k * sum(x^2) - S^2), its deviation. For two vectors

    k * distance^2 >= (S - S')^2 + (R - R')^2.

Centroids are sorted by S. The search starts at a vector's own S and goes outward in both directions, the nearer centroid
first. A direction ends where (S - S')^2 alone exceeds the best distance; a centroid is passed over where the sum of both
terms does. What is left is measured in whole integers. Many vectors are searched side by side. The deviation is a
floating-point number: its term is lowered by more than the rounding error, so no centroid is lost.

Per round every task adds up its vectors by cluster; Spark adds these sums, and one row per centroid and component
comes back. Only centroids are broadcast; their number is a parameter.

Defined results: vectors with another number of components than ``size``, a null or non-finite component, and null vectors
are left out. Scaled components beyond +-2^27 are an error, since squared distances would leave 64 bits. Repeated rows
are vectors of their own. A null id hashes as the text ``null``. Equal hashes are ordered by components. Fewer vectors
than ``k`` give as many centroids as there are vectors; an empty table gives an empty result. At equal distance the lower
number wins. A cluster without vectors keeps its centroid. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.session import staged

LARGEST = 1 << 27
# Vectors searched side by side.
SLICE = 4096


# ---------------------------------------------------------------- search


class Centroids:
    """Centroids sorted by their sum, for exact nearest-neighbour search."""

    def __init__(self, points: np.ndarray):
        sums = points.sum(axis=1)
        order = np.argsort(sums, kind="stable")
        self.points = points[order]
        self.number = order
        self.sums = sums[order]
        self.deviation = deviation(self.points, self.sums)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid and squared distance of each vector, and how many distances were measured."""
        many, k, last = len(vectors), vectors.shape[1], len(self.sums)
        sums = vectors.sum(axis=1)
        spread = deviation(vectors, sums)
        best = np.full(many, np.iinfo(np.int64).max)
        winner = np.full(many, last)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        active = np.arange(many)
        measured = 0
        while len(active):
            above, below = up[active], down[active]
            apart_up = np.where(above < last, self.sums[np.minimum(above, last - 1)] - sums[active], np.iinfo(np.int64).max)
            apart_down = np.where(below >= 0, sums[active] - self.sums[np.maximum(below, 0)], np.iinfo(np.int64).max)
            rises = apart_up <= apart_down
            apart = np.where(rises, apart_up, apart_down)
            # The nearer of the two directions is out of reach, and so is the other.
            reach = apart < np.iinfo(np.int64).max
            reach &= apart.astype(np.float64) ** 2 * (1 - 1e-12) <= best[active].astype(np.float64) * k
            active, rises, apart = active[reach], rises[reach], apart[reach]
            at = np.where(rises, up[active], down[active])
            up[active[rises]] += 1
            down[active[~rises]] -= 1
            apart_r = spread[active] - self.deviation[at]
            slack = 1e-9 * (spread[active] + self.deviation[at]) + 1e-3
            bound = apart.astype(np.float64) ** 2 + np.maximum(np.abs(apart_r) - slack, 0) ** 2
            near = bound * (1 - 1e-12) <= best[active].astype(np.float64) * k
            who, at = active[near], at[near]
            measured += len(who)
            gap = vectors[who] - self.points[at]
            distance = np.einsum("ij,ij->i", gap, gap)
            number = self.number[at]
            better = (distance < best[who]) | ((distance == best[who]) & (number < winner[who]))
            best[who[better]] = distance[better]
            winner[who[better]] = number[better]
        return winner, best, measured


def deviation(points: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """sqrt(k * sum(x^2) - sum(x)^2), as a floating-point number."""
    mean = sums / points.shape[1]
    return np.sqrt(((points - mean[:, None]) ** 2).sum(axis=1) * points.shape[1])


# ---------------------------------------------------------------- vectors


def scaled(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``column`` that are kept, and their integer vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), size)  # null becomes nan
    whole = np.isfinite(values).all(axis=1)
    values = np.floor(values[whole] * scale)
    if (np.abs(values) > LARGEST).any():
        raise ValueError(f"a component is beyond {LARGEST} after scaling")
    return rows[whole], values.astype(np.int64)


def is_kept(column: Column, size: int) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return column.isNotNull() & (F.size(column) == size) & F.forall(column, finite)


def first_centroids(vectors: DataFrame, k: int, seed: str, size: int, scale: int) -> np.ndarray:
    """The ``k`` vectors with the lowest hash of seed and id; a top-k, so only ``k`` rows leave the tasks."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    chosen = (
        vectors.where(is_kept(F.col("vector"), size))
        .orderBy(F.sha2(F.encode(text, "UTF-8"), 256), "vector")
        .limit(k)
        .select("vector")
        .toArrow()
    )
    return scaled(chosen.column("vector"), size, scale)[1]


# ---------------------------------------------------------------- operators


def moved(vectors: DataFrame, points: np.ndarray, scale: int) -> np.ndarray:
    """Every centroid replaced by floor(sum / count) of the vectors nearest to it."""
    size = points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        totals = np.zeros((len(points), size + 1), np.int64)
        for batch in batches:
            _, values = scaled(batch.column(0), size, scale)
            for at in range(0, len(values), SLICE):
                part = values[at : at + SLICE]
                nearest = centroids.nearest(part)[0]
                order = np.argsort(nearest, kind="stable")
                starts = np.flatnonzero(np.diff(nearest[order], prepend=-1))
                each = np.add.reduceat(part[order], starts, axis=0)
                totals[nearest[order][starts], :size] += each
                totals[:, size] += np.bincount(nearest, minlength=len(points))
        some = np.flatnonzero(totals[:, size])
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(some, size + 1).astype(np.int32)),
                    pa.array(np.tile(np.arange(size + 1, dtype=np.int32), len(some))),
                    pa.array(totals[some].ravel()),
                ],
                ["cluster", "component", "total"],
            )

    sums = vectors.select("vector").mapInArrow(run, "cluster int, component int, total long")
    # One row per centroid and component.
    added = sums.groupBy("cluster", "component").agg(F.sum("total").alias("total")).toArrow()
    totals = np.zeros((len(points), size + 1), np.int64)
    totals[added.column("cluster").to_numpy(), added.column("component").to_numpy()] = added.column("total").to_numpy()
    some = totals[:, size] > 0
    points = points.copy()
    points[some] = totals[some, :size] // totals[some, size:]
    return points


def assigned(vectors: DataFrame, points: np.ndarray, scale: int) -> DataFrame:
    """``vec_id, cluster, distance`` of every kept vector."""
    size = points.shape[1]
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        for batch in batches:
            rows, values = scaled(batch.column(1), size, scale)
            for at in range(0, len(rows), SLICE):
                nearest, distance, _ = centroids.nearest(values[at : at + SLICE])
                ids = batch.column(0).take(pa.array(rows[at : at + SLICE]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(nearest.astype(np.int32)), pa.array(distance)], schema.names)

    return vectors.mapInArrow(run, schema)


def clustered(
    table: DataFrame,
    k: int = 16,
    rounds: int = 3,
    size: int = 64,
    scale: int = 64,
    seed: str = "1",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """The assignment after ``rounds`` of moving the centroids, written once, and the final centroids."""
    vectors = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    points = first_centroids(vectors, k, seed, size, scale)
    if not len(points):
        points = np.zeros((1, size), np.int64)  # nothing is kept, so nothing is assigned
    for _ in range(rounds):
        points = moved(vectors, points, scale)
    return staged(assigned(vectors, points, scale), "clusters"), points


def with_inertia(assignment: DataFrame, points: np.ndarray) -> DataFrame:
    """The assignment with the summed distances of its cluster and of all, and a digest of its centroid."""
    spark = assignment.sparkSession
    digests = [(i, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for i, p in enumerate(points.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    own = assignment.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = assignment.agg(F.sum("distance")).scalar().alias("inertia")
    # A row per centroid: its number is a parameter.
    per_cluster = own.join(named, "cluster").select("*", whole)
    return assignment.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

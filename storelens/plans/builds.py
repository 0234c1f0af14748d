"""Where two builds of one table differ, from sums of row hashes.

Rows fall into cells: a bucket of their key within each value of the ``parts`` columns (purchase month, say). Every row is
hashed with all its columns, and the hashes are added up per cell, for one build with the opposite sign of the other:
whatever the order of rows, cells that hold the same rows come to zero. Each build is read once for that, and what is
shuffled is a row per task and cell. Only the rows of cells that do not come to zero are read again and added up key by key.

Rows count as often as they occur. Nulls are equal to each other and to nothing else. Two different cells pass
for equal with a chance of 2^-64. Columns may stand in any order; the names must be the same, and values are compared as the
common type of the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 12
_CELL, _SIGN, _LOW, _HIGH = "_cell", "_sign", "_low", "_high"


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hash(names: Sequence[str]) -> Column:
    """Of all values and which of them are null, so that a null and its neighbour don't change places unseen."""
    return F.xxhash64(*[part for n in names for part in (_named(n), _named(n).isNull())])


def _both(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows of both with their side as a sign, their cell and the halves of their hash."""
    names = left.columns
    if sorted(names) != sorted(right.columns):
        raise ValueError(f"the builds have different columns: {sorted(set(names) ^ set(right.columns))}")
    if missing := {*keys} - {*names}:
        raise ValueError(f"no such key columns: {sorted(missing)}")
    left, right = (side.withColumn(_SIGN, F.lit(sign).cast("long")) for side, sign in ((left, 1), (right, -1)))
    whole = _hash(names)
    return left.unionByName(right).select(
        "*",
        F.pmod(_hash(keys), F.lit(buckets)).alias(_CELL),
        whole.bitwiseAND(F.lit(0xFFFFFFFF)).alias(_LOW),
        F.shiftrightunsigned(whole, 32).alias(_HIGH),
    )


def _sums(rows: DataFrame, by: Sequence[Column]) -> DataFrame:
    signed = [F.sum(_named(c) * F.col(_SIGN)).alias(c) for c in (_LOW, _HIGH)]
    return rows.groupBy(*by).agg(F.count_if(F.col(_SIGN) > 0).alias("left_rows"), F.count_if(F.col(_SIGN) < 0).alias("right_rows"), *signed)


def _differ() -> Column:
    return (F.col("left_rows") != F.col("right_rows")) | (F.col(_LOW) != 0) | (F.col(_HIGH) != 0)


def agreement(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """One row per value of ``parts`` (one in all without): ``left_rows, right_rows, differing_cells``."""
    rows = _both(left, right, keys, buckets)
    cells = _sums(rows, [*map(_named, parts), F.col(_CELL)])
    found = [F.sum(c).alias(c) for c in ("left_rows", "right_rows")] + [F.count_if(_differ()).alias("differing_cells")]
    grouped = cells.groupBy(*map(_named, parts)).agg(*found)
    return grouped if parts else grouped.na.fill(0)


def differing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], parts: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """The keys whose rows are not the same in both, with the rows either side has in the cells that differ: 0 where it lacks the key."""
    rows = _both(left, right, keys, buckets)
    cells = _sums(rows, [*map(_named, parts), F.col(_CELL)]).where(_differ())
    apart = cells.select(*[_named(n).alias(f"_part_{i}") for i, n in enumerate(parts)], F.col(_CELL).alias("_apart"))
    if not parts:  # no more rows than buckets; with parts, Spark decides by their number
        apart = F.broadcast(apart)
    same = F.col(_CELL) == F.col("_apart")
    for i, n in enumerate(parts):
        same = same & _named(n).eqNullSafe(F.col(f"_part_{i}"))
    return _sums(rows.join(apart, same, "left_semi"), [*map(_named, keys)]).where(_differ()).drop(_LOW, _HIGH)

"""Two builds of one table compared by sums of row hashes."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storelens.plans.builds import agreement, differing_keys
from tests.conftest import plan_of, values

SCHEMA = "id long, line int, month int, price decimal(10,2), `a b` string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_key(rows):
    found: dict[tuple, Counter] = {}
    for row in rows:
        found.setdefault(row[:2], Counter())[row] += 1
    return found


@pytest.mark.parametrize("parts", [(), ("month",)])
@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_differing_keys_against_brute_force(spark, parts, buckets):
    rng = random.Random(buckets)
    value = lambda: rng.choice([None, "", "x", "y z"])
    left = [(rng.choice([None, *range(60)]), rng.choice([None, 1, 2]), rng.choice([None, 1, 2, 3]), None, value()) for _ in range(150)]
    right = [row for row in left if rng.random() > 0.05]
    right = [(*row[:4], value()) if rng.random() < 0.05 else row for row in right]
    right = [(row[0], row[1], 3, *row[3:]) if rng.random() < 0.05 else row for row in right]
    right += rng.sample(left, 3)
    rng.shuffle(right)
    ours, theirs = by_key(left), by_key(right)
    expected = {key for key in ours.keys() | theirs.keys() if ours.get(key) != theirs.get(key)}
    got = differing_keys(frame(spark, left), frame(spark, right), ["id", "line"], parts, buckets).collect()
    assert {tuple(r)[:2] for r in got} == expected and len(got) == len(expected) > 5
    if not parts:
        assert all((r.left_rows, r.right_rows) == (sum(ours.get(k, {}).values()), sum(theirs.get(k, {}).values())) for r in got for k in [tuple(r)[:2]])
    sums = agreement(frame(spark, left), frame(spark, right), ["id", "line"], parts, buckets).collect()
    assert sum(r.left_rows for r in sums) == len(left) and sum(r.right_rows for r in sums) == len(right)
    assert any(r.differing_cells for r in sums)


def test_equal_builds(spark):
    """Order of rows and columns and partitioning don't matter, repeated rows do."""
    rows = [(i % 50, i % 3, i % 4, None, "x") for i in range(300)]
    left = frame(spark, rows)
    right = frame(spark, rows[::-1]).select("a b", "price", "month", "line", "id").repartition(5)
    assert values(agreement(left, right, ["id", "line"])) == [(300, 300, 0)]
    assert all(r.differing_cells == 0 for r in agreement(left, right, ["id", "line"], ["month"]).collect())
    assert values(differing_keys(left, right, ["id", "line"])) == []
    more = left.union(left.where("id = 7"))
    assert values(differing_keys(left, more, ["id"])) == [(7, 6, 12)]


def test_nulls_do_not_change_places(spark):
    schema = "id long, a string, b string"
    left = spark.createDataFrame([(1, None, "x"), (2, "x", None), (None, None, None)], schema)
    right = spark.createDataFrame([(1, "x", None), (2, "x", None), (None, None, None)], schema)
    assert values(differing_keys(left, right, ["id"])) == [(1, 1, 1)]


def test_empty_builds(spark):
    empty, some = frame(spark, []), frame(spark, [(1, 1, 1, None, "x")])
    assert values(agreement(empty, empty, ["id"])) == [(0, 0, 0)]
    assert values(agreement(empty, empty, ["id"], ["month"])) == values(differing_keys(empty, empty, ["id"])) == []
    assert values(differing_keys(some, empty, ["id"])) == [(1, 1, 0)]
    assert values(differing_keys(empty, some, ["id"])) == [(1, 0, 1)]


def test_columns_must_be_the_same(spark):
    some = frame(spark, [(1, 1, 1, None, "x")])
    with pytest.raises(ValueError, match="different columns"):
        agreement(some, some.drop("price"), ["id"])
    with pytest.raises(ValueError, match="no such key"):
        differing_keys(some, some, ["order"])


def test_equal_builds_are_read_once(spark, tmp_path):
    """Without a differing cell the rows are not read again, and no row is shuffled as it is."""
    spark.range(50_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("value")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    found = differing_keys(table, table, ["id"])
    assert found.collect() == []
    final = plan_of(found).split("== Initial Plan ==")[0]
    assert "LocalTableScan <empty>" in final or "EmptyRelation" in final, final

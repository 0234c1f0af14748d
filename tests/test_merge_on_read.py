"""Tables of latest rows that grow by deltas."""

from __future__ import annotations

import itertools
import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storelens.operators import latest
from storelens.plans import silver
from storelens.streaming import merge_on_read
from storelens.streaming.merge_on_read import LatestTable, stream_latest
from tests.conftest import plan_of, values

SCHEMA = "id long, part int, _ingested_at timestamp_ntz, value string"


def rows(spark, many, at, seed=0, least=0):
    stamp = F.lit(f"2024-01-01 00:{at:02}:00").cast("timestamp_ntz")
    return spark.range(least, least + many).select(
        "id", (F.col("id") % 3).cast("int").alias("part"), stamp.alias("_ingested_at"), F.sha2((F.col("id") + seed).cast("string"), 256).alias("value")
    )


def folder_files(root):
    return {(str(p), p.stat().st_mtime_ns, p.stat().st_size) for p in Path(root).rglob("*.parquet")}


def test_a_small_batch_writes_only_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    table = LatestTable(spark, root, ["id", "part"])
    table.merge(rows(spark, 50_000, 1))
    before = folder_files(root)
    ids = random.Random(1).sample(range(50_000), 300)
    change = rows(spark, 50_000, 2, seed=7).where(F.col("id").isin(ids))
    table.merge(change)
    after = folder_files(root)
    assert before <= after
    new = sum(size for _, _, size in after - before)
    assert new < 0.05 * sum(size for _, _, size in before)
    got = table.read()
    assert got.count() == 50_000 and got.where("_ingested_at > '2024-01-01 00:01:30'").count() == 300
    # The base meets the keys of the delta by broadcast and is not shuffled for it.
    assert "BroadcastHashJoin" in plan_of(got) and "SortMergeJoin" not in plan_of(got)


def test_reads_equal_a_rebuild_in_any_order(spark, tmp_path):
    rng = random.Random(2)

    def batch(n):
        made = [(rng.choice([*range(12), None]), rng.randrange(2), None if rng.random() < 0.1 else f"2024-01-0{rng.randint(1, 4)}", f"v{rng.randrange(5)}") for _ in range(n)]
        return spark.createDataFrame(made, "id long, part int, at string, value string").select(
            "id", "part", F.col("at").cast("timestamp_ntz").alias("_ingested_at"), "value"
        )

    batches = [batch(9).cache() for _ in range(3)]
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    expected = values(latest(whole, ["id", "part"], tie=["_ingested_at", "value"]).select("id", "part", "_ingested_at", "value"))
    for n, order in enumerate(itertools.permutations(range(3))):
        table = LatestTable(spark, str(tmp_path / f"t{n}"), ["id", "part"])
        for i in order:
            table.merge(batches[i])
        if n % 2:
            table.compact()
        assert values(table.read().select("id", "part", "_ingested_at", "value")) == expected


def test_empty_and_repeated_batches(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), ["id"])
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(FileNotFoundError):
        table.read()
    assert not table.merge(empty)
    assert table.merge(rows(spark, 100, 1), 0)
    assert not table.merge(empty, 1)
    assert table.merge(rows(spark, 5, 2), 2) and not table.merge(rows(spark, 5, 3), 2)
    table.compact()
    assert not table.merge(rows(spark, 5, 3), 2)  # known after its delta is merged as well
    assert table.read().agg(F.max("_ingested_at").cast("string")).first()[0] == "2024-01-01 00:02:00"


def test_deltas_are_merged_when_they_outgrow_the_base(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge_on_read, "MOST_DELTAS", 3)
    table = LatestTable(spark, str(tmp_path / "t"), ["id"])
    table.merge(rows(spark, 20_000, 0))
    sizes = []
    for n in range(1, 6):
        table.merge(rows(spark, 50, n, seed=n, least=n * 100))
        sizes.append(table.delta_bytes())
    assert sizes[0] < sizes[1] < sizes[2] and sizes[3] == 0 < sizes[4]
    table.merge(rows(spark, 15_000, 9, seed=9))
    assert table.delta_bytes() == 0 and table.read().count() == 20_000


def test_a_reader_keeps_its_version_and_a_failed_batch_leaves_none(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), ["id"])
    table.merge(rows(spark, 100, 1))
    held = table.read()
    with pytest.raises(Exception, match="torn"):
        table.merge(rows(spark, 100, 2).withColumn("value", F.expr("if(id = 50, raise_error('torn'), value)")))
    table.merge(rows(spark, 200, 3))
    table.compact()
    assert held.count() == 100 and table.read().count() == 200


def test_lookup_skips_what_its_bounds_exclude(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), ["id"])
    table.merge(rows(spark, 1000, 1))
    table.merge(rows(spark, 10, 2, seed=3))
    found = table.lookup([5, 500])
    assert {r.id: r._ingested_at.minute for r in found.collect()} == {5: 2, 500: 1}
    assert "PushedFilters: [In(id" in plan_of(found)


def test_stream_of_deltas(spark, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    table = LatestTable(spark, str(tmp_path / "t"), ["id"])
    for n in (2, 1):  # the later one first
        rows(spark, 50, n, seed=n).coalesce(1).write.mode("append").parquet(str(source))
        stream_latest(spark.readStream.schema(SCHEMA).parquet(str(source)), table, checkpoint).awaitTermination()
    assert {r._ingested_at.minute for r in table.read().collect()} == {2}
    before = folder_files(table.root)
    stream_latest(spark.readStream.schema(SCHEMA).parquet(str(source)), table, checkpoint).awaitTermination()
    assert folder_files(table.root) == before


def test_a_new_base_takes_one_shuffle(spark, tmp_path):
    """Rows of the base and of the deltas are placed once, in the ranges in which they are written."""
    table = LatestTable(spark, str(tmp_path), ["id", "part"])
    for n in range(3):
        rows = [(i, i % 3, datetime(2024, 1, 1, 0, n), f"v{n}") for i in range(0, 400 if n == 0 else 40, n + 1)]
        table._publish(*listed(table, spark.createDataFrame(rows, SCHEMA), n))
    before = values(table.read())
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        plan = plan_of(table._merged(table._state()[1]))
    finally:
        for key in small:
            spark.conf.unset(key)
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1
    table.compact()
    assert values(table.read()) == before and table.delta_bytes() == 0


def listed(table, rows, n):
    """A part that is written without the compaction that would follow it."""
    live, parts = table._state()
    folder = table._versions.begin()
    rows.repartitionByRange("id", "part").sortWithinPartitions("id", "part").write.parquet(f"{folder}/rows")
    return live, folder, [*parts, table._part("delta" if parts else "base", f"{folder}/rows", str(n))]


def test_items_of_a_merged_table_are_not_sorted_out_again(spark, tmp_path):
    lines = "select 1L order_id, 1 order_item_id, 5L product_id, 6L seller_id, timestamp_ntz'2024-01-09' shipping_limit_date, 1.5 price, 0.5 freight_value"
    rows = spark.sql(f"{lines}, timestamp_ntz'2024-01-01' _ingested_at")
    assert values(silver.typed_items(rows)) == values(silver.order_items(rows))
    assert "Window" not in plan_of(silver.typed_items(rows)) and "Window" in plan_of(silver.order_items(rows))

from __future__ import annotations

import random
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storelens.operators import latest
from storelens.streaming import delta_since, stream_bronze, stream_upsert, upsert
from storelens.streaming.incremental import BUCKET, bucket_of, merge_batch
from tests.conftest import values
from tests.retail import ROWS, write_csv

SCHEMA = "k int, _ingested_at timestamp, v string"
DAY = datetime(2024, 1, 1)


def rows_at(spark, rows):
    return spark.createDataFrame([(k, DAY + timedelta(days=t), v) for k, t, v in rows], SCHEMA)


def table(spark, target):
    return spark.read.parquet(target).select("k", "_ingested_at", "v")


def files_of(target: str) -> dict[str, set[str]]:
    return {p.name: {f.name for f in p.glob("*.parquet")} for p in Path(target).glob(f"{BUCKET}=*")}


def test_each_file_is_loaded_once(spark, tmp_path):
    src, dst, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    first = write_csv(tmp_path / "first", {"order_reviews": ROWS["order_reviews"][:2]})
    second = write_csv(tmp_path / "second", {"order_reviews": ROWS["order_reviews"][2:]})
    Path(src).mkdir()
    shutil.copy(first / "order_reviews.csv", Path(src) / "day1.csv")
    for _ in range(2):
        stream_bronze(spark, src, dst, "order_reviews", checkpoint).awaitTermination()
        assert spark.read.parquet(dst).count() == 2
    shutil.copy(second / "order_reviews.csv", Path(src) / "day2.csv")
    stream_bronze(spark, src, dst, "order_reviews", checkpoint).awaitTermination()
    rows = spark.read.parquet(dst)
    assert rows.count() == len(ROWS["order_reviews"])
    assert {r[0] for r in rows.select("_source_file").distinct().collect()} == {"day1.csv", "day2.csv"}
    assert "_ingest_date" in rows.columns


def test_delta_takes_what_came_after_the_mark(spark):
    df = rows_at(spark, [(1, 0, "a"), (2, 1, "b"), (3, 2, "c")])
    assert [r["k"] for r in delta_since(df, DAY + timedelta(days=1)).collect()] == [3]
    mark = df.agg(F.min("_ingested_at")).scalar()
    assert sorted(r["k"] for r in delta_since(df, mark).collect()) == [2, 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_in_any_order_give_the_full_rebuild(spark, tmp_path, seed):
    random.seed(seed)
    # A third of the rows are copies of one key; many rows tie on the ingestion time.
    rows = [(7 if i % 3 == 0 else random.randrange(20), random.randrange(4), random.choice("abc")) for i in range(90)]
    batches = [rows[i::3] for i in range(3)]
    random.shuffle(batches)
    target, staging = str(tmp_path / "t"), str(tmp_path / "s")
    for n, batch in enumerate(batches):
        merge_batch(rows_at(spark, batch), n, target, ["k"], staging, buckets=4)
    assert values(table(spark, target)) == values(latest(rows_at(spark, rows), ["k"]).select("k", "_ingested_at", "v"))


def test_only_touched_buckets_are_replaced(spark, tmp_path):
    target, staging = str(tmp_path / "t"), str(tmp_path / "s")
    merge_batch(rows_at(spark, [(k, 0, "old") for k in range(40)]), 0, target, ["k"], staging, buckets=8)
    before = files_of(target)
    change = rows_at(spark, [(3, 1, "new")])
    touched = change.select(bucket_of(["k"], 8)).first()[0]
    merge_batch(change, 1, target, ["k"], staging, buckets=8)
    after = files_of(target)
    assert {b for b in before if before[b] != after[b]} == {f"{BUCKET}={touched}"}
    assert {r["v"] for r in table(spark, target).where("k = 3").collect()} == {"new"}
    assert table(spark, target).count() == 40


def test_a_batch_run_again_after_a_crash_repairs_the_table(spark, tmp_path):
    target, staging = str(tmp_path / "t"), str(tmp_path / "s")
    merge_batch(rows_at(spark, [(k, 0, "old") for k in range(20)]), 0, target, ["k"], staging, buckets=2)
    batch = rows_at(spark, [(k, 1, "new") for k in range(0, 20, 2)])
    merge_batch(batch, 1, target, ["k"], staging, buckets=2)
    good = values(table(spark, target))
    # The copy broke off between removing a bucket and putting the new one in place.
    lost = next(Path(target).glob(f"{BUCKET}=*"))
    lost.rename(tmp_path / "lost")
    merge_batch(batch, 1, target, ["k"], staging, buckets=2)
    assert values(table(spark, target)) == good


def test_a_stream_keeps_the_table_up_to_date(spark, tmp_path):
    src, target, checkpoint = (str(tmp_path / n) for n in ("in", "t", "checkpoint"))
    everything = []
    for n in range(3):
        rows = [(k, n if k % 2 else -n, f"v{n}") for k in range(10)]
        everything += rows
        rows_at(spark, rows).write.mode("append").parquet(src)
        arriving = spark.readStream.schema(SCHEMA).parquet(src)
        stream_upsert(arriving, target, ["k"], checkpoint, buckets=3).awaitTermination()
        expected = latest(rows_at(spark, everything), ["k"]).select("k", "_ingested_at", "v")
        assert values(table(spark, target)) == values(expected)


def test_a_merge_is_marked_whatever_the_default(spark, tmp_path):
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(key, "false")
    try:
        merge_batch(rows_at(spark, [(1, 0, "a")]), 0, str(tmp_path / "t"), ["k"], str(tmp_path / "s"), buckets=2)
    finally:
        conf.unset(key)
    assert (tmp_path / "s/0/_SUCCESS").exists()


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    target, staging = str(tmp_path / "t"), str(tmp_path / "s")
    upsert(rows_at(spark, [(1, 0, "a")]).where("k = 2"), target, ["k"], staging, buckets=4)
    assert spark.read.schema(SCHEMA).parquet(target).count() == 0
    upsert(rows_at(spark, [(1, 0, "a")]), target, ["k"], staging, buckets=4)
    upsert(rows_at(spark, [(1, 0, "a")]).where("k = 2"), target, ["k"], staging, buckets=4)
    assert table(spark, target).count() == 1


def test_another_number_of_buckets_is_an_error(spark, tmp_path):
    target, staging = str(tmp_path / "t"), str(tmp_path / "s")
    upsert(rows_at(spark, [(k, 0, "a") for k in range(50)]), target, ["k"], staging, buckets=16)
    with pytest.raises(ValueError, match="buckets"):
        upsert(rows_at(spark, [(1, 1, "b")]), target, ["k"], staging, buckets=8)


def test_direct_batches_need_no_id(spark, tmp_path):
    target, staging = str(tmp_path / "t"), str(tmp_path / "s")
    for part in range(2):
        upsert(rows_at(spark, [(k, 0, "a") for k in range(part * 5, part * 5 + 5)]), target, ["k"], staging, buckets=2)
    assert table(spark, target).count() == 10

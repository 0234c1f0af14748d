"""Incremental loading: streamed bronze, delta extraction, latest-wins upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storelens.operators import latest
from storelens.schemas import RAW
from storelens.session import COMPRESSION, path_exists, remove_path
from storelens.sources.csv import CSV_OPTIONS, MULTI_LINE

BUCKET = "_bucket"
BUCKET_COUNT = "_bucket_count"


def stream_bronze(
    spark: SparkSession, src: str, dst: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Append the CSV files that came into ``src`` since the last call, partitioned by ingest date.

    ``table`` is one of the raw tables; it decides the columns, which the files must have in this order, and whether text
    may hold line breaks. The checkpoint remembers the files already taken, so every file is loaded exactly once.
    """
    rows = (
        spark.readStream.schema(RAW[table])
        .options(**CSV_OPTIONS, multiLine=table in MULTI_LINE)
        .csv(src)
        .withColumn("_source_file", F.col("_metadata.file_name"))
        .withColumn("_ingested_at", F.current_timestamp())
        .withColumn("_ingest_date", F.to_date("_ingested_at"))
    )
    return (
        rows.writeStream.format("parquet")
        .option("path", dst)
        .option("checkpointLocation", checkpoint)
        .partitionBy("_ingest_date")
        .trigger(availableNow=True)
        .start()
    )


def delta_since(bronze: DataFrame, last: datetime | Column) -> DataFrame:
    """Rows ingested after the high-water mark ``last``."""
    return bronze.where(F.col("_ingested_at") > (last if isinstance(last, Column) else F.lit(last)))


def upsert(
    batch: DataFrame, target: str, keys: list[str], staging: str, order: list[Column] | None = None, buckets: int = 64
) -> None:
    """Merge a batch into a Parquet table that holds the latest row of each key."""
    merge_batch(batch, uuid.uuid4().hex, target, keys, staging, order, buckets)


def merge_batch(
    batch: DataFrame,
    batch_id: int | str,
    target: str,
    keys: list[str],
    staging: str,
    order: list[Column] | None = None,
    buckets: int = 64,
) -> None:
    """The same for a batch that may be repeated under its id: a retried micro-batch has the same rows.

    The table is partitioned by a hash bucket of the key; the number of buckets is written beside it, and another number
    is an error later on. Only the buckets that the batch touches are read, merged and replaced. The batch is evaluated
    once. The merge goes to ``staging`` first and is copied over from there: the table is never read while it is
    overwritten, and a batch that runs again after a crash finds its own merge and repeats the copy. The order is total, so
    batches may arrive in any order. An empty batch changes nothing.
    """
    spark = batch.sparkSession
    fixed_buckets(spark, target, buckets)
    merged, taken = f"{staging}/{batch_id}", f"{staging}/{batch_id}-rows"
    rows = batch.withColumn(BUCKET, bucket_of(keys, buckets))
    if not path_exists(spark, f"{merged}/_SUCCESS"):
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(taken)
        fixed = spark.read.schema(rows.schema).parquet(taken)
        # At most ``buckets`` numbers; as literals they prune the folders that are read.
        touched = [r[0] for r in fixed.select(BUCKET).distinct().collect()]
        held = spark.read.schema(rows.schema).parquet(target).where(F.col(BUCKET).isin(touched))
        survivors = latest(fixed.unionByName(held), keys, order, tie=[c for c in batch.columns if c not in keys])
        # AQE sizes the write tasks: small buckets share one, a large bucket is split.
        placed = survivors.hint("rebalance", F.col(BUCKET))
        # The mark of a complete merge, also where the cluster's default leaves it out.
        marked = placed.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        marked.mode("overwrite").option("compression", COMPRESSION).partitionBy(BUCKET).parquet(merged)
        remove_path(spark, taken)
    (
        spark.read.schema(rows.schema)
        .parquet(merged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(BUCKET)
        .parquet(target)
    )
    # The batch before is committed once this one has begun, and a direct call is not repeated.
    remove_path(spark, f"{staging}/{batch_id - 1}" if isinstance(batch_id, int) else merged)


def fixed_buckets(spark: SparkSession, target: str, buckets: int) -> None:
    """Writes the number of buckets beside a new table, or compares it with the one written."""
    mark = f"{target}/{BUCKET_COUNT}"
    if not path_exists(spark, f"{mark}/n={buckets}"):
        if path_exists(spark, mark):
            raise ValueError(f"{target} was written with another number of buckets than {buckets}")
        spark.range(1).select(F.lit(buckets).alias("n"), "id").write.partitionBy("n").parquet(mark)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def stream_upsert(
    rows: DataFrame,
    target: str,
    keys: list[str],
    checkpoint: str,
    order: list[Column] | None = None,
    buckets: int = 64,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Keep a silver table up to date from a stream, one merge per micro-batch."""

    def merge(batch: DataFrame, batch_id: int) -> Any:
        rows = prepare(batch) if prepare else batch
        merge_batch(rows, batch_id, target, keys, f"{checkpoint}/merged", order, buckets)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Parquet tables: load, overwrite, register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite(
    df: DataFrame, path: str, columns: list[str] | None = None, partition_by: list[str] | None = None
) -> int:
    """Truncate-and-load with a fixed column order; returns the rows written.

    A partitioned table is rebalanced by its partition columns first. AQE then sizes the write tasks:
    small partitions share one, a large one is split, and no task opens a file in every partition.
    """
    if columns:
        df = df.select(*columns, *[c for c in (partition_by or []) if c not in columns])
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path).count()


def stamp(df: DataFrame, source: str) -> DataFrame:
    """Name the source where it is missing and take the load time from the server."""
    if "_source_file" not in df.columns:
        df = df.withColumn("_source_file", F.lit(source))
    return df.drop("_ingested_at").withColumn("_ingested_at", F.current_timestamp())


def register(spark: SparkSession, tables: dict[str, str]) -> None:
    """Lazy views over written tables, for SQL users."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)

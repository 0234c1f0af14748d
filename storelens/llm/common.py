"""Small helpers that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import application_dir, staging_area

SEPARATORS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def packed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` in one struct ``whole``, so that helper columns can't clash with them."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("whole"))


def batches_of(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``most_bytes`` of text each; a longer text is a slice by itself."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def finished(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written to the shared folder; all that it staged on the way is gone afterwards."""
    path = f"{application_dir(spark)}/results/{label}-{uuid.uuid4().hex}"
    with staging_area(spark):
        result = make()
        result.write.parquet(path)
    return spark.read.schema(result.schema).parquet(path)

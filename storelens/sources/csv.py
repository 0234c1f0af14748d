"""Raw CSV files into the bronze layer."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from storelens.schemas import RAW
from storelens.session import path_exists

log = logging.getLogger(__name__)

# A quoted field may hold commas and doubled quotes. A malformed record fails the job.
CSV_OPTIONS = {"header": "true", "mode": "FAILFAST", "quote": '"', "escape": '"', "enforceSchema": "false"}

# Tables whose text may hold line breaks. Their files are read whole, one task each; all others are split.
MULTI_LINE = frozenset({"order_reviews"})


def ingest(
    spark: SparkSession, path: str, schema: str, source: str | None, run_ts: datetime, multi_line: bool = False
) -> DataFrame:
    """Typed CSV scan with audit columns; timestamps stay text until silver.

    ``source`` names the file in ``_source_file``; without it each row gets the name of its own file.
    ``multi_line`` allows line breaks inside quotes, at the price of not splitting files: a table of that kind should
    come as a folder of files of some hundred megabytes each. Columns are matched by the names in the header, in any
    order; further columns are left out, a missing one is an error, and so is a file of the folder with another header.
    """
    wanted = StructType.fromDDL(schema)
    header = spark.read.options(**CSV_OPTIONS, multiLine=multi_line).csv(path).columns
    missing = [name for name in wanted.names if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    laid = StructType([wanted[name] if name in wanted.names else StructField(name, StringType()) for name in header])
    frame = spark.read.schema(laid).options(**CSV_OPTIONS, multiLine=multi_line).csv(path)
    name = F.lit(source) if source else F.col("_metadata.file_name")
    stamped = frame.withColumn("_source_file", name).withColumn("_ingested_at", F.lit(run_ts).cast("timestamp"))
    return stamped.select(*wanted.names, "_source_file", "_ingested_at")


def ingest_all(
    spark: SparkSession,
    src: str,
    dst: str,
    run_ts: datetime,
    files: dict[str, str] | None = None,
    partitioned: bool = False,
) -> dict[str, str]:
    """Write every source table that is present to bronze; a missing one is logged and skipped.

    ``files`` maps a table to its file name where that is not ``<table>.csv``. By default a run replaces
    the table. ``partitioned`` keeps earlier runs: each ingest date is a new partition and nothing
    already written is touched.
    """
    written = {}
    for name, schema in RAW.items():
        file = (files or {}).get(name, f"{name}.csv")
        path = f"{src}/{file}"
        if not path_exists(spark, path):
            log.warning("skip %s: no source at %s", name, path)
            continue
        frame = ingest(spark, path, schema, file, run_ts, name in MULTI_LINE)
        target = f"{dst}/{name}"
        if partitioned:
            frame = frame.withColumn("_ingest_date", F.to_date("_ingested_at"))
            frame.write.mode("append").partitionBy("_ingest_date").parquet(target)
        else:
            frame.write.mode("overwrite").parquet(target)
        written[name] = target
    return written

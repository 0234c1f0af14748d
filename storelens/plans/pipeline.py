"""From source files to the star schema."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators import date_bounds
from storelens.plans import gold
from storelens.plans.versions import Versions
from storelens.plans.warehouse import Lake, Warehouse
from storelens.schemas import RAW
from storelens.sources.csv import ingest_all

# The span of the calendar, both days included.
CALENDAR = (date(2016, 1, 1), date(2019, 12, 31))


def run(
    spark: SparkSession,
    src: str,
    dst: str,
    run_ts: datetime | None = None,
    files: dict[str, str] | None = None,
    calendar: tuple[date, date] = CALENDAR,
    regions: DataFrame | None = None,
    partitioned: bool = True,
    bronze_by_date: bool = False,
) -> Warehouse:
    """Build bronze, silver and gold from the CSV files in ``src`` as a new version of the lake ``dst``.

    The version becomes the live one when all of it is written; if the run fails, the live one stays as it was. Orders bought
    outside ``calendar`` would drop out of what joins it, so they are an error. With ``bronze_by_date`` bronze lies beside the
    versions, each run adds its ingest date to it, and silver is made from all runs so far.
    """
    versions = Versions(spark, dst)
    root = versions.begin()
    bronze = f"{dst}/bronze" if bronze_by_date else f"{root}/bronze"
    written = ingest_all(spark, src, bronze, run_ts or datetime.now(timezone.utc), files, bronze_by_date)
    missing = sorted(set(RAW) - set(written))
    if missing:
        raise FileNotFoundError(f"bronze lacks {', '.join(missing)}")
    warehouse = open_bronze(spark, written, root, calendar, regions, partitioned)
    warehouse.build_silver()
    outside = outside_calendar(warehouse.silver("orders"), calendar)
    if outside:
        raise ValueError(f"{outside} orders were bought outside the calendar, {calendar[0]} to {calendar[1]}")
    warehouse.build_gold()
    versions.publish(root)
    return warehouse


def outside_calendar(orders: DataFrame, calendar: tuple[date, date]) -> int:
    bought = F.to_date("order_purchase_ts")
    return orders.where((bought < F.lit(calendar[0])) | (bought > F.lit(calendar[1]))).count()


def open_lake(spark: SparkSession, dst: str) -> Lake:
    """The star that the last finished ``run`` left under ``dst``, in any session and without a write."""
    return Lake(spark, dst)


def open_bronze(
    spark: SparkSession,
    bronze: dict[str, str],
    dst: str,
    calendar: tuple[date, date] = CALENDAR,
    regions: DataFrame | None = None,
    partitioned: bool = True,
) -> Warehouse:
    """A warehouse over bronze tables that are already written."""
    return Warehouse(
        spark,
        dst,
        lambda name: spark.read.parquet(bronze[name]).drop("_ingest_date"),
        date_bounds(spark, *calendar),
        gold.region_map(spark) if regions is None else regions,
        partitioned,
    )

"""Report snapshots: each report written as a table of its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from storelens.plans import reports, timeline
from storelens.plans.metrics import Star
from storelens.plans.versions import Versions

# The questions and key-figure sets a dashboard refresh writes; ``year`` is the year on show.
SNAPSHOT: dict[str, Callable[[Star, int], DataFrame]] = {
    "month_revenue": lambda star, year: reports.month_revenue(star, year),
    "top_categories": lambda star, year: reports.top_categories(star),
    "region_revenue": lambda star, year: reports.region_revenue(star),
    "region_delivery": lambda star, year: reports.region_delivery(star),
    "slowest_sellers": lambda star, year: reports.slowest_sellers(star),
    "cancellations_by_state": lambda star, year: reports.cancellations_by_state(star),
    "repeat_by_region": lambda star, year: reports.repeat_by_region(star),
    "five_star_share": lambda star, year: reports.five_star_share(star),
    "payment_mix": lambda star, year: reports.payment_mix(star),
    "executive_kpis": lambda star, year: reports.executive_kpis(star, year),
    "operations_kpis": lambda star, year: reports.operations_kpis(star),
    "customer_kpis": lambda star, year: reports.customer_kpis(star),
    "pareto": lambda star, year: timeline.pareto(star),
}


def write(star: Star, dst: str, year: int, only: Mapping[str, Callable] | None = None) -> dict[str, str]:
    """Write the snapshot as a new version under ``dst``, a folder per report; it is live when all reports are written.

    With ``only``, the other reports of the live version are taken over by their paths.
    """
    versions = Versions(star.spark, dst)
    written = dict(paths(star.spark, dst)) if only else {}
    folder = versions.begin()
    for name, make in (only or SNAPSHOT).items():
        make(star, year).write.parquet(f"{folder}/{name}")
        written[name] = f"{folder}/{name}"
    listed = star.spark.createDataFrame(list(written.items()), "report string, path string")
    listed.coalesce(1).write.parquet(f"{folder}/_reports")
    versions.publish(folder)
    return written


def paths(spark: SparkSession, dst: str) -> dict[str, str]:
    """The reports of the live snapshot and where each lies."""
    live = Versions(spark, dst).live()
    if live is None:
        return {}
    return {r.report: r.path for r in spark.read.parquet(f"{live}/_reports").collect()}

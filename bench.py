"""Headline timings as one JSON line: layer builds and questions, median of warm runs.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the runs per figure.
"""

from __future__ import annotations

import json
import os
import statistics
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from storelens.plans.warehouse import Warehouse
from storelens.queries import QUERIES
from storelens.session import application_dir, session
from storelens.sources import testviews

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARM_UP = 3  # layer builds that only warm the JVM up

QUESTIONS = (
    "q_top_categories_year",
    "q_region_delivery",
    "q_payment_mix",
    "q_month_revenue",
    "q_five_star_share",
    "q_slowest_sellers",
    "q_repeat_by_region",
    "kpi_executive",
    "kpi_operations",
    "kpi_customer",
    "v_pareto",
    "v_new_vs_returning",
    "m_gmv_ytd",
    "m_gmv_ly",
    "m_gmv_rolling_30d",
    "m_average_order_value",
    "m_repeat_customer_pct",
    "rollup_geo",
    "metric_layer_two_facts",
    "dq_payments_vs_gmv",
)


def timed(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def write_bronze(spark: SparkSession, root: str) -> None:
    def write(name: str) -> None:
        testviews.BRONZE[name](spark, SF_DIR).write.parquet(f"{root}/bronze/{name}")

    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(write, testviews.BRONZE))


def main() -> None:
    spark = session(
        "bench",
        f"local[{CPUS}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # The tables are a few megabytes: smaller splits and row groups give every core a part of them.
        spark__hadoop__parquet__block__size=str(1 << 20),
        spark__sql__files__maxPartitionBytes="2m",
        spark__sql__files__openCostInBytes=str(256 << 10),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, list[float]] = {}

    for run in range(RUNS + WARM_UP):
        root = f"{application_dir(spark)}/bench-{uuid.uuid4().hex[:8]}"
        built = Warehouse(
            spark,
            root,
            lambda name, root=root: spark.read.parquet(f"{root}/bronze/{name}"),
            testviews.calendar_bounds(spark, SF_DIR),
            testviews.region_map(spark, SF_DIR),
            partitioned=False,
        )
        took = {
            "bronze_build": timed(lambda: write_bronze(spark, root)),
            "silver_build": timed(built.build_silver),
            "gold_build": timed(built.build_gold),
        }
        if run >= WARM_UP:
            for name, value in took.items():
                seconds.setdefault(name, []).append(value)

    for name in QUESTIONS:
        for run in range(RUNS + 1):
            # The no-op sink runs the whole plan without bringing the rows to Python.
            took = timed(lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
            if run:
                seconds.setdefault(name, []).append(took)

    medians = {name: round(statistics.median(times), 3) for name, times in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "layer builds and questions, median of warm runs",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

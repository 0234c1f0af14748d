"""Dimensions whose files are below the broadcast size while their rows would fill the driver."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from storelens.operators import calendar, date_bounds, lookup
from storelens.plans import gold, reports
from storelens.plans.metrics import report
from storelens.session import path_bytes
from tests.conftest import plan_of, values

PEOPLE = 3_000_000


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    """A written customer dimension: every tenth is a repeat customer."""
    path = f"{tmp_path_factory.mktemp('lookup')}/DimCustomer"
    key = F.col("id") + 1
    rows = spark.range(0, PEOPLE, 1, 4).select(
        key.alias("customer_key"), (key + 10**12).alias("customer_unique_id"), (key % 10 == 0).alias("is_repeat_customer")
    )
    rows.write.option("compression", "zstd").parquet(path)
    assert path_bytes(spark, path) < 20_000_000
    return spark.read.schema(rows.schema).parquet(path)


class Star:
    def __init__(self, people):
        spark = people.sparkSession
        lines = [(f"o{k}", k, 20170101 + 100 * m, 2017, 1 + m) for k, m in ((1, 0), (1, 0), (2, 1), (3, 1), (10, 1), (20, 0), (None, 1))]
        placed = "order_id string, customer_key bigint, purchase_date_key int, purchase_year int, purchase_month int"
        self.tables = {
            "FactOrderItems": spark.createDataFrame(lines, placed),
            "FactReviews": spark.createDataFrame([(*lines[0], 5), (*lines[2], 4)], f"{placed}, review_score int"),
            "DimCustomer": people,
            "DimDate": calendar(date_bounds(spark, date(2017, 1, 1), date(2017, 12, 31))),
        }

    def gold(self, name):
        return self.tables[name]


def found(df) -> list[tuple]:
    """The rows, once the plan has been seen to merge the customers."""
    plan = plan_of(df)
    assert "BroadcastHashJoin [customer_key" not in plan and "SortMergeJoin [customer_key" in plan
    return values(df)


def test_customer_kpis_are_found_without_a_broadcast_of_all_customers(people):
    assert found(reports.customer_kpis(Star(people))) == [(5, 0.4, 4.5, 5)]


def test_repeat_customers_of_a_month_are_found_without_a_broadcast_of_all_customers(people):
    by_month = report(Star(people), ["repeat_customer_pct"], ["year_month"])
    assert found(by_month) == [("2017-01", 0.5), ("2017-02", 1 / 3)]


def test_repeat_customers_by_their_flag_are_found_without_a_broadcast_of_all_customers(people):
    by_flag = report(Star(people), ["repeat_customer_pct"], ["is_repeat_customer"])
    # Two of them in every group, over the active customers of the group; the line without a customer has none.
    assert found(by_flag) == [(False, 2 / 3), (None, None), (True, 1.0)]


def test_the_bridge_is_built_without_a_broadcast_of_all(spark, people):
    ids = people.select((F.col("customer_key") * 7).alias("customer_id"), "customer_unique_id").where("customer_key <= 50")
    bridge = gold.bridge_customer(ids, people)
    assert "BroadcastHashJoin" not in plan_of(bridge)
    assert values(bridge) == sorted([(k * 7, k) for k in range(1, 51)], key=repr)


def test_a_lookup_that_fits_is_left_to_spark(spark, people):
    keyed = spark.range(100).select(F.col("id").alias("customer_key"))
    some = people.where("customer_key <= 1000000").select("customer_key", "is_repeat_customer")
    assert "BroadcastHashJoin" in plan_of(keyed.join(lookup(some), "customer_key"))
    assert "BroadcastHashJoin" in plan_of(keyed.join(lookup(spark.range(10).withColumnRenamed("id", "customer_key")), "customer_key"))


def test_a_lookup_keeps_to_the_broadcast_size(spark, people):
    """Broadcasts are off: nothing is counted and no join is settled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert lookup(people) is people
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

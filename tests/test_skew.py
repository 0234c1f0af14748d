"""A key that holds a third of the rows, in joins too large to broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from storelens.operators import dense_key
from storelens.plans import reports, silver
from storelens.plans.gold import fact_order_items

LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}
ROWS = 30_000


@pytest.fixture
def large(spark):
    """Thresholds scaled down with the data."""
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(column: str, value: int):
    return F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(F.col("id")).alias(column)


def skew_joins(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall("skew=true", plan.split("Initial Plan")[0]))


def test_lines_of_a_hot_order_are_split(large):
    ids = large.range(0, ROWS, 1, 8)
    items = ids.select(
        hot("order_id", 42),
        F.col("id").cast("int").alias("order_item_id"),
        F.col("id").alias("product_id"),
        F.col("id").alias("seller_id"),
        F.lit(1).cast("decimal(12,2)").alias("price"),
        F.lit(1).cast("decimal(12,2)").alias("freight_value"),
    )
    header = ids.select(
        F.col("id").alias("order_id"),
        F.lit(1).alias("customer_key"),
        F.lit("delivered").alias("order_status"),
        *[F.lit(20170101).alias(f"{c}_date_key") for c in ("purchase", "delivered", "estimated")],
        *[F.lit(1).alias(c) for c in ("delivery_days", "delivery_vs_estimate_days", "on_time_flag")],
        F.lit(2017).alias("purchase_year"),
        F.lit(1).alias("purchase_month"),
    )
    products = ids.select(F.col("id").alias("product_id"), F.col("id").alias("product_key"))
    sellers = ids.select(F.col("id").alias("seller_id"), F.col("id").alias("seller_key"))
    fact = fact_order_items(items, header, products, sellers)
    assert skew_joins(fact) >= 1
    assert fact.count() == ROWS


def test_reviews_of_a_hot_order_meet_its_items_in_parts(large):
    ids = large.range(0, ROWS, 1, 8)
    tables = {
        "FactOrderItems": ids.select(hot("order_id", 42), (F.col("id") % 1000).alias("product_key")),
        # The hot order has many reviews as well: pairs would be 10,000 x 5,000.
        "FactReviews": large.range(0, 10_000, 1, 8).select(
            F.when(F.col("id") < 5000, F.lit(42)).otherwise(F.col("id")).alias("order_id"),
            (1 + F.col("id") % 5).cast("int").alias("review_score"),
        ),
        "DimProduct": ids.where("id < 1000").select(
            F.col("id").alias("product_key"), F.concat(F.lit("c"), F.col("id") % 3).alias("category_en")
        ),
    }

    class Star:
        def gold(self, name):
            return tables[name]

    shares = reports.five_star_share(Star())
    assert skew_joins(shares) >= 1
    rows = shares.collect()
    # Each item of order 42 counts its 5,000 reviews.
    singles = ids.where("id % 3 <> 0 and id >= 5000 and id < 10000").count()
    assert sum(r["review_rows"] for r in rows) == ROWS // 3 * 5000 + singles


def test_products_of_a_hot_category_are_split(large):
    columns = [F.lit(1).alias(c) for c in ("product_name_lenght", "product_description_lenght", "product_photos_qty")]
    sizes = [F.lit(1).alias(f"product_{c}") for c in ("weight_g", "length_cm", "height_cm", "width_cm")]
    bronze = large.range(0, ROWS, 1, 8).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("product_category_name"),
        *columns,
        *sizes,
        F.lit(0).alias("_ingested_at"),
    )
    translation = bronze.select(
        "product_category_name", F.lit("x").alias("product_category_name_english"), "_ingested_at"
    )
    products = silver.products(bronze, translation)
    assert skew_joins(products) >= 1
    assert products.where("category_en = 'x'").count() == ROWS


def test_rows_of_a_hot_key_find_their_rank_in_parts(large):
    df = large.range(0, ROWS, 1, 8).select(hot("k", 7), F.col("id").alias("v"))
    ranked = dense_key(df, "k", "key")
    assert skew_joins(ranked) >= 1
    assert ranked.count() == ROWS


def test_a_small_translation_is_broadcast(spark):
    bronze = spark.range(100).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("a"), F.col("id") % 2).alias("product_category_name"),
        *[
            F.lit(1).alias(f"product_{c}")
            for c in (
                "name_lenght",
                "description_lenght",
                "photos_qty",
                "weight_g",
                "length_cm",
                "height_cm",
                "width_cm",
            )
        ],
        F.lit(0).alias("_ingested_at"),
    )
    names = spark.createDataFrame(
        [("a0", "b", 0)], "product_category_name string, product_category_name_english string, _ingested_at int"
    )
    plan = silver.products(bronze, names)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

"""The bronze shapes, derived from star-schema order data.

``orders lineitem customer nation supplier part events`` stand in for the retail source: every row of
each table is mapped, with stray case, stray spaces and unreadable dates put in so that the silver rules
have something to do. Identifiers stay integers and most dates stay timestamps, which the layers take as
well as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_raw: dict[tuple[str, str], DataFrame] = {}


def raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A given table; its files are listed and its schema read once per application."""
    path = f"{root}/{table}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _raw:
        _raw[key] = spark.read.parquet(path)
    return _raw[key]


def _after(start: Column, days: Column | int, minutes: Column | int = 0) -> Column:
    days, minutes = (c if isinstance(c, Column) else F.lit(c) for c in (days, minutes))
    return start + F.make_dt_interval(days=days.cast("int"), mins=minutes.cast("int"))


def orders(spark: SparkSession, root: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    purchase = _after(F.col("o_orderdate"), 0, key * 37 % 1440)
    approved = (
        F.when(key % 53 == 0, F.lit(""))
        .when(key % 59 == 0, F.lit("2017-13-40"))
        .otherwise(_after(purchase, 0, 60).cast("string"))
    )
    return raw(spark, root, "orders").select(
        key.alias("order_id"),
        key.alias("customer_id"),
        F.when(status == "F", " Delivered ")
        .when(status == "O", "SHIPPED")
        .when(status == "P", "canceled ")
        .alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        F.when(status != "P", _after(purchase, 2)).alias("order_delivered_carrier_date"),
        F.when(status == "F", _after(purchase, 3 + key % 40, key % 1000)).alias(
            "order_delivered_customer_date"
        ),
        _after(F.col("o_orderdate"), 20 + key * 7 % 15).alias("order_estimated_delivery_date"),
        F.col("o_orderdate").alias("_ingested_at"),
    )


def order_items(spark: SparkSession, root: str) -> DataFrame:
    return order_items_of(raw(spark, root, "lineitem"))


def order_items_of(lines: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    freight = F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _after(F.col("l_shipdate"), 7).alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
        F.col("l_shipdate").alias("_ingested_at"),
    )


def order_payments(spark: SparkSession, root: str) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_type")
    return raw(spark, root, "events").select(
        F.expr("event_id div 2").alias("order_id"),
        (event % 2 + 1).cast("int").alias("payment_sequential"),
        F.when(kind == "purchase", "credit_card")
        .when(kind == "click", "BOLETO ")
        .when(kind == "view", " Voucher")
        .when(kind == "signup", "debit_card")
        .otherwise("not_defined")
        .alias("payment_type"),
        (1 + event % 12).cast("int").alias("payment_installments"),
        F.col("value").cast("decimal(12,2)").alias("payment_value"),
        F.col("ts").alias("_ingested_at"),
    )


def order_reviews(spark: SparkSession, root: str) -> DataFrame:
    event = F.col("event_id")
    return raw(spark, root, "events").select(
        (event - F.when(event % 3 == 1, 1).otherwise(0)).alias("review_id"),
        event.alias("order_id"),
        (1 + F.floor("value") % 5).cast("int").alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        _after(F.col("ts"), event % 9).alias("review_answer_timestamp"),
        F.col("ts").alias("_ingested_at"),
    )


def products(spark: SparkSession, root: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return raw(spark, root, "part").select(
        key.alias("product_id"),
        F.when(key % 50 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (size % 5).alias("product_photos_qty"),
        F.when(key % 97 != 0, size * 300).alias("product_weight_g"),
        (size + 10).alias("product_length_cm"),
        (size + 5).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
        _epoch().alias("_ingested_at"),
    )


def category_translation(spark: SparkSession, root: str) -> DataFrame:
    """A translation per product row, so each name is there many times; one name has a blank one."""
    kind = F.col("p_type")
    return raw(spark, root, "part").select(
        kind.alias("product_category_name"),
        F.when(kind != "PROMO", F.concat(F.lit("cat_"), F.lower(kind))).alias("product_category_name_english"),
        _epoch().alias("_ingested_at"),
    )


def sellers(spark: SparkSession, root: str) -> DataFrame:
    nation = raw(spark, root, "nation")
    joined = raw(spark, root, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.concat(F.lit(" "), F.lower("s_name")).alias("seller_city"),
        F.concat(F.lower("n_name"), F.lit(" ")).alias("seller_state"),
        _epoch().alias("_ingested_at"),
    )


def customers(spark: SparkSession, root: str) -> DataFrame:
    """One row per order; every tenth order belongs to a returning person."""
    key = F.col("o_orderkey")
    nation = raw(spark, root, "nation")
    people = raw(spark, root, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    joined = raw(spark, root, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        key.alias("customer_id"),
        F.when(key % 10 == 0, F.col("o_custkey"))
        .otherwise(F.lit(1_000_000_000_000).cast("bigint") + key)
        .alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("customer_city"),
        F.concat(F.lower("n_name"), F.lit(" ")).alias("customer_state"),
        F.col("o_orderdate").alias("_ingested_at"),
    )


def geolocation(spark: SparkSession, root: str) -> DataFrame:
    nation = raw(spark, root, "nation")
    joined = raw(spark, root, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("c_acctbal").alias("geolocation_lat"),
        (F.col("c_custkey").cast("double") / 1000).alias("geolocation_lng"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("geolocation_city"),
        F.concat(F.lower("n_name"), F.lit(" ")).alias("geolocation_state"),
        _epoch().alias("_ingested_at"),
    )


def region_map(spark: SparkSession, root: str) -> DataFrame:
    region = raw(spark, root, "region")
    joined = raw(spark, root, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("n_name").alias("state"), F.col("r_name").alias("region"))


def calendar_bounds(spark: SparkSession, root: str) -> DataFrame:
    """From the first day of the first order year to the last day of the last event year."""
    first = raw(spark, root, "orders").agg(F.min("o_orderdate").alias("seen"))
    last = raw(spark, root, "events").agg(F.max("ts").alias("seen"))
    return (
        first.unionByName(last)
        .agg(F.year(F.min("seen")).alias("a"), F.year(F.max("seen")).alias("b"))
        .select(
            F.make_date("a", F.lit(1), F.lit(1)).alias("first"),
            F.make_date("b", F.lit(12), F.lit(31)).alias("last"),
        )
    )


def _epoch() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


BRONZE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "customers": customers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}

# The driver table behind each bronze table.
SOURCES = {
    "orders": "orders",
    "order_items": "lineitem",
    "order_payments": "events",
    "order_reviews": "events",
    "products": "part",
    "sellers": "supplier",
    "customers": "orders",
    "geolocation": "customer",
    "category_translation": "part",
}

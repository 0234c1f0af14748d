"""Gold: the star schema.

Joins carry no broadcast hint unless the small side has a bound of its own (the calendar, the region
map). For the dimensions Spark decides from the size of the written tables, held to what a broadcast may take
(``lookup``), and AQE from the size of the shuffle; past the threshold they are sort-merge joins whose hot
partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions import bucketize, date_key, days_between
from storelens.operators import calendar, dense_key, lookup
from storelens.schemas import REGIONS, UNKNOWN_REGION, UNKNOWN_WEIGHT, WEIGHT_BUCKETS

# The facts lie in folders by purchase year and month.
FACT_PARTITIONS = ["purchase_year", "purchase_month"]
# A dense number per order, written beside the gold tables; not part of the star.
ORDER_NUMBERS = "_order_number"


def dim_date(bounds: DataFrame) -> DataFrame:
    return calendar(bounds)


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per person, addressed as under their highest ``customer_id``.

    ``customer_id`` is the key of silver customers, so counting rows counts distinct ids and the whole
    table needs a single shuffle with a partial aggregate before it.
    """
    address = F.struct("customer_zip_prefix", "customer_city", "customer_state")
    people = (
        customers.groupBy("customer_unique_id")
        .agg(
            F.max_by(address, "customer_id").alias("address"),
            F.count("customer_id").cast("int").alias("n_orders_per_unique"),
        )
        .select(
            "customer_unique_id",
            "address.*",
            "n_orders_per_unique",
            (F.col("n_orders_per_unique") > 1).alias("is_repeat_customer"),
        )
    )
    return dense_key(people, "customer_unique_id", "customer_key", unique=True)


def bridge_customer(customers: DataFrame, dim: DataFrame) -> DataFrame:
    """From the per-order id to the person."""
    people = lookup(dim.select("customer_unique_id", "customer_key"))
    ids = lookup(customers.select("customer_id", "customer_unique_id"))
    return ids.join(people, "customer_unique_id").select("customer_id", "customer_key")


def dim_product(products: DataFrame) -> DataFrame:
    columns = [
        "product_id",
        "category_pt",
        "category_en",
        "photos_qty",
        "weight_g",
        "length_cm",
        "height_cm",
        "width_cm",
        bucketize("weight_g", WEIGHT_BUCKETS, UNKNOWN_WEIGHT).alias("weight_bucket"),
    ]
    return dense_key(products.select(*columns), "product_id", "product_key", unique=True)


def dim_seller(sellers: DataFrame) -> DataFrame:
    columns = ["seller_id", "seller_zip_prefix", "seller_city", "seller_state"]
    return dense_key(sellers.select(*columns), "seller_id", "seller_key", unique=True)


def region_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REGIONS.items()), "state string, region string")


def dim_geography(customers: DataFrame, sellers: DataFrame, regions: DataFrame) -> DataFrame:
    """States of customers and sellers with the region of each; ``regions`` has a row per known state."""
    states = (
        customers.select(F.col("customer_state").alias("state"))
        .union(sellers.select(F.col("seller_state").alias("state")))
        .where(F.col("state").isNotNull())
        .distinct()
    )
    located = states.join(regions, "state", "left").select(
        "state", F.coalesce("region", F.lit(UNKNOWN_REGION)).alias("region")
    )
    return dense_key(located, "state", "geography_key", unique=True)


def order_header(orders: DataFrame, bridge: DataFrame) -> DataFrame:
    """What the facts take from an order, worked out once per order rather than once per line.

    The person is looked up here too: the order table is shuffled by ``customer_id``, not the lines.
    """
    purchase, delivered, estimated = (
        F.col(f"order_{c}_ts") for c in ("purchase", "delivered_customer", "estimated_delivery")
    )
    return orders.join(lookup(bridge), "customer_id", "left").select(
        "order_id",
        "customer_key",
        "order_status",
        date_key(purchase).alias("purchase_date_key"),
        date_key(delivered).alias("delivered_date_key"),
        date_key(estimated).alias("estimated_date_key"),
        days_between(purchase, delivered).alias("delivery_days"),
        days_between(estimated, delivered).alias("delivery_vs_estimate_days"),
        F.when(delivered <= estimated, 1).otherwise(0).alias("on_time_flag"),
        F.year(purchase).alias("purchase_year"),
        F.month(purchase).alias("purchase_month"),
    )


def order_numbers(header: DataFrame) -> DataFrame:
    """A dense number for each order, for bitmaps of orders."""
    return dense_key(header.select("order_id"), "order_id", "order_number", unique=True)


def within(header: DataFrame, bounds: DataFrame) -> DataFrame:
    """The header as it is; an order bought outside the calendar fails the job that reads it."""
    first, last = (bounds.select(date_key(c)).scalar() for c in ("first", "last"))
    key = F.col("purchase_date_key")
    outside = F.concat(F.lit("an order was bought outside the calendar, on "), key.cast("string"))
    checked = F.when((key < first) | (key > last), F.raise_error(outside)).otherwise(key)
    return header.withColumn("purchase_date_key", checked.cast("int"))


def fact_order_items(
    items: DataFrame, header: DataFrame, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    """One row per item line; a line without an order goes, one without product or seller stays.

    The keys are looked up before the order's columns are joined, while the lines are still narrow.
    """
    return (
        items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
        .join(lookup(products.select("product_id", "product_key")), "product_id", "left")
        .join(lookup(sellers.select("seller_id", "seller_key")), "seller_id", "left")
        .join(lookup(header), "order_id")
        .select(
            "order_id",
            "order_item_id",
            "purchase_date_key",
            "delivered_date_key",
            "estimated_date_key",
            "customer_key",
            "product_key",
            "seller_key",
            "order_status",
            "price",
            "freight_value",
            (F.col("price") + F.col("freight_value")).cast("decimal(12,2)").alias("total_value"),
            "delivery_days",
            "delivery_vs_estimate_days",
            "on_time_flag",
            *FACT_PARTITIONS,
        )
    )


def fact_payments(payments: DataFrame, header: DataFrame) -> DataFrame:
    placed = header.select("order_id", "purchase_date_key", "customer_key", *FACT_PARTITIONS)
    return payments.join(lookup(placed), "order_id").select(
        "order_id",
        "payment_sequential",
        "purchase_date_key",
        "customer_key",
        "payment_type",
        "payment_installments",
        "payment_value",
        *FACT_PARTITIONS,
    )


def fact_reviews(reviews: DataFrame, header: DataFrame) -> DataFrame:
    placed = header.select("order_id", "purchase_date_key", "customer_key", *FACT_PARTITIONS)
    return reviews.join(lookup(placed), "order_id").select(
        "review_id",
        "order_id",
        "purchase_date_key",
        date_key("review_creation_ts").alias("review_date_key"),
        "customer_key",
        "review_score",
        days_between("review_creation_ts", "review_answer_ts").alias("response_days"),
        *FACT_PARTITIONS,
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    report = counts[0]
    for other in counts[1:]:
        report = report.unionByName(other)
    return report

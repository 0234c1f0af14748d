"""Silver: typed, cleaned, one row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions import clean_lower, clean_upper, money, safe_timestamp
from storelens.operators import latest
from storelens.session import staged


def orders(bronze: DataFrame) -> DataFrame:
    return latest(bronze, ["order_id"]).select(
        "order_id",
        "customer_id",
        clean_lower("order_status").alias("order_status"),
        safe_timestamp("order_purchase_timestamp").alias("order_purchase_ts"),
        safe_timestamp("order_approved_at").alias("order_approved_ts"),
        safe_timestamp("order_delivered_carrier_date").alias("order_delivered_carrier_ts"),
        safe_timestamp("order_delivered_customer_date").alias("order_delivered_customer_ts"),
        safe_timestamp("order_estimated_delivery_date").alias("order_estimated_delivery_ts"),
    )


def order_items(bronze: DataFrame) -> DataFrame:
    return typed_items(latest(bronze, ["order_id", "order_item_id"]))


def typed_items(rows: DataFrame) -> DataFrame:
    """The silver columns of items that are one row per key already, as a table of latest rows holds them."""
    return rows.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id",
        "seller_id",
        safe_timestamp("shipping_limit_date").alias("shipping_limit_ts"),
        money("price").alias("price"),
        money("freight_value").alias("freight_value"),
    )


def order_payments(bronze: DataFrame) -> DataFrame:
    """Payment rows are kept as they come; repeated keys are a data-quality finding, not removed."""
    return bronze.select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        clean_lower("payment_type").alias("payment_type"),
        F.col("payment_installments").cast("int").alias("payment_installments"),
        money("payment_value").alias("payment_value"),
    )


def order_reviews(bronze: DataFrame) -> DataFrame:
    """One row per review; a review filed under two orders keeps its last one."""
    return latest(bronze, ["review_id"]).select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        safe_timestamp("review_creation_date").alias("review_creation_ts"),
        safe_timestamp("review_answer_timestamp").alias("review_answer_ts"),
    )


def products(bronze: DataFrame, translation: DataFrame) -> DataFrame:
    """Category in English, else as it came, else ``unknown``.

    The translation is reduced to a row per name first, so a repeated name cannot multiply products. It
    is staged: Spark then sees its true size and, as long as that is small, broadcasts it and leaves the
    products where they are. Past that size both sides of the join are plain shuffles, in which AQE
    splits a category (or the missing one) that holds a large part of the products.
    """
    names = staged(
        latest(translation, ["product_category_name"]).select(
            F.col("product_category_name").alias("category_pt"), "product_category_name_english"
        ),
        "translation",
    )
    typed = latest(bronze, ["product_id"]).select(
        "product_id",
        F.col("product_category_name").alias("category_pt"),
        F.col("product_name_lenght").cast("int").alias("name_length"),
        F.col("product_description_lenght").cast("int").alias("description_length"),
        F.col("product_photos_qty").cast("int").alias("photos_qty"),
        F.col("product_weight_g").cast("int").alias("weight_g"),
        F.col("product_length_cm").cast("int").alias("length_cm"),
        F.col("product_height_cm").cast("int").alias("height_cm"),
        F.col("product_width_cm").cast("int").alias("width_cm"),
    )
    english = F.coalesce("product_category_name_english", "category_pt", F.lit("unknown"))
    return typed.join(names, "category_pt", "left").select(
        "product_id",
        "category_pt",
        english.alias("category_en"),
        *[c for c in typed.columns if c not in ("product_id", "category_pt")],
    )


def sellers(bronze: DataFrame) -> DataFrame:
    return latest(bronze, ["seller_id"]).select(
        "seller_id",
        F.col("seller_zip_code_prefix").cast("int").alias("seller_zip_prefix"),
        clean_upper("seller_city").alias("seller_city"),
        clean_upper("seller_state").alias("seller_state"),
    )


def customers(bronze: DataFrame) -> DataFrame:
    return latest(bronze, ["customer_id"]).select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").cast("int").alias("customer_zip_prefix"),
        clean_upper("customer_city").alias("customer_city"),
        clean_upper("customer_state").alias("customer_state"),
    )


def geolocation(bronze: DataFrame) -> DataFrame:
    """Centre of each zip prefix, with the alphabetically last city and state as its label.

    Coordinates are summed as decimals: a sum of doubles depends on the order in which tasks finish, and
    the same input must give the same table.
    """
    lat, lng = (F.col(f"geolocation_{c}").cast("decimal(24,14)") for c in ("lat", "lng"))
    return (
        bronze.groupBy(F.col("geolocation_zip_code_prefix").cast("int").alias("zip_prefix"))
        .agg(
            (F.sum(lat).cast("double") / F.count(lat)).alias("lat"),
            (F.sum(lng).cast("double") / F.count(lng)).alias("lng"),
            F.max(clean_upper("geolocation_city")).alias("city"),
            F.max(clean_upper("geolocation_state")).alias("state"),
        )
    )


# Each table's transform and the bronze tables it reads.
SILVER: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "orders": (orders, ("orders",)),
    "order_items": (order_items, ("order_items",)),
    "order_payments": (order_payments, ("order_payments",)),
    "order_reviews": (order_reviews, ("order_reviews",)),
    "products": (products, ("products", "category_translation")),
    "sellers": (sellers, ("sellers",)),
    "customers": (customers, ("customers",)),
    "geolocation": (geolocation, ("geolocation",)),
}


def build(name: str, bronze: Mapping[str, DataFrame] | Callable[[str], DataFrame]) -> DataFrame:
    transform, inputs = SILVER[name]
    read = bronze if callable(bronze) else bronze.__getitem__
    return transform(*[read(i) for i in inputs])

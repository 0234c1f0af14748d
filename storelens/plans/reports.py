"""Dashboard relations and business questions.

Every function takes the star and returns a frame; sorting for display is left to the caller except where
the order decides which rows are kept.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions import bucketize, ratio, total_money
from storelens.operators import month_index, share_of_total, top_n
from storelens.plans import timeline
from storelens.plans.measures import ITEMS, REVIEWS
from storelens.plans.metrics import Star, condition, dimension_rows, filtered, merge, report
from storelens.schemas import DELIVERY_BINS
from storelens.session import staged

Where = Mapping[str, Any] | None

# Executive


def executive_kpis(star: Star, year: int) -> DataFrame:
    """Headline figures of a year beside the year before."""
    names = ["gmv", "order_count", "average_order_value", "active_customers", "five_star_pct"]
    now = report(star, names, where={"year": year})
    before = report(star, ["gmv"], where={"year": year - 1}).withColumnRenamed("gmv", "gmv_ly")
    both = merge([now, before], [], [*names, "gmv_ly"])
    return both.withColumn("gmv_yoy_pct", ratio(F.col("gmv") - F.col("gmv_ly"), F.col("gmv_ly")))


def sliced_kpis(star: Star, where: Where) -> DataFrame:
    """Headline figures under the slicers of a page."""
    return report(star, ["gmv", "order_count", "average_order_value", "active_customers"], where=where)


def top_categories(star: Star, n: int = 10, where: Where = None) -> DataFrame:
    return top_n(report(star, ["gmv"], ["category_en"], where), F.col("gmv").desc_nulls_last(), n, ["category_en"])


def gmv_by_state(star: Star, where: Where = None) -> DataFrame:
    return report(star, ["gmv"], ["customer_state"], where)


def region_revenue(star: Star, where: Where = None) -> DataFrame:
    return report(star, ["gmv"], ["region"], where)


def month_revenue(star: Star, year: int) -> DataFrame:
    return report(star, ["gmv"], ["year_month"], {"year": year})


# Operations


def operations_kpis(star: Star, where: Where = None) -> DataFrame:
    names = ["on_time_delivery_pct", "avg_delivery_days", "cancellation_rate", "delivered_orders"]
    return report(star, names, where=where)


def delivery_histogram(star: Star, where: Where = None) -> DataFrame:
    """Delivered item rows per class of delivery days; a bin takes its lower edge, not its upper."""
    return (
        filtered(star, ITEMS, where)
        .where(F.col("delivery_days").isNotNull())
        .groupBy(bucketize("delivery_days", DELIVERY_BINS).alias("delivery_bin"))
        .agg(F.count("*").alias("item_rows"))
    )


def on_time_by(star: Star, column: str, where: Where = None) -> DataFrame:
    return report(star, ["on_time_delivery_pct"], [column], where)


def delivery_trend(star: Star, months: int = 12, where: Where = None, day: Column | None = None) -> DataFrame:
    """Average delivery days of the last months up to ``day``, by default the last purchase on record."""
    day = timeline.as_of(star) if day is None else day
    last = month_index(F.year(day), F.month(day))
    month = month_index("purchase_year", "purchase_month")
    rows = (
        filtered(star, ITEMS, where)
        .where((month > last - months) & (month <= last))
        .groupBy(month.alias("month_index"))
        .agg(ratio(F.sum("delivery_days"), F.count("delivery_days")).alias("avg_delivery_days"))
    )
    labels = F.broadcast(timeline.months(star).select("month_index", "year_month"))
    return rows.join(labels, "month_index").select("year_month", "avg_delivery_days")


def slowest_sellers(star: Star, n: int = 10, at_least: int = 10, where: Where = None) -> DataFrame:
    """Sellers with the longest average delivery, given enough delivered rows.

    The cut is made on seller keys, which rank like seller ids, so only the rows kept meet the dimension.
    """
    delivered = filtered(star, ITEMS, where).where(F.col("delivery_days").isNotNull() & F.col("seller_key").isNotNull())
    speed = (
        delivered.groupBy("seller_key")
        .agg(
            F.count("*").alias("item_rows"),
            F.count_distinct("order_id").alias("order_count"),
            ratio(F.sum("delivery_days"), F.count("*")).alias("avg_delivery_days"),
            ratio(F.sum("on_time_flag"), F.count("*")).alias("on_time_delivery_pct"),
        )
        .where(F.col("item_rows") >= at_least)
    )
    slowest = top_n(speed, F.col("avg_delivery_days").desc(), n, ["seller_key"])
    sellers = star.gold("DimSeller").select("seller_key", "seller_id", "seller_state")
    return sellers.join(F.broadcast(slowest), "seller_key").drop("seller_key")


def region_delivery(star: Star, where: Where = None) -> DataFrame:
    """Delivery time and punctuality by region, the least punctual first."""
    rows = report(star, ["avg_delivery_days", "on_time_delivery_pct", "delivered_items"], ["region"], where)
    return (
        rows.where((F.col("delivered_items") > 0) & F.col("region").isNotNull())
        .drop("delivered_items")
        .orderBy(
            F.col("on_time_delivery_pct").asc_nulls_last(),
            F.col("avg_delivery_days").desc_nulls_last(),
            F.col("region").asc_nulls_last(),
        )
    )


def worst_state(star: Star, where: Where = None) -> DataFrame:
    rows = report(star, ["on_time_delivery_pct", "delivered_items"], ["customer_state"], where)
    known = rows.where((F.col("delivered_items") > 0) & F.col("customer_state").isNotNull())
    return top_n(known.drop("delivered_items"), F.col("on_time_delivery_pct").asc(), 1, ["customer_state"])


def cancellations_by_state(star: Star, n: int = 10, where: Where = None) -> DataFrame:
    rows = report(star, ["items_sold"], ["customer_state"], {**(where or {}), "order_status": "canceled"})
    rows = rows.where(F.col("customer_state").isNotNull()).withColumnRenamed("items_sold", "canceled_item_rows")
    return top_n(rows, F.col("canceled_item_rows").desc(), n, ["customer_state"])


def late_rate(star: Star, state: str) -> DataFrame:
    """Share of the delivered item rows of a state that came after the estimate."""
    return report(star, ["late_items", "late_delivery_pct"], where={"customer_state": state})


# Customers


def customer_kpis(star: Star, where: Where = None) -> DataFrame:
    return report(star, ["active_customers", "repeat_customer_pct", "avg_review_score", "new_customers"], where=where)


def single_order_customers(star: Star) -> DataFrame:
    people = star.gold("DimCustomer")
    return people.agg(F.count_if(F.col("n_orders_per_unique") == 1).alias("single_order_customers"))


def repeat_share(star: Star) -> DataFrame:
    """Repeat buyers among all customers on file, bought or not."""
    return star.gold("DimCustomer").agg(
        ratio(F.count_if("is_repeat_customer"), F.count("*")).alias("repeat_customer_pct")
    )


def repeat_by_region(star: Star) -> DataFrame:
    by_state = (
        star.gold("DimCustomer")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(F.count("*").alias("n"), F.count_if("is_repeat_customer").alias("repeat"))
    )
    regions = star.gold("DimGeography").select("state", "region")
    return (
        by_state.join(regions, "state")
        .groupBy("region")
        .agg(F.sum("n").alias("customers"), ratio(F.sum("repeat"), F.sum("n")).alias("repeat_customer_pct"))
    )


def customers_by_state(star: Star, where: Where = None) -> DataFrame:
    """Customers on file; ``where`` holds columns of customers and their region, since no other filter reaches them."""
    people = dimension_rows(star, "customer_key", dict(where or {}))
    return people.groupBy("customer_state").agg(F.count("*").alias("customers"))


def review_distribution(star: Star, where: Where = None) -> DataFrame:
    scores = filtered(star, REVIEWS, where).groupBy("review_score").agg(F.count("*").alias("reviews"))
    return share_of_total(scores, "reviews", "share")


def _reviews_by_category(star: Star, where: Where = None) -> DataFrame:
    """Reviews reach a category through the items of their order and count once per item.

    Reviews are added up per order before the join, so an order with many reviews and many items gives
    one row per item, not one per pair. The sums are staged: joined straight from the grouping, the side
    of the items would have to keep the grouping's partitions, and AQE could not split a hot order.
    """
    per_order = staged(
        star.gold(REVIEWS)
        .groupBy("order_id")
        .agg(
            F.count("*").alias("reviews"),
            F.count("review_score").alias("scored"),
            F.sum("review_score").alias("scores"),
            F.count_if(F.col("review_score") == 5).alias("five_star"),
        ),
        "order-reviews",
    )
    items = filtered(star, ITEMS, where).select("order_id", "product_key")
    per_product = (
        items.join(per_order, "order_id", "left")
        .groupBy("product_key")
        .agg(
            F.count("*").alias("items_sold"),
            *[F.sum(c).alias(c) for c in ("reviews", "scored", "scores", "five_star")],
        )
    )
    products = star.gold("DimProduct").select("product_key", "category_en")
    return (
        per_product.join(products, "product_key")
        .groupBy("category_en")
        .agg(*[F.sum(c).alias(c) for c in ("items_sold", "reviews", "scored", "scores", "five_star")])
    )


def category_reviews(star: Star, n: int = 10, where: Where = None) -> DataFrame:
    rows = _reviews_by_category(star, where).where(F.col("scored") > 0)
    rows = rows.select("category_en", ratio("scores", "scored").alias("avg_review_score"), "items_sold")
    return top_n(rows, F.col("avg_review_score").desc(), n, ["category_en"])


def five_star_share(star: Star, n: int = 10, at_least: int = 100, where: Where = None) -> DataFrame:
    rows = _reviews_by_category(star, where).where(F.col("reviews") >= at_least)
    share = ratio("five_star", "reviews").alias("five_star_pct")
    rows = rows.select("category_en", F.col("reviews").alias("review_rows"), share)
    return top_n(rows, F.col("five_star_pct").desc(), n, ["category_en"])


# Sales questions


def payment_mix(star: Star, types: tuple[str, ...] = ("credit_card", "boleto"), where: Where = None) -> DataFrame:
    return report(star, ["paid_orders", "average_basket"], ["payment_type"], {**(where or {}), "payment_type": types})


def installment_mix(star: Star, where: Where = None) -> DataFrame:
    return report(star, ["payment_rows", "total_payments"], ["payment_installments"], where)


def top_sellers(star: Star, n: int = 10, where: Where = None) -> DataFrame:
    rows = report(star, ["gmv"], ["seller_id", "seller_state"], where)
    return top_n(rows, F.col("gmv").desc_nulls_last(), n, ["seller_id"])


def last_month_top(star: Star, n: int = 5, state: str | None = None, day: Column | None = None) -> DataFrame:
    """Best-selling categories of the month before that of ``day``, by default the last purchase on record."""
    return _top_of(star, timeline.in_month(star, 1, day), n, state)


def _top_of(star: Star, items: DataFrame, n: int, state: str | None) -> DataFrame:
    if state is not None:
        people = star.gold("DimCustomer").where(condition("customer_state", state)).select("customer_key")
        items = items.join(people, "customer_key", "left_semi")
    by_product = items.groupBy("product_key").agg(F.sum("total_value").alias("value"))
    products = star.gold("DimProduct").select("product_key", "category_en")
    rows = by_product.join(products, "product_key").groupBy("category_en").agg(total_money("value").alias("gmv"))
    return top_n(rows, F.col("gmv").desc(), n, ["category_en"])


def period_sales(items: DataFrame) -> DataFrame:
    """GMV and orders of a selection of items."""
    return items.agg(total_money("total_value").alias("gmv"), F.count_distinct("order_id").alias("order_count"))


# Hierarchies


def rollup_of(star: Star, levels: list[str]) -> DataFrame:
    """GMV and item rows at every level of a hierarchy.

    The facts are grouped by the finest level once; the levels above are rolled up from that.
    """
    finest = report(star, ["gmv", "items_sold"], levels)
    return finest.rollup(*levels).agg(
        total_money("gmv").alias("gmv"),
        F.sum("items_sold").alias("items_sold"),
        F.grouping_id().cast("int").alias("level_id"),
    )


HIERARCHIES = {
    "date": ["year", "quarter", "month", "day"],
    "geography": ["region", "customer_state", "customer_city"],
    "product": ["category_en", "product_id"],
}

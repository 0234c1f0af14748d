"""The business measures, each declared once: the fact it is on and how its rows add up."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEMS, PAYMENTS, REVIEWS = "FactOrderItems", "FactPayments", "FactReviews"


@dataclass(frozen=True)
class Total:
    """Sum of an expression over the rows of a fact; parts of it may be summed before joins."""

    fact: str
    rows: Callable[[], Column]
    result: str
    ignores: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Distinct:
    """Distinct values of an id, NULL not counted; with ``when``, of rows that meet the condition.

    ``needs`` names the dimension columns the condition reads.
    """

    fact: str
    of: str
    when: Callable[[], Column] | None = None
    needs: frozenset[str] = frozenset()
    ignores: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Ratio:
    """One measure over another, blank over zero. The two may be on different facts."""

    numerator: str
    denominator: str


@dataclass(frozen=True)
class Running:
    """A total up to the last day of the context: since the year began, or over the last ``days`` days."""

    of: str
    over: str
    days: int = 0


@dataclass(frozen=True)
class Shifted:
    """A total over the days of the context moved back by ``months``."""

    of: str
    months: int


@dataclass(frozen=True)
class Change:
    """By how much a measure differs from an earlier one, over the earlier one."""

    now: str
    before: str


@dataclass(frozen=True)
class NewCustomers:
    """Customers whose first purchase ever lies within the days of the context."""


@dataclass(frozen=True)
class Share:
    """A measure over its value for all of ``column``; ``running`` adds up all values at least as large."""

    of: str
    column: str
    running: bool = False


Measure = Total | Distinct | Ratio | Running | Shifted | Change | NewCustomers | Share


def _sum(fact: str, column: str, result: str) -> Total:
    return Total(fact, lambda: F.col(column), result)


def _money(fact: str, column: str) -> Total:
    return _sum(fact, column, "decimal(28,2)")


def _count(fact: str, condition: Callable[[], Column] | None = None) -> Total:
    if condition is None:
        return Total(fact, lambda: F.lit(1), "bigint")
    return Total(fact, lambda: F.when(condition(), 1).otherwise(0), "bigint")


def _orders_with(status: str) -> Distinct:
    """Its own status condition takes the place of a status filter on the report."""
    return Distinct(
        ITEMS,
        "order_id",
        lambda: F.col("order_status") == status,
        ignores=frozenset({"order_status"}),
    )


def _delivered() -> Column:
    return F.col("delivery_days").isNotNull()


MEASURES: dict[str, Measure] = {
    # Sales
    "total_sales": _money(ITEMS, "price"),
    "total_freight": _money(ITEMS, "freight_value"),
    "gmv": _money(ITEMS, "total_value"),
    "total_payments": _money(PAYMENTS, "payment_value"),
    "order_count": Distinct(ITEMS, "order_id"),
    "items_sold": _count(ITEMS),
    "priced_items": _count(ITEMS, lambda: F.col("price").isNotNull()),
    "average_order_value": Ratio("gmv", "order_count"),
    "average_item_price": Ratio("total_sales", "priced_items"),
    # Customers
    "active_customers": Distinct(ITEMS, "customer_key"),
    "repeat_customers": Distinct(
        ITEMS,
        "customer_key",
        lambda: F.col("is_repeat_customer"),
        needs=frozenset({"is_repeat_customer"}),
        ignores=frozenset({"is_repeat_customer"}),
    ),
    "repeat_customer_pct": Ratio("repeat_customers", "active_customers"),
    # Operations
    "delivery_days": _sum(ITEMS, "delivery_days", "bigint"),
    "delivered_items": _count(ITEMS, _delivered),
    "on_time_items": _count(ITEMS, lambda: _delivered() & (F.col("on_time_flag") == 1)),
    "late_items": _count(ITEMS, lambda: F.col("delivery_vs_estimate_days") > 0),
    "avg_delivery_days": Ratio("delivery_days", "delivered_items"),
    "on_time_delivery_pct": Ratio("on_time_items", "delivered_items"),
    "late_delivery_pct": Ratio("late_items", "delivered_items"),
    "delivered_orders": _orders_with("delivered"),
    "canceled_orders": _orders_with("canceled"),
    "cancellation_rate": Ratio("canceled_orders", "order_count"),
    "canceled_item_rows": _count(ITEMS, lambda: F.col("order_status") == "canceled"),
    "delivered_item_rows": _count(ITEMS, lambda: F.col("order_status") == "delivered"),
    "cancel_item_rate": Ratio("canceled_item_rows", "items_sold"),
    # Reviews
    "review_scores": _sum(REVIEWS, "review_score", "bigint"),
    "scored_reviews": _count(REVIEWS, lambda: F.col("review_score").isNotNull()),
    "review_count": _count(REVIEWS),
    "five_star_reviews": _count(REVIEWS, lambda: F.col("review_score") == 5),
    "reviewed_orders": Distinct(REVIEWS, "order_id"),
    "avg_review_score": Ratio("review_scores", "scored_reviews"),
    "review_response_rate": Ratio("reviewed_orders", "order_count"),
    "five_star_pct": Ratio("five_star_reviews", "review_count"),
    # Payments
    "payment_rows": _count(PAYMENTS),
    "paid_orders": Distinct(PAYMENTS, "order_id"),
    "average_basket": Ratio("total_payments", "paid_orders"),
    # Time
    "new_customers": NewCustomers(),
    "gmv_ytd": Running("gmv", "year"),
    "gmv_rolling_30d": Running("gmv", "days", 30),
    "gmv_ly": Shifted("gmv", 12),
    "gmv_pm": Shifted("gmv", 1),
    "gmv_yoy_pct": Change("gmv", "gmv_ly"),
    "gmv_mom_pct": Change("gmv", "gmv_pm"),
    # Mix
    "category_pct_of_total": Share("gmv", "category_en"),
    "cumulative_gmv_pct": Share("gmv", "category_en", running=True),
}

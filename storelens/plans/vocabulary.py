"""Business words and what they stand for in the star."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from storelens.plans import timeline
from storelens.plans.metrics import Star, report

# Term -> measure.
TERMS = {
    "revenue": "gmv",
    "gmv": "gmv",
    "net sales": "total_sales",
    "freight income": "total_freight",
    "order count": "order_count",
    "active customers": "active_customers",
    "delivered": "delivered_orders",
    "canceled": "canceled_orders",
    "average basket": "average_order_value",
    "average price": "average_item_price",
    "average score": "avg_review_score",
    "five-star share": "five_star_pct",
    "on-time share": "on_time_delivery_pct",
    "average delivery time": "avg_delivery_days",
    "late delivery": "late_items",
    "payments": "total_payments",
    "new customers": "new_customers",
}

# Term -> filter.
FILTERS: dict[str, dict[str, Any]] = {
    "canceled orders": {"order_status": "canceled"},
    "delivered orders": {"order_status": "delivered"},
    "credit card": {"payment_type": "credit_card"},
    "boleto": {"payment_type": "boleto"},
    "weekend": {"is_weekend": True},
    "black friday": {"year": 2017, "month": 11},
    "southeast brazil": {"region": "Southeast"},
    "sao paulo state": {"customer_state": "SP"},
    "rio": {"customer_state": "RJ"},
    "health and beauty": {"category_en": "health_beauty"},
    "watches and gifts": {"category_en": "watches_gifts"},
    "home textiles": {"category_en": "bed_bath_table"},
    "sports and leisure": {"category_en": "sports_leisure"},
    "computer accessories": {"category_en": "computers_accessories"},
    "garden tools": {"category_en": "garden_tools"},
}

# Term -> grouping column.
GROUPS = {
    "region": "region",
    "state": "customer_state",
    "category": "category_en",
    "day of week": "day_name",
    "month": "year_month",
    "installments": "payment_installments",
    "payment type": "payment_type",
}

# Terms for a stretch of time, each a selection of item rows counted from a day, by default the last purchase on record.
PERIODS: dict[str, Callable[..., DataFrame]] = {
    "this month": lambda star, day=None: timeline.in_month(star, 0, day),
    "last month": lambda star, day=None: timeline.in_month(star, 1, day),
    "year to date": lambda star, day=None: timeline.year_to_date(star, day),
    "last 30 days": lambda star, day=None: timeline.last_days(star, 30, day),
}


def answer(
    star: Star,
    terms: Sequence[str],
    by: Sequence[str] = (),
    filters: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
) -> DataFrame:
    """A report asked for in business words; ``where`` adds filters on columns."""
    combined: dict[str, Any] = dict(where or {})
    for term in filters:
        combined.update(FILTERS[term])
    return report(star, [TERMS[t] for t in terms], [GROUPS.get(b, b) for b in by], combined)

"""The dashboard pages: every visual of a page under the filters of its slicers."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.plans import reports, timeline
from storelens.plans.metrics import ATTRIBUTES, Star, report

Where = Mapping[str, Any] | None
Page = dict[str, DataFrame]


def executive(star: Star, where: Where = None) -> Page:
    headline = ["gmv", "order_count", "average_order_value", "gmv_yoy_pct", "active_customers"]
    return {
        "headline": report(star, headline, where=where),
        "gmv by month": report(star, ["gmv", "gmv_ly"], ["year_month"], where),
        "top categories": reports.top_categories(star, 10, where),
        "pareto": report(star, ["gmv", "cumulative_gmv_pct"], ["category_en"], where),
        "gmv by state": reports.gmv_by_state(star, where),
    }


def operations(star: Star, where: Where = None) -> Page:
    return {
        "headline": reports.operations_kpis(star, where),
        "delivery days": reports.delivery_histogram(star, where),
        "on time by state": reports.on_time_by(star, "customer_state", where),
        "trend": reports.delivery_trend(star, where=where),
        "slowest sellers": reports.slowest_sellers(star, where=where),
    }


def customer(star: Star, where: Where = None) -> Page:
    """Filters that don't describe customers reach all visuals but the count of customers on file."""
    about = {*ATTRIBUTES["DimCustomer"], *ATTRIBUTES["DimGeography"]}
    return {
        "headline": reports.customer_kpis(star, where),
        "new and returning": timeline.new_and_returning(star, dict(where or {})),
        "customers by state": reports.customers_by_state(star, {c: v for c, v in (where or {}).items() if c in about}),
        "review scores": reports.review_distribution(star, where),
        "categories by review": reports.category_reviews(star, where=where),
    }


def drill_through(star: Star, state: str) -> dict[str, Page]:
    """The pages that open from one state of a map."""
    where = {"customer_state": state}
    return {"operations": operations(star, where), "customer": customer(star, where)}


def listed(pages: Mapping[str, Page]) -> DataFrame:
    """All visuals in one frame: page, visual, the row's labels as text, and a number per measure."""
    parts = []
    for page, visuals in pages.items():
        for visual, rows in visuals.items():
            texts = [c for c, kind in rows.dtypes if kind == "string" or c == "review_score"]
            numbers = [c for c in rows.columns if c not in texts]
            label = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in texts]).alias("label")
            pair = lambda c: F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
            opened = rows.select(label, F.inline(F.array(*map(pair, numbers))))
            parts.append(opened.select(F.lit(page).alias("page"), F.lit(visual).alias("visual"), "label", "measure", "value"))
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    return frame

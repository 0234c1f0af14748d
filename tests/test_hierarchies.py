"""Distinct counts up a hierarchy against sets in Python."""

from __future__ import annotations

import random

import pytest

from storelens.operators import calendar, date_bounds
from storelens.plans import hierarchies
from tests.conftest import plan_of
from tests.test_contexts import FIRST, LAST

rng = random.Random(3)
# Orders and customers over several bitmap stretches; an order of many products, and products without a category.
LINES = [(rng.choice([7, 32_767, 32_768, 40_000, 99_999]) + rng.randrange(40), rng.choice([None, 5, 70_000]) , rng.randrange(30)) for _ in range(600)]
LINES += [(123_456, 9, p) for p in range(30)]


class Lines:
    def __init__(self, spark):
        orders = sorted({o for o, _, _ in LINES})
        self.tables = {
            "DimDate": calendar(date_bounds(spark, FIRST, LAST)),
            "DimProduct": spark.createDataFrame(
                [(p, f"p{p}", None if p % 7 == 0 else f"cat{p % 4}", f"w{p % 3}") for p in range(30)],
                "product_key long, product_id string, category_en string, weight_bucket string",
            ),
            "FactOrderItems": spark.createDataFrame(
                [(f"o{o}", n, 20160101 + o % 28, c, p, 2016, 1) for n, (o, c, p) in enumerate(LINES)],
                "order_id string, order_item_id int, purchase_date_key int, customer_key long, product_key long, purchase_year int, purchase_month int",
            ),
            "_order_number": spark.createDataFrame([(f"o{o}", o) for o in orders], "order_id string, order_number long"),
        }

    def gold(self, name):
        return self.tables[name]


@pytest.fixture(scope="module")
def star(spark):
    return Lines(spark)


def brute(chosen=lambda o, c, p: True):
    seen = {}
    for o, c, p in LINES:
        if not chosen(o, c, p):
            continue
        path = (None if p % 7 == 0 else f"cat{p % 4}", f"w{p % 3}", f"p{p}")
        for kept in range(4):
            key = (*path[:kept], *[None] * (3 - kept), (1 << (3 - kept)) - 1)
            orders, people = seen.setdefault(key, (set(), set()))
            orders.add(o)
            people.update({c} - {None})
    return {key: (len(orders), len(people)) for key, (orders, people) in seen.items()}


def rows(frame):
    return {tuple(r)[:4]: (r.order_count, r.active_customers or 0) for r in frame.collect()}


LEVELS = ["category_en", "weight_bucket", "product_id"]


def test_every_level_equals_sets(star):
    assert rows(hierarchies.distinct_rollup(star, LEVELS)) == brute()


def test_filters_reach_the_counts(star):
    got = rows(hierarchies.distinct_rollup(star, LEVELS, {"weight_bucket": ["w0", "w2"], "day": 5}))
    assert got == brute(lambda o, c, p: p % 3 != 1 and o % 28 == 4)


def test_nothing_to_count(star):
    got = hierarchies.distinct_rollup(star, LEVELS, {"year": 2030}).collect()
    assert [(tuple(r)[:3], r.order_count, r.active_customers) for r in got] == [((None, None, None), 0, 0)]


def test_bitmaps_and_no_row_per_level(star):
    plan = plan_of(hierarchies.distinct_up(star, LEVELS, "order_count"))
    assert "bitmap_or_agg" in plan and "Expand" not in plan

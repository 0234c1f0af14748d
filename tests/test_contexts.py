"""Measures that look beyond the days of their group, on a small star held in memory."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storelens.operators import calendar, date_bounds
from storelens.plans import pages
from storelens.plans.metrics import filtered, report
from tests.conftest import plan_of

FIRST, LAST = date(2015, 1, 1), date(2017, 12, 31)


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


class SmallStar:
    def __init__(self, spark, items):
        self.tables = {
            "DimDate": calendar(date_bounds(spark, FIRST, LAST)),
            "DimCustomer": spark.createDataFrame(
                [(c, f"u{c}", 1, "X", "AB"[c % 2], 1, False) for c in range(12)],
                "customer_key long, customer_unique_id string, customer_zip_prefix int, customer_city string, customer_state string,"
                " n_orders_per_unique int, is_repeat_customer boolean",
            ),
            "DimGeography": spark.createDataFrame([(1, "A", "North"), (2, "B", "South")], "geography_key long, state string, region string"),
            "DimProduct": spark.createDataFrame([(p, f"p{p}", f"cat{p % 3}") for p in range(6)], "product_key long, product_id string, category_en string"),
            "FactOrderItems": spark.createDataFrame(
                [(f"o{n}", 1, key(d), c, p, Decimal(v), d.year, d.month) for n, (d, c, p, v) in enumerate(items)],
                "order_id string, order_item_id int, purchase_date_key int, customer_key long, product_key long, total_value decimal(12,2),"
                " purchase_year int, purchase_month int",
            ),
        }
        self.tables = {n: t.cache() for n, t in self.tables.items()}

    def gold(self, name):
        return self.tables[name]


def sales(seed=1, many=120):
    rng = random.Random(seed)
    days = [FIRST + timedelta(rng.randrange((LAST - FIRST).days + 1)) for _ in range(many)]
    days += [date(2016, 2, 28), date(2016, 2, 29), date(2015, 2, 28), date(2017, 2, 28), LAST, FIRST]
    return [(d, rng.randrange(12), rng.randrange(6), rng.randrange(1, 900)) for d in days]


ITEMS = sales()
DAYS = [FIRST + timedelta(i) for i in range((LAST - FIRST).days + 1)]


@pytest.fixture(scope="module")
def star(spark):
    return SmallStar(spark, ITEMS)


def total(chosen):
    values = [v for d, c, p, v in ITEMS if chosen(d, c, p)]
    return Decimal(sum(values)) if values else None


def got(frame, *keys):
    return {tuple(r[k] for k in keys): r for r in frame.collect()}


def test_rolling_days_per_group(star):
    rows = got(report(star, ["gmv_rolling_30d"], ["category_en", "date"]), "category_en", "date")
    for category in range(3):
        for day in DAYS:
            value = total(lambda d, c, p: p % 3 == category and day - timedelta(29) <= d <= day)
            row = rows.get((f"cat{category}", day))
            assert (row and row["gmv_rolling_30d"]) == value


def test_year_to_date_per_group_and_quarter(star):
    rows = got(report(star, ["gmv_ytd"], ["region", "year_quarter"]), "region", "year_quarter")
    for parity, region in enumerate(("North", "South")):
        for year in (2015, 2016, 2017):
            for quarter in (1, 2, 3, 4):
                value = total(lambda d, c, p: c % 2 == parity and d.year == year and d.month <= 3 * quarter)
                row = rows.get((region, f"{year}-Q{quarter}"))
                assert (row and row["gmv_ytd"]) == value


def test_no_product_of_groups_and_calendar(star):
    plan = plan_of(report(star, ["gmv_rolling_30d", "gmv_ytd", "gmv_ly", "new_customers"], ["category_en", "date"]))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_the_day_that_a_month_lacks(star):
    rows = got(report(star, ["gmv", "gmv_ly", "gmv_pm"], ["date"]), "date")
    on = lambda day: total(lambda d, c, p: d == day)
    assert rows[(date(2016, 2, 29),)]["gmv_ly"] == on(date(2015, 2, 28))
    assert rows[(date(2016, 2, 28),)]["gmv_ly"] == on(date(2015, 2, 28))
    assert rows[(date(2017, 2, 28),)]["gmv_ly"] == on(date(2016, 2, 28))
    for day in (date(2016, 3, 29), date(2016, 3, 30), date(2016, 3, 31)):
        assert rows[(day,)]["gmv_pm"] == on(date(2016, 2, 29))


def test_days_that_meet_count_once_and_months_move_whole(star):
    month = report(star, ["gmv_ly"], where={"year_month": "2016-02"}).first()["gmv_ly"]
    assert month == total(lambda d, c, p: (d.year, d.month) == (2015, 2))
    whole = report(star, ["gmv_ly"], where={"year_month": "2017-02"}).first()["gmv_ly"]
    assert whole == total(lambda d, c, p: (d.year, d.month) == (2016, 2))
    part = report(star, ["gmv_ly"], where={"date": [date(2017, 2, 27), date(2017, 2, 26)]}).first()["gmv_ly"]
    assert part == total(lambda d, c, p: d in (date(2016, 2, 26), date(2016, 2, 27)))


def test_new_customers_beside_their_groups(star):
    first = {}
    for d, c, _, _ in sorted(ITEMS):
        first.setdefault(c, d)
    rows = got(report(star, ["new_customers"], ["category_en", "year"]), "category_en", "year")
    for category in range(3):
        for year in (2015, 2016, 2017):
            buyers = {c for d, c, p, v in ITEMS if p % 3 == category and d.year == year and first[c].year == year}
            assert (rows[f"cat{category}", year]["new_customers"] if (f"cat{category}", year) in rows else 0) == len(buyers)
    # The first and the last weekend day of a year bound the span; days between them count whether or not they are chosen.
    weekend = [d for d in DAYS if d.year == 2015 and d.weekday() >= 5]
    row = report(star, ["new_customers"], where={"year": 2015, "is_weekend": True}).first()
    assert row["new_customers"] == sum(min(weekend) <= d <= max(weekend) for d in first.values())
    assert report(star, ["new_customers"], where={"year": 2019}).first()["new_customers"] == 0
    assert report(star, ["new_customers"], where={"region": "North", "year": 2015}).first()["new_customers"] == len(
        {c for d, c, p, v in ITEMS if c % 2 == 0 and d.year == 2015 and first[c].year == 2015}
    )


def test_shares_let_go_of_their_column(star):
    both = ["gmv", "category_pct_of_total", "cumulative_gmv_pct"]
    every = got(report(star, both, ["region", "category_en"]), "region", "category_en")
    one = got(report(star, both, ["region"], {"category_en": "cat1"}), "region")
    for region in ("North", "South"):
        row = every[region, "cat1"]
        assert tuple(one[region,])[1:] == (row["gmv"], row["category_pct_of_total"], row["cumulative_gmv_pct"])
        rows = [r for (r_, _), r in every.items() if r_ == region]
        assert sum(r["category_pct_of_total"] for r in rows) == pytest.approx(1)
        assert max(r["cumulative_gmv_pct"] for r in rows) == pytest.approx(1)


def test_without_a_value_there_is_one_blank_row(star):
    row = report(star, ["gmv", "gmv_ytd", "gmv_ly", "gmv_yoy_pct", "category_pct_of_total"], where={"year": 2030}).first()
    assert tuple(row) == (None, None, None, None, None)


def test_filters_reach_a_fact_through_its_dimensions(star):
    rows = filtered(star, "FactOrderItems", {"region": "North", "year": [2015, 2016], "category_en": "cat2"})
    assert rows.columns == star.gold("FactOrderItems").columns
    assert rows.agg(F.sum("total_value")).first()[0] == total(lambda d, c, p: c % 2 == 0 and d.year < 2017 and p % 3 == 2)


def test_executive_page(star):
    shown = pages.executive(star, {"year": 2016, "region": "South"})
    assert got(shown["gmv by month"], "year_month")["2016-05",]["gmv_ly"] == total(lambda d, c, p: c % 2 == 1 and (d.year, d.month) == (2015, 5))
    listed = pages.listed({"executive": shown})
    assert listed.columns == ["page", "visual", "label", "measure", "value"]
    assert listed.where("visual = 'headline'").count() == 5

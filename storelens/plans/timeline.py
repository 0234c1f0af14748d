"""GMV through time, first purchases and category mix.

Facts are reduced to days, months or customers first; what follows works on frames the size of the
calendar or of the category list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions import date_key, ratio
from storelens.operators import (
    cumulative_share,
    month_index,
    share_of_total,
    shifted,
    to_date,
    trailing,
)
from storelens.plans.measures import ITEMS
from storelens.plans.metrics import Star, filtered, report


def months(star: Star) -> DataFrame:
    """The calendar's months, whether or not anything was sold in them."""
    return (
        star.gold("DimDate")
        .groupBy("year", "month", "year_month")
        .agg(F.max("date").alias("last_day"))
        .withColumn("month_index", month_index("year", "month"))
    )


def gmv_by_month(star: Star) -> DataFrame:
    """``month_index`` and ``gmv`` of the months with sales."""
    return (
        star.gold(ITEMS)
        .where(F.col("purchase_date_key").isNotNull())
        .groupBy(month_index("purchase_year", "purchase_month").alias("month_index"))
        .agg(F.sum("total_value").cast("decimal(28,2)").alias("gmv"))
    )


def gmv_spine(star: Star) -> DataFrame:
    """Every calendar day with its GMV, zero where nothing was sold."""
    daily = star.gold(ITEMS).groupBy("purchase_date_key").agg(F.sum("total_value").alias("sold"))
    days = star.gold("DimDate").select("date_key", "date", "year", "month", "year_month")
    sold = F.coalesce("sold", F.lit(0)).cast("decimal(28,2)").alias("gmv")
    joined = days.join(daily, days["date_key"] == daily["purchase_date_key"], "left")
    return joined.select("date", "year", "month", "year_month", sold)


def gmv_ytd(star: Star) -> DataFrame:
    """Running GMV of the year at the end of each calendar month."""
    monthly = gmv_spine(star).groupBy("year", "year_month").agg(F.sum("gmv").alias("gmv"))
    running = to_date(monthly, ["year"], "year_month", "gmv", "gmv_ytd")
    return running.select("year_month", F.col("gmv_ytd").cast("decimal(28,2)").alias("gmv_ytd"))


def gmv_rolling(star: Star, days: int = 30) -> DataFrame:
    """GMV of the last ``days`` days, the current one included, at the end of each calendar month."""
    running = trailing(gmv_spine(star), "date", days, "gmv", "rolling")
    return running.where(F.col("date") == F.last_day("date")).select(
        "year_month", F.col("rolling").cast("decimal(28,2)").alias(f"gmv_rolling_{days}d")
    )


def gmv_against(star: Star, months_back: int, name: str) -> DataFrame:
    """Monthly GMV beside that of ``months_back`` months before, and the change over it.

    Months without either value are left out; a month whose earlier one had no sales is blank there.
    """
    both = shifted(gmv_by_month(star), "month_index", months_back, "gmv", name)
    labels = F.broadcast(months(star).select("month_index", "year_month"))
    change = ratio(F.col("gmv") - F.col(name), F.col(name))
    return both.join(labels, "month_index").select("year_month", "gmv", name, change.alias("change"))


def gmv_ly(star: Star) -> DataFrame:
    return gmv_against(star, 12, "gmv_ly").select("year_month", "gmv", "gmv_ly")


def gmv_yoy(star: Star) -> DataFrame:
    return gmv_against(star, 12, "gmv_ly").select("year_month", F.col("change").alias("gmv_yoy_pct"))


def gmv_mom(star: Star) -> DataFrame:
    return gmv_against(star, 1, "gmv_pm").select("year_month", F.col("change").alias("gmv_mom_pct"))


def new_customers(star: Star, by: list[str], where: dict | None = None) -> DataFrame:
    """Customers whose first purchase ever lies within the days of the group."""
    return report(star, ["new_customers"], by, where)


def new_and_returning(star: Star, where: dict | None = None) -> DataFrame:
    """Active customers of each month, split by whether it is their first ever, whatever the filter leaves of it."""
    month = month_index("purchase_year", "purchase_month").alias("month_index")

    def months_of(rows: DataFrame) -> DataFrame:
        known = rows.where(F.col("customer_key").isNotNull() & F.col("purchase_date_key").isNotNull())
        return known.groupBy("customer_key", month).agg(F.count(F.lit(1)).alias("lines"))

    bought = months_of(star.gold(ITEMS))
    first = F.min("month_index").over(Window.partitionBy("customer_key"))
    bought = bought.withColumn("first", first)
    if where:
        bought = bought.join(months_of(filtered(star, ITEMS, where)).drop("lines"), ["customer_key", "month_index"])
    split = (
        bought.withColumn("is_first", F.col("month_index") == F.col("first"))
        .groupBy("month_index")
        .agg(
            F.count_if("is_first").alias("new_customers"),
            F.count_if(~F.col("is_first")).alias("returning_customers"),
        )
    )
    labels = F.broadcast(months(star).select("month_index", "year_month"))
    return split.join(labels, "month_index").select("year_month", "new_customers", "returning_customers")


def category_share(star: Star, within: list[str] | None = None) -> DataFrame:
    """Each category's part of the GMV of all categories that share the other grouping columns."""
    within = within or []
    totals = report(star, ["gmv"], [*within, "category_en"])
    return share_of_total(totals, "gmv", "category_pct_of_total", within)


def pareto(star: Star) -> DataFrame:
    """Categories by GMV with the share held by each and all above it, ties together."""
    totals = cumulative_share(report(star, ["gmv"], ["category_en"]), "gmv", "cumulative_gmv_pct")
    order = Window.orderBy(F.col("gmv").desc_nulls_last(), F.col("category_en").asc_nulls_last())
    return totals.withColumn("category_rank", F.row_number().over(order))


def as_of(star: Star) -> Column:
    """The last purchase date on record, as a scalar subquery: the day relative periods count from.

    The last month comes from the partition columns, and only its folder is read for the day.
    """
    items = star.gold(ITEMS)
    month = month_index("purchase_year", "purchase_month")
    last_month = items.agg(F.max(month)).scalar()
    last = items.where(month == last_month).agg(F.max("purchase_date_key").alias("last"))
    day = F.to_date(F.col("last").cast("string"), "yyyyMMdd")
    return last.select(day.alias("as_of")).scalar()


def in_month(star: Star, months_back: int = 0, day: Column | None = None) -> DataFrame:
    """Items bought in the month of ``day`` (the last purchase by default) or that many before it."""
    day = as_of(star) if day is None else day
    wanted = month_index(F.year(day), F.month(day)) - months_back
    # Conditions on the partition columns, so that only the month's folder is read.
    year, month = F.floor(wanted / 12).cast("int"), (wanted % 12 + 1).cast("int")
    return star.gold(ITEMS).where((F.col("purchase_year") == year) & (F.col("purchase_month") == month))


def year_to_date(star: Star, day: Column | None = None) -> DataFrame:
    day = as_of(star) if day is None else day
    return star.gold(ITEMS).where(
        (F.col("purchase_year") == F.year(day)) & (F.col("purchase_date_key") <= date_key(day))
    )


def last_days(star: Star, days: int = 30, day: Column | None = None) -> DataFrame:
    """From ``days`` days before ``day`` to ``day`` itself: one day more than the rolling measure."""
    day = as_of(star) if day is None else day
    start = F.date_sub(day, days)
    bought = month_index("purchase_year", "purchase_month")
    return star.gold(ITEMS).where(
        (F.col("purchase_date_key") >= date_key(start))
        & (F.col("purchase_date_key") <= date_key(day))
        # The same span in months, for the folders.
        & (bought >= month_index(F.year(start), F.month(start)))
        & (bought <= month_index(F.year(day), F.month(day)))
    )

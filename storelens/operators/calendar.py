"""Calendar generator."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions import date_key


def date_bounds(spark: SparkSession, first: date, last: date) -> DataFrame:
    return spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included, of a one-row frame.

    Weeks are ISO weeks; ``day_of_week`` runs from 1 (Sunday) to 7 (Saturday).
    """
    day = F.col("date")
    days = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")).alias("year_quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )

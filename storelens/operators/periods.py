"""Period arithmetic over aggregated frames.

Every function here takes a frame that is already aggregated to days, months or categories. Its size
follows the calendar or the category vocabulary, never the facts, so an unpartitioned window is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions import ratio


def month_index(year: Column | str, month: Column | str) -> Column:
    """Months counted from year 0, so that one month back is minus one and a year back is minus twelve."""
    year, month = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    return year * 12 + month - 1


def shifted(frame: DataFrame, period: str, periods: int, value: str, name: str) -> DataFrame:
    """Put the value of ``periods`` periods ago beside each period's own.

    A period that has only an earlier value keeps its row with a NULL of its own; a missing earlier
    period gives NULL, never the row before. Each row is sent to both periods it counts for and the two
    meet again in a grouping, so the frame below is computed once, not once per side of a self-join.
    """
    data_type = frame.schema[value].dataType
    blank = F.lit(None).cast(data_type)
    own = F.struct(F.col(period).alias("p"), F.col(value).alias("now"), blank.alias("then"))
    later = F.struct((F.col(period) + periods).alias("p"), blank.alias("now"), F.col(value).alias("then"))
    return (
        frame.select(F.inline(F.array(own, later)))
        .groupBy(F.col("p").alias(period))
        .agg(F.max("now").alias(value), F.max("then").alias(name))
    )


def to_date(frame: DataFrame, reset_by: list[str], order: str, value: str, name: str) -> DataFrame:
    """Running total that starts again with each ``reset_by``."""
    window = Window.partitionBy(*reset_by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return frame.withColumn(name, F.sum(value).over(window))


def trailing(frame: DataFrame, day: str, days: int, value: str, name: str) -> DataFrame:
    """Total over the last ``days`` days, the current one included."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    window = Window.orderBy(number).rangeBetween(-(days - 1), 0)
    return frame.withColumn(name, F.sum(value).over(window))


def cumulative_share(frame: DataFrame, value: str, name: str) -> DataFrame:
    """Share of the total held by this row and all rows at least as large; equal rows count together."""
    running = Window.orderBy(F.col(value).desc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    return frame.withColumn(name, ratio(F.sum(value).over(running), F.sum(value).over(whole)))


def share_of_total(frame: DataFrame, value: str, name: str, within: list[str] | None = None) -> DataFrame:
    """Share of the total of the rows that agree on ``within``."""
    return frame.withColumn(name, ratio(F.col(value), F.sum(value).over(Window.partitionBy(*(within or [])))))

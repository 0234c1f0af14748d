"""Measures that look beyond the days of their own group: to date, rolling, earlier periods, new customers, shares.

A report's grouping and filters fall into a calendar part and the rest. The calendar part cuts the calendar into cells, one
per group of days; cells are numbered by their last day. Whatever follows works on the fact summed by the rest and by
day, and on frames of calendar size, which are broadcast. Groups and calendar are never multiplied out.

To date and rolling: a day's value counts from the first cell that ends on it or after it, until the first cell that ends on
its expiry or after it. So each value is an event of plus and one of minus; events are summed by group and cell and run up
in a window per group. A group has a row for a cell only while something counts in it.

Earlier periods: the days of a cell move as a set. A day that its month lacks becomes the month's last, and several days that
meet count once. Where a cell holds the last two days of a month, the earlier month is taken to its end.

New customers: those whose first purchase ever lies between the first and the last day of the cell, whatever days between
them the filter leaves out, and who bought something that meets the other filters within these days.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions import date_key, ratio
from storelens.plans import metrics
from storelens.plans.measures import ITEMS, MEASURES, NewCustomers, Running, Share, Shifted


class Context:
    """The grouping and filters of a report, taken apart."""

    def __init__(self, star: metrics.Star, by: Sequence[str], where: Mapping[str, Any], role: str):
        calendar = set(metrics.ATTRIBUTES["DimDate"])
        self.star, self.by, self.where, self.role = star, list(by), dict(where), role
        self.on_days = [c for c in by if c in calendar]
        self.rest = [c for c in by if c not in calendar]
        self.day_filters = {c: v for c, v in where.items() if c in calendar}
        self.filters = {c: v for c, v in where.items() if c not in calendar}

    def chosen(self) -> DataFrame:
        """The days that the filters leave, with the grouping columns."""
        days = self.star.gold("DimDate")
        for column, value in self.day_filters.items():
            days = days.where(metrics.condition(column, value))
        return days

    def cells(self) -> DataFrame:
        """``_cell, _start, _end`` and the calendar grouping columns; at most one row per day."""
        spans = self.chosen().groupBy(*self.on_days).agg(F.min("date").alias("_start"), F.max("date").alias("_end"))
        return spans.where("_end IS NOT NULL").withColumn("_cell", F.row_number().over(Window.orderBy("_end")))

    def cell_from(self) -> DataFrame:
        """``date, _cell``: for every calendar day the first cell that ends on it or later."""
        ends = self.cells().select(F.col("_end").alias("date"), "_cell")
        # From the last day backwards: a frame that runs up costs one step a row, one that runs out all rows behind it.
        onward = Window.orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, 0)
        days = self.star.gold("DimDate").select("date").join(F.broadcast(ends), "date", "left")
        return days.select("date", F.min("_cell").over(onward).alias("_cell"))

    def by_day(self, base: str) -> DataFrame:
        """A summed measure by day and by what the report groups by beside the calendar."""
        days = metrics.aggregate(self.star, MEASURES[base].fact, [base], [*self.rest, "date"], self.filters, self.role)
        return days.where(F.col("date").isNotNull() & F.col(base).isNotNull())

    def labelled(self, rows: DataFrame, value: str) -> DataFrame:
        """The report's columns in place of cell numbers; without columns one row, NULL where there is nothing."""
        named = rows.join(F.broadcast(self.cells().select("_cell", *self.on_days)), "_cell").select(*self.by, value)
        return named if self.by else named.agg(F.max(value).alias(value))


def expiry(kind: str, days: int) -> Column:
    """The first day on which a day's value no longer counts."""
    if kind == "year":
        return F.make_date(F.year("date") + 1, F.lit(1), F.lit(1))
    return F.date_add("date", days)


def running(context: Context, name: str) -> DataFrame:
    """A total to date or over the last days, at the last day of each cell."""
    measure: Running = MEASURES[name]
    base = measure.of
    first = context.cell_from()
    until = first.select(F.col("date").alias("_expiry"), F.col("_cell").alias("_until"))
    reach = first.withColumn("_expiry", expiry(measure.over, measure.days)).join(F.broadcast(until), "_expiry", "left")
    values = context.by_day(base).join(F.broadcast(reach.drop("_expiry")), "date")
    event = lambda cell, sign: F.struct(F.col(cell).alias("_cell"), (F.col(base) * sign).alias("_value"), F.lit(sign).alias("_n"))
    events = values.select(*context.rest, F.inline(F.array(event("_cell", 1), event("_until", -1)))).where("_cell IS NOT NULL")
    summed = events.groupBy(*context.rest, "_cell").agg(F.sum("_value").alias("_value"), F.sum("_n").alias("_n"))
    along = Window.partitionBy(*context.rest).orderBy("_cell")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    last = context.cells().agg(F.max("_cell")).scalar()
    states = summed.select(
        *context.rest,
        "_cell",
        F.sum("_value").over(upto).cast(MEASURES[base].result).alias(name),
        F.sum("_n").over(upto).alias("_live"),
        (F.coalesce(F.lead("_cell").over(along), last + 1) - 1).alias("_last"),
    ).where("_live > 0")
    held = states.select(*context.rest, name, F.explode(F.sequence("_cell", "_last")).alias("_cell"))
    return context.labelled(held, name)


def earlier_days(context: Context, months: int) -> DataFrame:
    """``_cell, date``: the days of each cell, ``months`` before; a frame of calendar size."""
    cells = context.cells().select("_cell", *[F.col(c).alias(f"_{c}") for c in context.on_days])
    match = F.lit(True)
    for column in context.on_days:
        match = match & F.col(column).eqNullSafe(F.col(f"_{column}"))
    own = context.chosen().select("date", *[c for c in context.on_days if c != "date"])
    own = own.join(F.broadcast(cells), match).select("_cell", "date") if context.on_days else own.withColumn("_cell", F.lit(1))
    moved = own.select("_cell", F.add_months("date", -months).alias("date"))
    ends = own.where(F.col("date") >= F.date_sub(F.last_day("date"), 1)).groupBy("_cell", F.last_day("date").alias("_month_end"))
    whole = ends.agg(F.count(F.lit(1)).alias("n")).where("n = 2")
    # From the day the month's last moves to, to the end of that month.
    start = F.add_months("_month_end", -months)
    rest = whole.select("_cell", F.explode(F.sequence(start, F.last_day(start))).alias("date"))
    return moved.union(rest).distinct()


def shifted(context: Context, name: str) -> DataFrame:
    measure: Shifted = MEASURES[name]
    base = measure.of
    days = earlier_days(context, measure.months)
    rows = context.by_day(base).join(F.broadcast(days), "date")
    summed = rows.groupBy(*context.rest, "_cell").agg(F.sum(base).cast(MEASURES[base].result).alias(name))
    return context.labelled(summed, name)


def new_customers(context: Context, name: str) -> DataFrame:
    """First dates come from the whole fact, buyers from what the filters leave."""
    star, rest = context.star, context.rest
    firsts = (
        star.gold(ITEMS)
        .where(F.col("customer_key").isNotNull() & F.col("purchase_date_key").isNotNull())
        .groupBy("customer_key")
        .agg(F.min("purchase_date_key").alias("_first"))
    )
    if rest or context.filters:
        buyers = metrics.first_dates(star, rest, context.filters)
        known = buyers.join(firsts, "customer_key")
    else:
        known = firsts.withColumn("_bought", F.col("_first"))
    counted = known.groupBy(*rest, "_first", "_bought").agg(F.count(F.lit(1)).alias("_n"))
    cells = context.cells()
    days = F.explode(F.sequence("_start", "_end", F.expr("interval 1 day"))).alias("_day")
    spans = cells.select("_cell", date_key("_end").alias("_last"), days).select("_cell", "_last", date_key("_day").alias("_first"))
    met = counted.join(F.broadcast(spans), "_first").where("_bought <= _last")
    summed = met.groupBy(*rest, "_cell").agg(F.sum("_n").cast("bigint").alias(name))
    rows = context.labelled(summed, name)
    # Without a grouping there is one row, also where nobody is new.
    return rows if context.by else rows.select(F.coalesce(name, F.lit(0)).cast("bigint").alias(name))


def share(context: Context, name: str) -> DataFrame:
    """A measure over the same without the filter and grouping of one column; running, over all at least as large."""
    measure: Share = MEASURES[name]
    star, of, column = context.star, measure.of, measure.column
    rest = [c for c in context.by if c != column]
    others = {c: v for c, v in context.where.items() if c != column}
    own = metrics.report(star, [of], context.by, context.where, context.role).where(F.col(of).isNotNull())
    # Every value of the column weighs in the sums; the report's own rows only stand among them.
    every = metrics.report(star, [of], [*rest, column], others, context.role).where(F.col(of).isNotNull())
    rows = every.select(*rest, F.lit(None).cast(every.schema[column].dataType).alias(column), of, F.col(of).alias("_weight"), F.lit(False).alias("_own"))
    named = F.col(column) if column in context.by else F.lit(None).cast(every.schema[column].dataType).alias(column)
    asked = own.select(*rest, named, of, F.lit(None).cast(every.schema[of].dataType).alias("_weight"), F.lit(True).alias("_own"))
    group = Window.partitionBy(*rest)
    upto = group.orderBy(F.col(of).desc()).rangeBetween(Window.unboundedPreceding, 0)
    part = F.sum("_weight").over(upto) if measure.running else F.col(of)
    told = rows.unionByName(asked).withColumn(name, ratio(part, F.sum("_weight").over(group))).where("_own")
    return told.select(*context.by, name) if context.by else told.agg(F.max(name).alias(name))


FRAMES: dict[type, Callable[[Context, str], DataFrame]] = {Running: running, Shifted: shifted, NewCustomers: new_customers, Share: share}

"""Reports over the star: measures grouped and filtered by dimension columns.

Each fact is aggregated on its own and the results meet on the grouping columns; facts are never joined
to each other. On the way to a dimension that grows with the data, a fact is first aggregated by its
key into that dimension. The partial aggregate runs before the shuffle, so a customer, product or seller
that holds a large part of the rows arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions import ratio
from storelens.operators import lookup
from storelens.plans.measures import ITEMS, MEASURES, PAYMENTS, REVIEWS, Change, Distinct, Ratio, Total


class Star(Protocol):
    def gold(self, name: str) -> DataFrame: ...


# The columns a report may group or filter by, per dimension, and each dimension's key in the facts.
ATTRIBUTES = {
    "DimDate": (
        "date",
        "year",
        "quarter",
        "month",
        "month_name",
        "day",
        "day_of_week",
        "day_name",
        "day_of_year",
        "week_of_year",
        "is_weekend",
        "year_quarter",
        "year_month",
    ),
    "DimCustomer": (
        "customer_unique_id",
        "customer_zip_prefix",
        "customer_city",
        "customer_state",
        "n_orders_per_unique",
        "is_repeat_customer",
    ),
    "DimGeography": ("region",),
    "DimProduct": (
        "product_id",
        "category_pt",
        "category_en",
        "photos_qty",
        "weight_g",
        "length_cm",
        "height_cm",
        "width_cm",
        "weight_bucket",
    ),
    "DimSeller": ("seller_id", "seller_zip_prefix", "seller_city", "seller_state"),
}
FOREIGN_KEY = {
    "DimCustomer": "customer_key",
    "DimGeography": "customer_key",
    "DimProduct": "product_key",
    "DimSeller": "seller_key",
}
# The measure that counts the rows of each fact.
ROWS = {ITEMS: "items_sold", PAYMENTS: "payment_rows", REVIEWS: "review_count"}
DATE_ROLES = {"purchase": "purchase_date_key", "delivered": "delivered_date_key"}
_DIMENSION = {column: dim for dim, columns in ATTRIBUTES.items() for column in columns}


def condition(column: str, value: Any) -> Column:
    if isinstance(value, (list, tuple, set, frozenset)):
        return F.col(column).isin(list(value))
    if value is None:
        return F.col(column).isNull()
    return F.col(column) == F.lit(value)


def on_days(rows: DataFrame, days: DataFrame, role: str = "purchase", how: str = "inner") -> DataFrame:
    """Join a fact to calendar rows.

    The calendar has 366 rows a year at most, so it is always broadcast. By purchase date the join also
    names the year and month the fact is partitioned by: a filter on the calendar then prunes folders.
    """
    key = DATE_ROLES[role]
    columns = [c for c in days.columns if c != "date_key"]
    right = days.select(
        F.col("date_key").alias("_date_key"),
        F.floor(F.col("date_key") / 10000).cast("int").alias("_year"),
        (F.floor(F.col("date_key") / 100) % 100).cast("int").alias("_month"),
        *columns,
    )
    match = rows[key] == right["_date_key"]
    if role == "purchase":
        match = match & (rows["purchase_year"] == right["_year"]) & (rows["purchase_month"] == right["_month"])
    return rows.join(F.broadcast(right), match, how).drop("_date_key", "_year", "_month")


def report(
    star: Star,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
    date_role: str = "purchase",
) -> DataFrame:
    """Measures by dimension columns, one row per group and one row in all without ``by``.

    ``where`` maps a column to a value or a list of values. A group that only one of the facts has keeps
    its row, with NULL for the measures of the others. A fact row without a dimension row counts under
    NULL unless the dimension is filtered. A measure with a condition of its own on a column does not heed that
    column, neither in ``where`` nor in ``by``: grouped by it, every group shows the same value.
    """
    by, where = list(by), dict(where or {})
    base = _base_measures(measures)
    groups: dict[tuple[str, frozenset[str]], list[str]] = {}
    beyond = [n for n in base if not isinstance(MEASURES[n], Total | Distinct)]
    for name in base:
        if name in beyond:
            continue
        measure = MEASURES[name]
        ignored = frozenset(measure.ignores.intersection([*where, *by]))
        groups.setdefault((measure.fact, ignored), []).append(name)

    frames = []
    for (fact, ignored), names in groups.items():
        filters = {c: v for c, v in where.items() if c not in ignored}
        kept = [c for c in by if c not in ignored]
        frame = aggregate(star, fact, names, kept, filters, date_role)
        if len(kept) < len(by):
            shown = aggregate(star, fact, [ROWS[fact]], by, where, date_role).drop(ROWS[fact])
            frame = _spread(shown, frame, kept, names)
        frames.append(frame)
    if beyond:
        from storelens.plans import contexts  # builds on this module

        context = contexts.Context(star, by, where, date_role)
        frames += [contexts.FRAMES[type(MEASURES[name])](context, name) for name in beyond]
    return merge(frames, by, base).select(*by, *[_result(name).alias(name) for name in measures])


def _spread(groups: DataFrame, totals: DataFrame, kept: list[str], names: list[str]) -> DataFrame:
    """Totals by the ``kept`` columns beside every group that shares these."""
    if not kept:
        return groups.select("*", *[totals.select(n).scalar().alias(n) for n in names])
    match = F.lit(True)
    for column in kept:
        match = match & F.col(column).eqNullSafe(F.col(f"_{column}"))
    own = totals.select(*[F.col(c).alias(f"_{c}") for c in kept], *names)
    return groups.join(own, match, "left").drop(*[f"_{c}" for c in kept])


def merge(frames: Sequence[DataFrame], by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Full outer join of aggregated frames, with NULL groups matching: a union grouped again."""
    if len(frames) == 1:
        return frames[0]
    rows = frames[0]
    for other in frames[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    return rows.groupBy(*by).agg(*[F.max(v).alias(v) for v in values])


def _base_measures(measures: Sequence[str]) -> list[str]:
    base: dict[str, None] = {}
    for name in measures:
        for part in _parts(name):
            base[part] = None
    return list(base)


def _parts(name: str) -> tuple[str, ...]:
    match MEASURES[name]:
        case Ratio(numerator, denominator):
            return numerator, denominator
        case Change(now, before):
            return now, before
    return (name,)


def _result(name: str) -> Column:
    match MEASURES[name]:
        case Ratio(numerator, denominator):
            return ratio(numerator, denominator)
        case Change(now, before):
            return ratio(F.col(now) - F.col(before), F.col(before))
    return F.col(name)


def aggregate(
    star: Star, fact: str, names: list[str], by: list[str], where: dict[str, Any], role: str
) -> DataFrame:
    """The measures of one fact under one set of filters."""
    totals = {n: m for n in names if isinstance(m := MEASURES[n], Total)}
    distincts = {n: m for n in names if isinstance(m := MEASURES[n], Distinct)}
    needs = [c for m in distincts.values() for c in sorted(m.needs)]
    rows, foreign, joined = reached(star, fact, [*by, *where, *needs], where, role)

    # An order and a customer each have one customer key. With no other dimension a frame at the grain of
    # the counted id carries the totals along; otherwise the totals are taken on their own.
    narrow = foreign in ([], ["customer_key"])
    grain = [*foreign, *[c for c in by if c in rows.columns]]
    frames = []
    if totals and not (distincts and narrow):
        frames.append(_totals(rows, joined, grain if foreign else None, by, totals))
        totals = {}
    for counted in sorted({m.of for m in distincts.values()}):
        measures = {n: m for n, m in distincts.items() if m.of == counted}
        if narrow:
            frames.append(_per_id(rows, joined, grain, by, counted, measures, totals))
            totals = {}
        else:
            frames.append(_per_id(joined(rows), lambda frame: frame, by, by, counted, measures, {}))
    return merge(frames, by, names)


def reached(
    star: Star, fact: str, columns: Sequence[str], where: Mapping[str, Any], role: str
) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """The rows of a fact with its own and the calendar's filters applied, the keys into the other dimensions that
    ``columns`` need, and the join to these dimensions, filters applied.
    """
    rows = star.gold(fact)
    own = {c for c in rows.columns if c not in ("purchase_year", "purchase_month")}
    wanted: dict[str, list[str]] = {}
    for column in dict.fromkeys(columns):
        if column not in own:
            wanted.setdefault(_path(fact, column, own), []).append(column)
    for column in where.keys() & own:
        rows = rows.where(condition(column, where[column]))
    if "DimDate" in wanted:
        rows = _dated(star, rows, fact, own, wanted.pop("DimDate"), where, role)

    def joined(frame: DataFrame) -> DataFrame:
        for key in foreign:
            dimensions = {d: c for d, c in wanted.items() if FOREIGN_KEY[d] == key}
            filtered = any(c in where for names in dimensions.values() for c in names)
            dimension = _dimension(star, key, dimensions, where)
            frame = frame.join(lookup(dimension), key, "inner" if filtered else "left")
        return frame

    foreign = sorted({FOREIGN_KEY[d] for d in wanted})
    return rows, foreign, joined


def filtered(star: Star, fact: str, where: Mapping[str, Any] | None) -> DataFrame:
    """The rows of a fact that meet the filters of a report; without filters the fact as it is."""
    where = dict(where or {})
    rows, _, joined = reached(star, fact, list(where), where, "purchase")
    kept = rows.columns
    # A filter on a dimension keeps or drops a row and never repeats it: keys are unique there.
    return joined(rows).select(*[c for c in star.gold(fact).columns if c in kept])


def first_dates(star: Star, by: Sequence[str], where: Mapping[str, Any]) -> DataFrame:
    """``customer_key``, ``by`` and ``_bought``, the first date key on which each customer bought within ``by`` and ``where``."""
    rows, foreign, joined = reached(star, ITEMS, [*by, *where], where, "purchase")
    rows = rows.where(F.col("customer_key").isNotNull() & F.col("purchase_date_key").isNotNull())
    grain = dict.fromkeys(["customer_key", *foreign, *[c for c in by if c in rows.columns]])
    early = rows.groupBy(*grain).agg(F.min("purchase_date_key").alias("_bought"))
    return joined(early).groupBy(*dict.fromkeys(["customer_key", *by])).agg(F.min("_bought").alias("_bought"))


def _totals(
    rows: DataFrame,
    joined: Callable[[DataFrame], DataFrame],
    grain: list[str] | None,
    by: list[str],
    totals: dict[str, Total],
) -> DataFrame:
    """Sums by ``by``; with a grain, summed by that first and joined to the dimensions after."""
    if grain is None:
        return rows.groupBy(*by).agg(*[F.sum(m.rows()).cast(m.result).alias(n) for n, m in totals.items()])
    early = rows.groupBy(*dict.fromkeys(grain)).agg(*[F.sum(m.rows()).alias(f"_{n}") for n, m in totals.items()])
    return joined(early).groupBy(*by).agg(*[F.sum(f"_{n}").cast(m.result).alias(n) for n, m in totals.items()])


def _per_id(
    rows: DataFrame,
    joined: Callable[[DataFrame], DataFrame],
    grain: list[str],
    by: list[str],
    counted: str,
    measures: dict[str, Distinct],
    totals: dict[str, Total],
) -> DataFrame:
    """Distinct counts of one id: a row per id first, with a flag per condition, then plain counts.

    However many conditions there are, every id is shuffled once per group. Spark's own plan for several
    distinct counts sends each row once per count.
    """
    at_hand = set(rows.columns)
    known = {n: m for n, m in measures.items() if m.when is not None and m.needs <= at_hand}
    keys = [F.col(c) for c in dict.fromkeys([*grain, counted])]
    parts = [
        *[F.sum(m.rows()).alias(f"_{n}") for n, m in totals.items()],
        *[F.max(m.when()).alias(f"_{n}") for n, m in known.items()],
    ]
    ids = rows.groupBy(*keys).agg(*parts) if parts else rows.select(*keys).distinct()
    present = F.col(counted).isNotNull()
    counts = []
    for name, measure in measures.items():
        test = present
        if measure.when is not None:
            test = present & (F.col(f"_{name}") if name in known else measure.when())
        counts.append(F.count_if(test).alias(name))
    sums = [F.sum(f"_{n}").cast(m.result).alias(n) for n, m in totals.items()]
    return joined(ids).groupBy(*by).agg(*sums, *counts)


def _dated(
    star: Star, rows: DataFrame, fact: str, own: set[str], columns: list[str], where: dict[str, Any], role: str
) -> DataFrame:
    """Calendar columns for the date of the role, calendar filters applied."""
    if DATE_ROLES[role] not in own:
        raise ValueError(f"{fact} has no {role} date")
    days = star.gold("DimDate").select("date_key", *columns)
    filters = [c for c in columns if c in where]
    for column in filters:
        days = days.where(condition(column, where[column]))
    return on_days(rows, days, role, "inner" if filters else "left")


def _path(fact: str, column: str, own: set[str]) -> str:
    dimension = _DIMENSION.get(column)
    if dimension is None:
        raise ValueError(f"{column} is a column of neither {fact} nor a dimension")
    if dimension != "DimDate" and FOREIGN_KEY[dimension] not in own:
        raise ValueError(f"no active path from {fact} to {column}")
    return dimension


def dimension_rows(star: Star, key: str, where: dict[str, Any]) -> DataFrame:
    """A dimension with every column of its own that a report can filter by, filters applied."""
    name = next(d for d in FOREIGN_KEY if FOREIGN_KEY[d] == key)
    wanted: dict[str, list[str]] = {name: list(ATTRIBUTES[name])}
    for column in where:
        dimension = _DIMENSION.get(column)
        if FOREIGN_KEY.get(dimension) != key:
            raise ValueError(f"{column} does not filter {name}")
        if dimension != name:
            wanted.setdefault(dimension, []).append(column)
    return _dimension(star, key, wanted, where)


def _dimension(star: Star, key: str, wanted: dict[str, list[str]], where: dict[str, Any]) -> DataFrame:
    """The wanted columns of one dimension, regions joined to customers, filters applied."""
    name = next(d for d in FOREIGN_KEY if FOREIGN_KEY[d] == key)
    columns = list(wanted.get(name, []))
    rows = star.gold(name)
    for column in columns:
        if column in where:
            rows = rows.where(condition(column, where[column]))
    if "DimGeography" in wanted:
        regions = star.gold("DimGeography").select(F.col("state").alias("customer_state"), "region")
        for column in wanted["DimGeography"]:
            if column in where:
                regions = regions.where(condition(column, where[column]))
        how = "inner" if any(c in where for c in wanted["DimGeography"]) else "left"
        rows = rows.join(regions, "customer_state", how)
        columns += wanted["DimGeography"]
    return rows.select(key, *columns)

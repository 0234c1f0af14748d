"""Column helpers. All are built-in expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_lower(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def clean_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def safe_timestamp(c: Column | str) -> Column:
    """Text to zoneless timestamp; NULL where the text is not one."""
    return _col(c).try_cast("timestamp_ntz")


def money(c: Column | str) -> Column:
    """Strict: text that is not a number fails the job."""
    return _col(c).cast("decimal(12,2)")


def total_money(c: Column | str) -> Column:
    """Sum of money, wide enough for the totals of trillions of rows."""
    return F.sum(_col(c)).cast("decimal(28,2)")


def date_key(c: Column | str) -> Column:
    """yyyymmdd as an integer, by arithmetic rather than by formatting and parsing text."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed between two points in time."""
    return F.datediff(_col(end), _col(start))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that is NULL, not an error, over zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def bucketize(
    c: Column | str, bins: list[tuple[float | None, str]], null_label: str | None = None
) -> Column:
    """Label by half-open bins ``[previous upper, upper)``; ``None`` as the upper bound is open."""
    c = _col(c)
    label = F.when(c.isNull(), F.lit(null_label))
    for upper, name in bins:
        if upper is None:
            return label.otherwise(F.lit(name))
        label = label.when(c < F.lit(upper), F.lit(name))
    return label

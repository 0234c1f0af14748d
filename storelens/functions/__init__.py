from storelens.functions.columns import (
    bucketize,
    clean_lower,
    clean_upper,
    date_key,
    days_between,
    money,
    ratio,
    safe_timestamp,
    total_money,
)

__all__ = [
    "bucketize",
    "clean_lower",
    "clean_upper",
    "date_key",
    "days_between",
    "money",
    "ratio",
    "safe_timestamp",
    "total_money",
]

from storelens.operators.calendar import calendar, date_bounds
from storelens.operators.dedup import latest
from storelens.operators.keys import dense_key
from storelens.operators.lookup import lookup
from storelens.operators.periods import (
    cumulative_share,
    month_index,
    share_of_total,
    shifted,
    to_date,
    trailing,
)
from storelens.operators.topn import top_n

__all__ = [
    "calendar",
    "cumulative_share",
    "date_bounds",
    "dense_key",
    "latest",
    "lookup",
    "month_index",
    "share_of_total",
    "shifted",
    "to_date",
    "top_n",
    "trailing",
]

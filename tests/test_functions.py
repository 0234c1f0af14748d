from datetime import datetime

import pytest
from pyspark.sql import functions as F

from storelens.functions import bucketize, clean_lower, clean_upper, date_key, days_between, money, ratio, safe_timestamp
from storelens.schemas import DELIVERY_BINS, UNKNOWN_WEIGHT, WEIGHT_BUCKETS


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_text_is_trimmed_and_cased(spark):
    assert column(spark, [" Delivered ", "BOLETO ", None], "string", clean_lower) == ["delivered", "boleto", None]
    assert column(spark, [" sao paulo"], "string", clean_upper) == ["SAO PAULO"]


def test_unreadable_timestamps_become_null(spark):
    got = column(spark, ["", "2017-13-40", "2017-11-24 23:00:01", None], "string", safe_timestamp)
    assert got == [None, None, datetime(2017, 11, 24, 23, 0, 1), None]


def test_price_that_is_no_number_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["12,50"], "string", money)


def test_date_key(spark):
    got = column(spark, [datetime(2016, 2, 29, 23, 59), None], "timestamp_ntz", date_key)
    assert got == [20160229, None]


def test_days_between_counts_midnights(spark):
    df = spark.createDataFrame(
        [(datetime(2017, 11, 24, 23), datetime(2017, 11, 25, 1)), (datetime(2017, 11, 24), None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(days_between("a", "b")).collect()] == [1, None]


def test_ratio_over_zero_is_null(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [0.25, None, None]


def test_weight_buckets(spark):
    weights = [None, 0, 499, 500, 1999, 2000, 9999, 10000]
    got = column(spark, weights, "int", lambda c: bucketize(c, WEIGHT_BUCKETS, UNKNOWN_WEIGHT))
    assert got == ["unknown", "0-500g", "0-500g", "500g-2kg", "500g-2kg", "2-10kg", "2-10kg", "10kg+"]


def test_delivery_bins(spark):
    got = column(spark, [-1, 0, 5, 10, 15, 30, None], "int", lambda c: bucketize(c, DELIVERY_BINS))
    assert got == ["<0", "0-5", "5-10", "10-15", "15-30", "30+", None]

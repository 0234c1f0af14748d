from __future__ import annotations

import random
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from storelens.operators import (
    calendar,
    cumulative_share,
    date_bounds,
    dense_key,
    latest,
    share_of_total,
    shifted,
    to_date,
    top_n,
    trailing,
)
from tests.conftest import plan_of, values

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)


@SLOW
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 2), st.one_of(st.none(), st.sampled_from("abc"))), max_size=30
    )
)
def test_latest_matches_brute_force(spark, rows):
    schema = "k int, _ingested_at int, v string"
    best: dict[int, tuple] = {}
    for k, t, v in rows:
        rank = (-t, v is not None, v or "")
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, t, v))
    expected = sorted((row for _, row in best.values()), key=repr)
    df = spark.createDataFrame(rows, schema)
    assert values(latest(df, ["k"])) == expected
    assert values(latest(df.repartition(5), ["k"])) == expected


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("_ingested_at")
    )
    kept = latest(df, ["k"])
    plan = plan_of(kept)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert kept.where("k = 7").collect()[0]["_ingested_at"] == 2997
    assert kept.count() == 2000 + (7 % 3 == 0)


@SLOW
@given(keys=st.lists(st.one_of(st.none(), st.text("abcxyz0189", max_size=4)), max_size=60))
def test_dense_key_is_the_dense_rank(spark, keys):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    got = {r["i"]: r["key"] for r in dense_key(df.repartition(3), "k", "key").collect()}
    ranks = {k: n for n, k in enumerate(sorted({k for k in keys if k is not None}), 1)}
    assert got == {i: ranks.get(k) for i, k in enumerate(keys)}


def test_dense_key_on_many_uneven_keys(spark):
    random.seed(5)
    # Most keys share a long prefix and a third of the rows share one key.
    keys = [f"same-prefix-{random.randrange(10**6):06d}" for _ in range(4000)] + ["same-prefix-hot"] * 2000
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    got = dense_key(df, "k", "key")
    expected = df.withColumn("key", F.dense_rank().over(Window.orderBy("k")).cast("bigint"))
    assert values(got.select("k", "key")) == values(expected.select("k", "key"))


def test_dense_key_of_unique_rows_keeps_the_columns(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "k string, v int")
    got = dense_key(df, "k", "key", unique=True)
    assert got.columns == ["key", "k", "v"]
    assert values(got) == values(spark.createDataFrame([(1, "a", 2), (2, "b", 1), (None, None, 3)], got.schema))


def test_only_the_slice_counts_meet_in_one_task(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    plan = plan_of(dense_key(df, "k", "key", unique=True))
    single = plan.index("SinglePartition")
    assert plan.count("SinglePartition") == 1
    assert "HashAggregate(keys=[_slice" in plan[single:]


def test_calendar(spark):
    days = calendar(date_bounds(spark, date(2016, 1, 1), date(2019, 12, 31))).cache()
    assert days.count() == 1461
    rows = {r["date_key"]: r for r in days.where("date_key in (20160101, 20160229, 20170826, 20170827, 20191231)").collect()}
    first = rows[20160101]
    assert (first.year, first.quarter, first.month, first.day) == (2016, 1, 1, 1)
    assert (first.month_name, first.day_name, first.day_of_week) == ("January", "Friday", 6)
    assert (first.week_of_year, first.day_of_year, first.is_weekend) == (53, 1, False)
    assert (first.year_quarter, first.year_month) == ("2016-Q1", "2016-01")
    assert rows[20160229].day_of_year == 60
    assert (rows[20170826].day_of_week, rows[20170826].is_weekend) == (7, True)
    assert (rows[20170827].day_of_week, rows[20170827].is_weekend) == (1, True)
    assert (rows[20191231].day_of_year, rows[20191231].year_quarter) == (365, "2019-Q4")


def test_shifted_leaves_gaps_blank(spark):
    # Months 1, 2 and 4: month 4 has no earlier value, and month 3 and 5 only an earlier one.
    df = spark.createDataFrame([(1, 10), (2, 20), (4, 40)], "p int, v int")
    got = values(shifted(df, "p", 1, "v", "before"))
    assert got == sorted([(1, 10, None), (2, 20, 10), (3, None, 20), (4, 40, None), (5, None, 40)], key=repr)


def test_to_date_restarts(spark):
    df = spark.createDataFrame([(2017, 1, 5), (2017, 2, 0), (2018, 1, 7)], "y int, m int, v int")
    assert [r[-1] for r in to_date(df, ["y"], "m", "v", "run").orderBy("y", "m").collect()] == [5, 5, 7]


def test_trailing_counts_the_current_day(spark):
    days = [(date(2017, 1, d), 1) for d in range(1, 32)] + [(date(2017, 3, 1), 5), (date(2017, 3, 2), 0)]
    df = spark.createDataFrame(days, "d date, v int")
    got = {r["d"]: r["total"] for r in trailing(df, "d", 30, "v", "total").collect()}
    assert got[date(2017, 1, 30)] == 30 and got[date(2017, 1, 31)] == 30
    # Thirty days back from 1 March begin on 31 January, from 2 March on 1 February.
    assert got[date(2017, 3, 1)] == 6 and got[date(2017, 3, 2)] == 5


def test_cumulative_share_takes_ties_together(spark):
    df = spark.createDataFrame([("a", 50), ("b", 20), ("c", 20), ("d", 10)], "c string, v int")
    got = {r["c"]: r["s"] for r in cumulative_share(df, "v", "s").collect()}
    assert got == {"a": 0.5, "b": 0.9, "c": 0.9, "d": 1.0}


def test_share_of_total_within_a_group(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "a", 5)], "y int, c string, v int")
    got = {(r["y"], r["c"]): r["s"] for r in share_of_total(df, "v", "s", ["y"]).collect()}
    assert got == {(1, "a"): 0.25, (1, "b"): 0.75, (2, "a"): 1.0}
    assert {r["s"] for r in share_of_total(df.where("v = 3"), "v", "s").collect()} == {1.0}


def test_top_n_settles_ties_and_never_sorts_everything(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, v int")
    top = top_n(df, F.col("v").desc(), 2, ["k"])
    assert [r["k"] for r in top.collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_a_missing_shared_folder_is_refused_on_a_cluster(monkeypatch):
    from storelens import session

    class Context:
        master, applicationId = "spark://somewhere", "app"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_the_named_shared_folder_is_used():
    from storelens import session

    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert session.shared_dir(Session()) == "hdfs://shared"

from __future__ import annotations

import logging
from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest

from storelens.plans import gold, marts, pipeline, quality, reports, silver, timeline, vocabulary
from storelens.plans.metrics import report
from storelens.schemas import GOLD, RAW, REGIONS, SILVER
from storelens.sources import ingest, ingest_all, load_jdbc, overwrite, register, stamp
from tests.conftest import plan_of, values
from tests.retail import ROWS, write_csv

RUN = datetime(2024, 5, 1, 12, 0, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("retail")
    built = pipeline.run(spark, str(write_csv(folder / "csv")), str(folder / "out"), RUN)
    built.lake = str(folder / "out")
    return built


def by(df, key: str) -> dict:
    return {r[key]: r for r in df.collect()}


# Sources


def test_csv_text_may_hold_commas_quotes_and_line_breaks(spark, tmp_path):
    src = write_csv(tmp_path)
    rows = ingest(spark, f"{src}/order_reviews.csv", RAW["order_reviews"], "reviews.csv", RUN, multi_line=True)
    assert rows.count() == len(ROWS["order_reviews"])
    first = rows.where("review_id = 'r1'").collect()[0]
    assert first["review_comment_message"] == 'Good, "very" good\nand fast'
    assert first["_source_file"] == "reviews.csv" and first["_ingested_at"] == datetime(2024, 5, 1, 12)


def test_a_line_break_where_none_belongs_fails(spark, tmp_path):
    src = write_csv(tmp_path, {"sellers": [["s1", "1001", "sao\npaulo", "SP"]]})
    with pytest.raises(Exception, match="MALFORMED"):
        ingest(spark, f"{src}/sellers.csv", RAW["sellers"], None, RUN).collect()


def test_csv_that_does_not_fit_its_types_fails(spark, tmp_path):
    bad = {"order_payments": [["o1", "1", "boleto", "one", "3.00"]]}
    src = write_csv(tmp_path, bad)
    with pytest.raises(Exception, match="MALFORMED"):
        ingest(spark, f"{src}/order_payments.csv", RAW["order_payments"], None, RUN).collect()


def test_the_file_names_itself_when_no_source_is_given(spark, tmp_path):
    src = write_csv(tmp_path)
    rows = ingest(spark, f"{src}/sellers.csv", RAW["sellers"], None, RUN)
    assert {r["_source_file"] for r in rows.collect()} == {"sellers.csv"}


def test_a_missing_source_is_skipped_and_logged(spark, tmp_path, caplog):
    src = write_csv(tmp_path / "csv", {"sellers": ROWS["sellers"]})
    with caplog.at_level(logging.WARNING):
        written = ingest_all(spark, str(src), str(tmp_path / "out"), RUN)
    assert list(written) == ["sellers"]
    assert "skip orders" in caplog.text


def test_file_names_can_be_given(spark, tmp_path):
    src = write_csv(tmp_path / "csv", {"sellers": ROWS["sellers"]})
    (src / "sellers.csv").rename(src / "vendors_2018.csv")
    written = ingest_all(spark, str(src), str(tmp_path / "out"), RUN, files={"sellers": "vendors_2018.csv"})
    assert spark.read.parquet(written["sellers"]).first()["_source_file"] == "vendors_2018.csv"


def test_a_second_ingest_is_a_new_partition(spark, tmp_path):
    src, out = str(write_csv(tmp_path / "csv", {"sellers": ROWS["sellers"]})), str(tmp_path / "out")
    ingest_all(spark, src, out, RUN, partitioned=True)
    ingest_all(spark, src, out, datetime(2024, 5, 2, tzinfo=timezone.utc), partitioned=True)
    rows = spark.read.parquet(f"{out}/sellers")
    assert rows.count() == 2 * len(ROWS["sellers"])
    assert rows.where("_ingest_date = '2024-05-01'").count() == len(ROWS["sellers"])
    kept = silver.sellers(rows.drop("_ingest_date"))
    assert kept.count() == len(ROWS["sellers"])


def test_load_replaces_the_table_and_orders_the_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 9)], "x int, y string, z int")
    assert overwrite(df.union(df), path, ["y", "x"]) == 2
    assert overwrite(df, path, ["y", "x"]) == 1
    assert spark.read.parquet(path).columns == ["y", "x"]


def test_partitioned_load(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id", "cast(id % 4 as int) as part")
    assert overwrite(df, path, ["id"], ["part"]) == 100
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == [f"part={i}" for i in range(4)]


def test_stamp_fills_in_what_is_missing(spark):
    df = spark.createDataFrame([(1, datetime(2000, 1, 1))], "x int, _ingested_at timestamp")
    row = stamp(df, "x.csv").first()
    assert row["_source_file"] == "x.csv" and row["_ingested_at"].year > 2000
    named = spark.createDataFrame([(1, "own.csv")], "x int, _source_file string")
    assert stamp(named, "x.csv").first()["_source_file"] == "own.csv"


def test_registered_tables_answer_sql(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    register(spark, {"registered_rows": str(tmp_path / "t")})
    assert spark.sql("select sum(id) from registered_rows").first()[0] == 3


def test_jdbc_load_truncates_and_batches(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: seen.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, m: seen.update(mode=m) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(columns=self._df.columns))
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    load_jdbc(df, "jdbc:somewhere", "bronze.t", ["b", "a"], {"numPartitions": "4"})
    assert seen["truncate"] == "true" and seen["batchsize"] == "10000" and seen["mode"] == "overwrite"
    assert seen["columns"] == ["b", "a"] and seen["numPartitions"] == "4"


# Silver


def test_silver_orders(built):
    rows = by(built.silver("orders"), "order_id")
    assert len(rows) == 6
    assert {rows[o]["order_status"] for o in ("o1", "o2", "o3")} == {"delivered"}
    assert rows["o1"]["order_approved_ts"] is None and rows["o2"]["order_approved_ts"] is None
    assert rows["o3"]["order_approved_ts"] == datetime(2018, 1, 10, 11)
    # Both copies were taken in at the same time; the remaining columns decide.
    assert rows["o6"]["order_status"] == "invoiced"


def test_silver_payments_keep_repeated_keys(built):
    rows = built.silver("order_payments")
    assert rows.count() == 5
    assert {r["payment_type"] for r in rows.collect()} == {"credit_card", "boleto", "voucher"}


def test_silver_reviews_keep_one_row_per_review(built):
    rows = by(built.silver("order_reviews"), "review_id")
    assert sorted(rows) == ["r1", "r2", "r3", "r4"]
    assert rows["r3"]["order_id"] == "o3"
    assert rows["r4"]["review_answer_ts"] is None


def test_silver_products_fall_back_and_do_not_multiply(built):
    rows = by(built.silver("products"), "product_id")
    assert len(rows) == len(ROWS["products"])
    assert rows["p1"]["category_en"] == "bed_bath_table"
    assert rows["p2"]["category_en"] == "sem_traducao"
    assert rows["p3"]["category_pt"] is None and rows["p3"]["category_en"] == "unknown"


def test_silver_places_are_cleaned(built):
    assert by(built.silver("sellers"), "seller_id")["s1"]["seller_city"] == "SAO PAULO"
    assert by(built.silver("customers"), "customer_id")["c3"]["customer_city"] == "SALVADOR"


def test_silver_geolocation_is_the_centre(built):
    row = by(built.silver("geolocation"), "zip_prefix")[1000]
    assert (row["lat"], row["lng"]) == (-23.55, -46.6)
    assert (row["city"], row["state"]) == ("SÃO PAULO", "SP")


def test_silver_price_that_is_no_number_fails(spark):
    schema = "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price string, freight_value string, _ingested_at timestamp"
    df = spark.createDataFrame([("o", 1, "p", "s", "", "ten", "1.00", RUN)], schema)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.order_items(df).collect()


# Gold


def test_dim_customer_is_one_row_per_person(built):
    rows = by(built.gold("DimCustomer"), "customer_unique_id")
    assert [rows[u]["customer_key"] for u in ("u1", "u2", "u3", "u4")] == [1, 2, 3, 4]
    assert (rows["u1"]["customer_zip_prefix"], rows["u1"]["customer_state"]) == (3000, "BA")
    assert (rows["u1"]["n_orders_per_unique"], rows["u1"]["is_repeat_customer"]) == (3, True)
    assert (rows["u2"]["n_orders_per_unique"], rows["u2"]["is_repeat_customer"]) == (1, False)


def test_bridge_leads_every_id_to_its_person(built):
    pairs = {r["customer_id"]: r["customer_key"] for r in built.gold("_bridge_customer").collect()}
    assert pairs == {"c1": 1, "c2": 1, "c3": 1, "c4": 2, "c5": 3, "c6": 4}


def test_dim_product_buckets(built):
    rows = by(built.gold("DimProduct"), "product_id")
    assert [rows[f"p{i}"]["weight_bucket"] for i in range(1, 8)] == [
        "0-500g",
        "500g-2kg",
        "unknown",
        "500g-2kg",
        "2-10kg",
        "2-10kg",
        "10kg+",
    ]
    assert [rows[f"p{i}"]["product_key"] for i in range(1, 8)] == list(range(1, 8))


def test_dim_geography(built):
    rows = {r["state"]: r["region"] for r in built.gold("DimGeography").collect()}
    assert rows == {"AM": "North", "BA": "Northeast", "RJ": "Southeast", "SP": "Southeast", "ZZ": "Unknown"}


def test_all_states_have_their_region(spark):
    states = spark.createDataFrame([(s,) for s in [*REGIONS, "XX", None]], "customer_state string")
    sellers = spark.createDataFrame([("SP",)], "seller_state string")
    got = {r["state"]: r for r in gold.dim_geography(states, sellers, gold.region_map(spark)).collect()}
    assert {s: r["region"] for s, r in got.items()} == {**REGIONS, "XX": "Unknown"}
    assert [got[s]["geography_key"] for s in sorted(got)] == list(range(1, 29))
    counts = {r: list(REGIONS.values()).count(r) for r in set(REGIONS.values())}
    assert counts == {"North": 7, "Northeast": 9, "Central-West": 4, "Southeast": 4, "South": 3}


def test_dim_date_spans_the_default_calendar(built):
    days = built.gold("DimDate")
    assert days.count() == 1461
    assert days.agg({"date": "min"}).first()[0] == date(2016, 1, 1)


def test_fact_order_items(built):
    rows = {(r["order_id"], r["order_item_id"]): r for r in built.star("FactOrderItems").collect()}
    # The line of an unknown order is gone, the one of an unknown product and seller stays.
    assert len(rows) == 7 and ("o9", 1) not in rows
    assert rows["o5", 1]["product_key"] is None and rows["o5", 1]["seller_key"] is None
    first = rows["o1", 1]
    assert (first["purchase_date_key"], first["delivered_date_key"], first["estimated_date_key"]) == (
        20171124,
        20171125,
        20171201,
    )
    assert (first["delivery_days"], first["delivery_vs_estimate_days"], first["on_time_flag"]) == (1, -6, 1)
    assert first["total_value"] == Decimal("110.00") and first["customer_key"] == 1
    assert rows["o2", 1]["on_time_flag"] == 1
    assert (rows["o3", 1]["on_time_flag"], rows["o3", 1]["delivery_vs_estimate_days"]) == (0, 0)
    assert (rows["o4", 1]["delivery_days"], rows["o4", 1]["on_time_flag"]) == (None, 0)


def test_facts_have_the_published_columns(built):
    assert built.star("FactPayments").columns == [
        "order_id",
        "payment_sequential",
        "purchase_date_key",
        "customer_key",
        "payment_type",
        "payment_installments",
        "payment_value",
    ]
    assert built.star("FactPayments").count() == 4
    reviews = by(built.star("FactReviews"), "review_id")
    assert reviews["r1"]["response_days"] == 2 and reviews["r2"]["response_days"] == 0
    assert reviews["r3"]["response_days"] == 1 and reviews["r4"]["response_days"] is None


def test_the_star_answers_sql(spark, built):
    built.register()
    asked = spark.sql("""
        SELECT p.category_en, ROUND(SUM(f.total_value), 2) AS gmv
        FROM FactOrderItems f
        JOIN DimProduct p ON f.product_key = p.product_key
        JOIN DimDate d ON f.purchase_date_key = d.date_key
        WHERE d.year = 2017 GROUP BY p.category_en ORDER BY gmv DESC LIMIT 5
    """)
    assert values(asked) == values(reports.top_categories(built, 5, {"year": 2017}))


def test_row_counts(built):
    counts = gold.row_counts({n: built.gold(n) for n in GOLD if n[0] != "_"})
    assert {r["table"]: r["rows"] for r in counts.collect()} == {
        "DimDate": 1461,
        "DimCustomer": 4,
        "DimProduct": 7,
        "DimSeller": 2,
        "DimGeography": 5,
        "FactOrderItems": 7,
        "FactPayments": 4,
        "FactReviews": 4,
    }


def test_two_builds_agree(spark, built, tmp_path):
    bronze = {n: f"{built.root}/bronze/{n}" for n in RAW}
    again = pipeline.open_bronze(spark, bronze, str(tmp_path / "again"))
    again.partitioned = True
    again.build_silver()
    again.build_gold()
    for name in SILVER:
        assert quality.reconcile(built.silver(name), again.silver(name)).count() == 0, name
    for name in GOLD:
        assert quality.reconcile(built.star(name), again.star(name)).count() == 0, name
    folders = {p.name for p in (tmp_path / "again/gold/FactOrderItems").glob("purchase_year=*")}
    assert folders == {"purchase_year=2017", "purchase_year=2018"}


def test_a_year_filter_prunes_the_folders_of_a_partitioned_fact(spark, built, tmp_path):
    bronze = {n: f"{built.root}/bronze/{n}" for n in RAW}
    parted = pipeline.open_bronze(spark, bronze, str(tmp_path / "parted"))
    parted.partitioned = True
    for star in (built, parted):
        got = report(star, ["gmv"], where={"year": 2017})
        assert got.first()["gmv"] == Decimal("253.50")
    plan = plan_of(report(parted, ["gmv"], ["year_month"], {"year": 2017}))
    assert "dynamicpruning" in plan
    assert "ReadSchema: struct<purchase_date_key:int,total_value:decimal(12,2)>" in plan
    assert timeline.in_month(parted).agg({"total_value": "sum"}).first()[0] == Decimal("55.00")
    assert "PartitionFilters: [isnotnull(purchase_year" in plan_of(timeline.in_month(parted))


def test_another_session_opens_the_lake_without_a_write(spark, built):
    def files():
        return {(p, p.stat().st_mtime_ns) for p in Path(built.root).rglob("*.parquet")}

    before = files()
    lake = pipeline.open_lake(spark.newSession(), built.lake)
    assert lake.star("FactOrderItems").count() == built.star("FactOrderItems").count()
    assert report(lake, ["gmv"]).first() == report(built, ["gmv"]).first()
    assert files() == before
    with pytest.raises(FileNotFoundError):
        pipeline.open_lake(spark, f"{built.root}/bronze")


def test_orders_outside_the_calendar_stop_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="outside the calendar"):
        pipeline.run(spark, str(write_csv(tmp_path / "csv")), str(tmp_path / "out"), RUN, calendar=(date(2016, 1, 1), date(2017, 12, 31)))


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    (folder / "a.csv").write_text("seller_zip_code_prefix,note,seller_id,seller_state,seller_city\n12345,x,77,SP,campinas\n")
    row = ingest(spark, str(folder), RAW["sellers"], None, RUN).first()
    assert (row.seller_id, row.seller_city, row.seller_state) == ("77", "campinas", "SP")
    (folder / "b.csv").write_text("seller_id,seller_zip_code_prefix,note,seller_state,seller_city\n1,2,x,SP,campinas\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest(spark, str(folder), RAW["sellers"], None, RUN).collect()
    (tmp_path / "short.csv").write_text("seller_id,seller_state\n1,SP\n")
    with pytest.raises(ValueError, match="seller_city"):
        ingest(spark, str(tmp_path / "short.csv"), RAW["sellers"], None, RUN)


def test_missing_bronze_stops_the_run(spark, tmp_path):
    src = write_csv(tmp_path / "csv", {"sellers": ROWS["sellers"]})
    with pytest.raises(FileNotFoundError, match="customers"):
        pipeline.run(spark, str(src), str(tmp_path / "out"), RUN)


# Reports


def test_report_without_grouping_is_one_row(built):
    row = report(built, ["gmv", "order_count", "total_payments", "average_order_value"]).collect()
    assert len(row) == 1
    assert (row[0]["gmv"], row[0]["order_count"], row[0]["total_payments"]) == (
        Decimal("363.50"),
        6,
        Decimal("275.50"),
    )
    assert row[0]["average_order_value"] == 363.5 / 6


def test_groups_of_one_fact_only_keep_their_row(built):
    rows = by(report(built, ["gmv", "total_payments"], ["year_month"]), "year_month")
    assert rows["2018-03"]["total_payments"] is None and rows["2018-03"]["gmv"] == Decimal("55.00")


def test_rows_without_a_dimension_count_under_null(built):
    rows = by(report(built, ["gmv"], ["category_en"]), "category_en")
    assert rows[None]["gmv"] == Decimal("44.00")
    kept = by(report(built, ["gmv"], ["category_en"], {"category_en": ["unknown", "health_beauty"]}), "category_en")
    assert set(kept) == {"unknown", "health_beauty"}


def test_a_measure_with_its_own_status_replaces_a_status_filter(built):
    row = report(built, ["order_count", "delivered_orders"], where={"order_status": "shipped"}).first()
    assert (row["order_count"], row["delivered_orders"]) == (1, 3)


def test_a_measure_with_its_own_status_shows_the_same_in_every_status(built):
    rows = by(report(built, ["order_count", "delivered_orders"], ["order_status"]), "order_status")
    assert len(rows) > 1 and {row["delivered_orders"] for row in rows.values()} == {3}
    assert rows["shipped"]["order_count"] == 1


def test_repeat_share_replaces_a_repeat_filter(built):
    row = report(built, ["active_customers", "repeat_customers"], where={"is_repeat_customer": False}).first()
    assert (row["active_customers"], row["repeat_customers"]) == (3, 1)


def test_reports_refuse_a_path_that_is_not_active(built):
    with pytest.raises(ValueError, match="no active path"):
        report(built, ["avg_review_score"], ["category_en"])
    with pytest.raises(ValueError, match="neither"):
        report(built, ["gmv"], ["colour"])
    with pytest.raises(ValueError, match="delivered date"):
        report(built, ["total_payments"], ["year"], date_role="delivered")


def test_the_delivered_date_is_the_other_role(built):
    rows = by(report(built, ["gmv"], ["year_month"], date_role="delivered"), "year_month")
    assert rows["2017-12"]["gmv"] == Decimal("88.00") and rows[None]["gmv"] == Decimal("88.00")


def test_distinct_counts_survive_early_aggregation(built):
    rows = by(report(built, ["order_count", "gmv", "active_customers"], ["region"]), "region")
    assert (rows["Northeast"]["order_count"], rows["Northeast"]["active_customers"]) == (3, 1)
    assert rows["Northeast"]["gmv"] == Decimal("275.50")
    sellers = by(report(built, ["order_count", "gmv"], ["seller_id"]), "seller_id")
    assert (sellers["s1"]["order_count"], sellers["s2"]["order_count"]) == (3, 3)


def test_distinct_counts_by_a_product_column(built):
    names = ["repeat_customers", "active_customers", "order_count", "delivered_orders", "gmv"]
    rows = by(report(built, names, ["category_en"]), "category_en")
    # Bedding was bought in o1 and o2 by one repeat buyer and in o4 by someone else.
    bedding = rows["bed_bath_table"]
    assert [bedding[n] for n in names] == [1, 2, 3, 2, Decimal("231.00")]
    both = by(report(built, names, ["category_en", "region"]), "region")
    assert [both["North"][n] for n in names] == [0, 1, 1, 0, Decimal("33.00")]


def test_several_distinct_counts_do_not_multiply_rows(built):
    plan = plan_of(report(built, ["order_count", "delivered_orders", "canceled_orders", "active_customers"]))
    assert "Expand" not in plan


def test_nothing_staged_is_left_behind(spark, built):
    from pathlib import Path

    from storelens.session import application_dir

    assert not list(Path(application_dir(spark), "staged").glob("*/rank-customer_key*"))


def test_new_customers_ignore_the_filter_on_their_history(built):
    rows = by(timeline.new_customers(built, ["year_month"]), "year_month")
    assert {m: r["new_customers"] for m, r in rows.items()} == {"2017-11": 1, "2018-01": 1, "2018-03": 2}
    assert timeline.new_customers(built, [], {"year": 2018}).first()["new_customers"] == 3
    assert timeline.new_customers(built, [], {"year": 2019}).first()["new_customers"] == 0


def test_new_and_returning(built):
    rows = by(timeline.new_and_returning(built), "year_month")
    assert (rows["2018-01"]["new_customers"], rows["2018-01"]["returning_customers"]) == (1, 1)


def test_time_intelligence_over_gaps(built):
    ytd = {m: r["gmv_ytd"] for m, r in by(timeline.gmv_ytd(built), "year_month").items()}
    assert ytd["2017-10"] == 0 and ytd["2017-12"] == Decimal("253.50")
    assert ytd["2018-02"] == Decimal("55.00") and ytd["2018-12"] == Decimal("110.00") and ytd["2019-01"] == 0
    assert len(ytd) == 48
    ly = by(timeline.gmv_ly(built), "year_month")
    assert (ly["2018-11"]["gmv"], ly["2018-11"]["gmv_ly"]) == (None, Decimal("253.50"))
    mom = {m: r["gmv_mom_pct"] for m, r in by(timeline.gmv_mom(built), "year_month").items()}
    assert mom["2018-03"] is None and mom["2017-11"] is None and mom["2018-02"] is None
    rolling = {m: r["gmv_rolling_30d"] for m, r in by(timeline.gmv_rolling(built), "year_month").items()}
    # 2 December to 31 December 2017 holds nothing; 30 days to 28 February 2018 start on 30 January.
    assert rolling["2017-12"] == 0 and rolling["2018-02"] == Decimal("33.00")


def test_relative_periods_count_from_the_last_purchase(built):
    sales = {t: reports.period_sales(rows(built)).first() for t, rows in vocabulary.PERIODS.items()}
    assert sales["this month"]["gmv"] == Decimal("55.00")
    assert sales["last month"]["gmv"] is None and sales["last month"]["order_count"] == 0
    assert sales["year to date"]["gmv"] == Decimal("110.00")
    assert sales["last 30 days"]["order_count"] == 2
    import pyspark.sql.functions as F

    january = timeline.in_month(built, day=F.lit(date(2018, 1, 31)))
    assert january.count() == 2
    december = timeline.in_month(built, 1, F.lit(date(2018, 1, 31)))
    assert december.count() == 0
    # Thirty days before 9 February are counted as well: 31 days in all.
    assert timeline.last_days(built, 30, F.lit(date(2018, 2, 9))).count() == 2
    assert timeline.last_days(built, 30, F.lit(date(2018, 2, 10))).count() == 1


def test_reviews_weigh_by_item(built):
    rows = by(reports.category_reviews(built), "category_en")
    # o1 has reviews 5 and 3 and two items, one of them bedding; o2 one review of 4 on bedding.
    assert rows["bed_bath_table"]["avg_review_score"] == (5 + 3 + 4) / 3
    assert rows["bed_bath_table"]["items_sold"] == 3
    assert rows["sem_traducao"]["avg_review_score"] == 4.0
    shares = by(reports.five_star_share(built, at_least=2), "category_en")
    assert shares["sem_traducao"]["five_star_pct"] == 0.5 and "unknown" not in shares


def test_slowest_sellers(built):
    rows = reports.slowest_sellers(built, n=1, at_least=1).collect()
    assert [r["seller_id"] for r in rows] == ["s1"]
    assert rows[0]["avg_delivery_days"] == (1 + 10 + 10) / 3
    assert reports.slowest_sellers(built, at_least=10).count() == 0


def test_questions(built):
    assert reports.worst_state(built).first()["on_time_delivery_pct"] == 0.75
    assert values(reports.cancellations_by_state(built)) == [("AM", 1)]
    assert reports.late_rate(built, "BA").first()["late_items"] == 0
    mix = by(reports.payment_mix(built), "payment_type")
    assert set(mix) == {"credit_card", "boleto"} and mix["boleto"]["average_basket"] == 88.0
    assert by(reports.repeat_by_region(built), "region")["Northeast"]["repeat_customer_pct"] == 1.0
    assert reports.single_order_customers(built).first()[0] == 3
    assert reports.repeat_share(built).first()[0] == 0.25
    top = reports.top_sellers(built, 1, {"year": 2017}).first()
    assert (top["seller_id"], top["seller_state"]) == ("s1", "SP")


def test_pareto_ends_at_one(built):
    rows = timeline.pareto(built).orderBy("category_rank").collect()
    assert rows[-1]["cumulative_gmv_pct"] == 1.0 and rows[0]["category_rank"] == 1


def test_rollup_levels(built):
    rows = reports.rollup_of(built, reports.HIERARCHIES["date"]).collect()
    totals = [r for r in rows if r["level_id"] == 15]
    assert len(totals) == 1 and totals[0]["gmv"] == Decimal("363.50")
    assert {r["year"]: r["gmv"] for r in rows if r["level_id"] == 7} == {
        2017: Decimal("253.50"),
        2018: Decimal("110.00"),
    }


def test_business_words(built):
    got = vocabulary.answer(built, ["revenue", "order count"], filters=["black friday", "home textiles"]).first()
    assert (got["gmv"], got["order_count"]) == (Decimal("198.00"), 2)
    assert vocabulary.answer(built, ["late delivery"]).first()["late_items"] == 0
    months = by(vocabulary.answer(built, ["new customers", "revenue"], ["month"]), "year_month")
    assert (months["2018-03"]["new_customers"], months["2018-03"]["gmv"]) == (2, Decimal("55.00"))
    plans = by(vocabulary.answer(built, ["payments"], ["installments"]), "payment_installments")
    assert plans[3]["total_payments"] == Decimal("165.50")


def test_snapshot(spark, built, tmp_path):
    written = marts.write(built, str(tmp_path), 2017)
    assert set(written) == set(marts.SNAPSHOT)
    kpis = spark.read.parquet(written["executive_kpis"]).first()
    assert kpis["gmv"] == Decimal("253.50") and kpis["gmv_ly"] is None and kpis["gmv_yoy_pct"] is None
    again = marts.write(built, str(tmp_path), 2018, {"executive_kpis": marts.SNAPSHOT["executive_kpis"]})
    assert spark.read.parquet(again["executive_kpis"]).first()["gmv_ly"] == Decimal("253.50")
    assert again["pareto"] == written["pareto"] and marts.paths(spark, str(tmp_path)) == again
    # Who holds the first snapshot still reads it.
    assert spark.read.parquet(written["executive_kpis"]).first()["gmv_ly"] is None


def test_a_snapshot_that_fails_leaves_the_last_one(spark, built, tmp_path):
    written = marts.write(built, str(tmp_path), 2017, {"pareto": marts.SNAPSHOT["pareto"]})
    with pytest.raises(ZeroDivisionError):
        marts.write(built, str(tmp_path), 2017, {"pareto": marts.SNAPSHOT["pareto"], "broken": lambda star, year: 1 / 0})
    assert marts.paths(spark, str(tmp_path)) == written


# Quality


def test_quality_jobs_on_the_build(built):
    def read(layer, name):
        return built.silver(name) if layer == "silver" else built.gold(name)

    keys = {r["table"]: r for r in quality.all_pk_violations(read).where("key_columns <> 'state'").collect()}
    assert {t for t, r in keys.items() if r["violating_keys"]} == {"silver.order_payments", "gold.FactPayments"}
    assert keys["silver.order_payments"]["surplus_rows"] == 1
    assert sum(r["nulls"] for r in quality.all_null_counts(read).collect()) == 0
    assert {r["orphan_rows"] for r in quality.all_orphans(read).collect()} == {0}
    diff = by(quality.payments_vs_gmv(read), "order_id")
    assert diff["o1"]["difference"] == 0 and diff["o2"]["difference"] == 0
    assert diff["o4"]["payments"] is None and diff["o4"]["difference"] == Decimal("-33.00")


def test_orphans_and_nulls_are_found(spark):
    many = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    one = spark.createDataFrame([(1,)], "k int")
    row = quality.orphans(many, "k", one, "k", "many", "one").first()
    assert (row["orphan_keys"], row["orphan_rows"]) == (1, 2)
    assert values(quality.null_counts(many, "many", ["k"])) == [("many", "k", 1)]


def test_reconcile_sees_repeated_rows(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert values(quality.reconcile(a, b)) == [(1, "left"), (3, "right")]


def test_profiles(spark, built):
    bronze = spark.read.parquet(f"{built.root}/bronze/orders")
    row = quality.dedup_profile(bronze, built.silver("orders"), "orders").first()
    assert (row["bronze_rows"], row["silver_rows"], row["kept_share"]) == (7, 6, 6 / 7)
    failures = quality.cast_failures(bronze, ["order_approved_at", "order_purchase_timestamp"], "orders")
    assert values(failures) == [("orders", "order_approved_at", 1), ("orders", "order_purchase_timestamp", 0)]


def test_layer_counts_roll_up(spark):
    three = [("a", "x", spark.range(2)), ("a", "y", spark.range(3)), ("b", "z", spark.range(4))]
    rows = {(r["layer"], r["table"]): r["rows"] for r in quality.layer_row_counts(three).collect()}
    assert rows["a", None] == 5 and rows[None, None] == 9 and rows["b", "z"] == 4


# Plans


def test_no_gold_build_gathers_rows_in_one_task(built):
    for name in GOLD:
        if name == "DimDate":
            continue
        plan = plan_of(built.gold_plan(name))
        # The one allowed gathering is of the slice counts of the dense key.
        assert plan.count("SinglePartition") <= ("Dim" in name), name


def test_an_empty_review_text_reads_as_null(built):
    rows = by(built.silver("order_reviews"), "review_id")
    assert rows["r2"]["review_comment_message"] is None


def test_a_table_whose_files_are_gone_is_built_again(spark, built, tmp_path):
    from pathlib import Path

    bronze = {n: f"{built.root}/bronze/{n}" for n in RAW}
    star = pipeline.open_bronze(spark, bronze, str(tmp_path / "star"))
    assert star.gold("DimSeller").count() == 2
    Path(tmp_path, "star/gold/DimSeller").rename(tmp_path / "elsewhere")
    assert star.gold("DimSeller").count() == 2

"""Every operator, table, measure and report as a query over the given tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators import dense_key, latest
from storelens.plans import builds, gold, hierarchies, pages, quality, reports, silver, timeline, vocabulary
from storelens.plans.measures import ITEMS
from storelens.plans.metrics import report
from storelens.plans.warehouse import Warehouse
from storelens.schemas import GOLD, SILVER
from storelens.session import application_dir
from storelens.sources import testviews
from storelens.sources.parquet import stamp
from storelens.streaming import delta_since, stream_upsert, upsert
from storelens.streaming.incremental import BUCKET
from storelens.streaming.merge_on_read import LatestTable

Query = Callable[[SparkSession, str], DataFrame]

# What the parametrised reports are asked for.
YEAR, MONTH, MONTH_NAME = 1998, 11, "November"
STATE, REGION, CATEGORY = "NATION_7", "ASIA", "cat_economy"

_warehouses: dict[tuple[str, str], Warehouse] = {}
_guard = Lock()


def warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The written layers of ``root``, shared by all queries of this application."""
    key = (spark.sparkContext.applicationId, root)
    with _guard:
        if key not in _warehouses:
            mark = hashlib.sha256(root.encode()).hexdigest()[:12]
            _warehouses[key] = Warehouse(
                spark,
                f"{application_dir(spark)}/warehouse-{mark}-{uuid.uuid4().hex[:8]}",
                lambda name: testviews.BRONZE[name](spark, root),
                testviews.calendar_bounds(spark, root),
                testviews.region_map(spark, root),
                partitioned=False,  # months of a few kilobytes
            )
        return _warehouses[key]


def _star(make: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, root: make(warehouse(spark, root))


def _by_month(measure: str) -> Query:
    return _star(lambda w: report(w, [measure], ["year_month"]))


def _silver(name: str) -> Query:
    return lambda spark, root: silver.build(name, lambda b: testviews.BRONZE[b](spark, root))


def _gold(name: str) -> Query:
    return _star(lambda w: w.gold_plan(name).drop("purchase_year", "purchase_month"))


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def bronze_audit(spark: SparkSession, root: str) -> DataFrame:
    """Rows per source with the audit columns in place."""
    parts = []
    for name, table in sorted(testviews.SOURCES.items()):
        rows = stamp(testviews.BRONZE[name](spark, root), f"{table}.parquet")
        parts.append(
            rows.groupBy("_source_file")
            .agg(
                F.count("*").alias("rows"),
                F.count("_ingested_at").alias("rows_stamped"),
            )
            .select(F.lit(name).alias("table"), F.col("_source_file").alias("source_file"), "rows", "rows_stamped")
        )
    audit = parts[0]
    for part in parts[1:]:
        audit = audit.unionByName(part)
    return audit


def dense_order_key(spark: SparkSession, root: str) -> DataFrame:
    lines = testviews.order_items(spark, root).select("order_id", "order_item_id")
    return dense_key(lines, "order_id", "order_key")


def dedup_latest(spark: SparkSession, root: str) -> DataFrame:
    return latest(testviews.order_items(spark, root), ["order_id", "order_item_id"])


def _layers(spark: SparkSession, root: str) -> Callable[[str, str], DataFrame]:
    w = warehouse(spark, root)
    return lambda layer, name: w.silver(name) if layer == "silver" else w.gold(name)


def dq_pk_violations(spark: SparkSession, root: str) -> DataFrame:
    """Every declared key, and the item key as it is in bronze."""
    raw = testviews.order_items(spark, root)
    bronze = quality.pk_violations(raw, "bronze.order_items", ("order_id", "order_item_id"))
    return quality.all_pk_violations(_layers(spark, root)).unionByName(bronze)


def dq_layer_profile(spark: SparkSession, root: str) -> DataFrame:
    w = warehouse(spark, root)
    parts = [quality.dedup_profile(testviews.BRONZE[n](spark, root), w.silver(n), n) for n in SILVER]
    profile = parts[0]
    for part in parts[1:]:
        profile = profile.unionByName(part)
    dates = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    failures = quality.cast_failures(testviews.orders(spark, root), dates, "orders")
    return profile.unionByName(failures, allowMissingColumns=True)


def layer_row_counts(spark: SparkSession, root: str) -> DataFrame:
    w = warehouse(spark, root)
    bronze = [("bronze", n, make(spark, root)) for n, make in testviews.BRONZE.items()]
    silvers = [("silver", n, w.silver(n)) for n in SILVER]
    golds = [("gold", n, w.gold(n)) for n in GOLD]
    return quality.layer_row_counts([*bronze, *silvers, *golds])


def dq_two_builds(spark: SparkSession, root: str) -> DataFrame:
    """Item rows in which the written fact and a fresh build of it differ, beside the rows they share."""
    w = warehouse(spark, root)
    written, fresh = w.star(ITEMS), w.gold_plan(ITEMS).drop("purchase_year", "purchase_month")
    apart = quality.reconcile(written, fresh).agg(F.count("*").alias("differing_rows"))
    counts = written.agg(F.count("*").alias("rows_written"))
    again = fresh.agg(F.count("*").alias("rows_again"))
    both = apart.unionByName(counts, True).unionByName(again, True)
    return both.agg(*[F.max(c).alias(c) for c in ("differing_rows", "rows_written", "rows_again")])


def incremental_delta(spark: SparkSession, root: str) -> DataFrame:
    """Items taken in after the last order was placed."""
    last = testviews.raw(spark, root, "orders").agg(F.max("o_orderdate")).scalar()
    return delta_since(testviews.order_items(spark, root), last)


def incremental_upsert(spark: SparkSession, root: str) -> DataFrame:
    """Items merged in two batches, the later half first; then typed as silver."""
    items = testviews.order_items(spark, root)
    first, last = items.agg(F.min("_ingested_at"), F.max("_ingested_at")).first()
    middle = first + (last - first) / 2
    target, staging = _scratch(spark, "items"), _scratch(spark, "merges")
    keys = ["order_id", "order_item_id"]
    upsert(delta_since(items, middle), target, keys, staging, buckets=16)
    upsert(items.where(F.col("_ingested_at") <= F.lit(middle)), target, keys, staging, buckets=16)
    return silver.typed_items(spark.read.schema(items.schema).parquet(target))


def _merged_items(spark: SparkSession, items: DataFrame) -> DataFrame:
    """Items merged as one base and three deltas in no order of time; then typed as silver."""
    table = LatestTable(spark, _scratch(spark, "latest-items"), ["order_id", "order_item_id"])
    # By order and time, so that the versions of one item come in different batches.
    quarter = F.pmod(F.xxhash64("order_id", "_ingested_at"), F.lit(4))
    for n in (2, 0, 3, 1):
        table.merge(items.where(quarter == n), n)
    return silver.typed_items(table.read())


def incremental_deltas(spark: SparkSession, root: str) -> DataFrame:
    return _merged_items(spark, testviews.order_items(spark, root))


def dq_batch_and_deltas(spark: SparkSession, root: str) -> DataFrame:
    """Items as one batch builds them beside the table that grew by deltas, per year of their shipping limit."""
    year = F.year("shipping_limit_ts").alias("year")
    batch = warehouse(spark, root).silver("order_items").select("*", year)
    deltas = _merged_items(spark, testviews.order_items(spark, root)).select("*", year)
    return builds.agreement(batch, deltas, ["order_id", "order_item_id"], ["year"])


def dq_pending_items(spark: SparkSession, root: str) -> DataFrame:
    """The items in which a table without the last delta differs from the batch build."""
    items = testviews.order_items(spark, root)
    last = testviews.raw(spark, root, "orders").agg(F.max("o_orderdate")).first()[0]
    table = _merged_items(spark, items.where(F.col("_ingested_at") <= F.lit(last)))
    found = builds.differing_keys(warehouse(spark, root).silver("order_items"), table, ["order_id", "order_item_id"])
    return found.withColumnsRenamed({"left_rows": "batch_rows", "right_rows": "table_rows"})


def stream_upsert_items(spark: SparkSession, root: str) -> DataFrame:
    """Items streamed from their files and merged batch by batch; then typed as silver."""
    schema = testviews.raw(spark, root, "lineitem").schema
    # A glob: a stream takes a folder or a pattern, not a single file.
    arriving = spark.readStream.schema(schema).parquet(f"{root}/lineitem.parquet*")
    target, checkpoint = _scratch(spark, "items"), _scratch(spark, "stream")
    mapped = testviews.order_items_of(arriving)
    stream_upsert(mapped, target, ["order_id", "order_item_id"], checkpoint, buckets=16).awaitTermination()
    return silver.typed_items(spark.read.parquet(target).drop(BUCKET))


def gmv_by_delivered_month(w: Warehouse) -> DataFrame:
    rows = report(w, ["gmv"], ["year_month"], date_role="delivered")
    return rows.where(F.col("year_month").isNotNull())


def weekend_gmv(w: Warehouse) -> DataFrame:
    return report(w, ["gmv", "order_count"], where={"is_weekend": True})


def period_gmv(term: str) -> Query:
    return _star(lambda w: reports.period_sales(vocabulary.PERIODS[term](w)))


def gold_row_counts(w: Warehouse) -> DataFrame:
    return gold.row_counts({name: w.gold(name) for name in GOLD if not name.startswith("_")})


def drill_state(w: Warehouse, state: str) -> DataFrame:
    """The operations and customer figures of one state."""
    names = [
        "on_time_delivery_pct",
        "avg_delivery_days",
        "cancellation_rate",
        "delivered_orders",
        "active_customers",
        "repeat_customer_pct",
        "avg_review_score",
    ]
    return report(w, names, where={"customer_state": state})


MONTHLY = (
    "total_sales",
    "total_freight",
    "gmv",
    "total_payments",
    "order_count",
    "items_sold",
    "average_order_value",
    "average_item_price",
    "active_customers",
    "repeat_customer_pct",
    "avg_delivery_days",
    "on_time_delivery_pct",
    "delivered_orders",
    "cancellation_rate",
    "avg_review_score",
    "review_response_rate",
    "five_star_pct",
    "late_items",
)

QUERIES: dict[str, Query] = {
    # Operators
    "bronze_audit": bronze_audit,
    "dedup_latest": dedup_latest,
    "dense_key": dense_order_key,
    # Layers
    **{f"silver_{name}": _silver(name) for name in SILVER},
    "dim_date": _gold("DimDate"),
    "dim_customer": _gold("DimCustomer"),
    "bridge_customer": _gold("_bridge_customer"),
    "dim_product": _gold("DimProduct"),
    "dim_seller": _gold("DimSeller"),
    "dim_geography": _gold("DimGeography"),
    "fact_order_items": _gold("FactOrderItems"),
    "fact_payments": _gold("FactPayments"),
    "fact_reviews": _gold("FactReviews"),
    "gold_row_counts": _star(gold_row_counts),
    # Measures
    **{f"m_{name}": _by_month(name) for name in MONTHLY},
    "m_order_status": _star(lambda w: report(w, ["delivered_orders", "cancellation_rate"], ["order_status"])),
    "m_order_status_year": _star(
        lambda w: report(w, ["delivered_orders", "cancellation_rate"], ["year", "order_status"]),
    ),
    "m_repeat_flag": _star(lambda w: report(w, ["repeat_customer_pct"], ["is_repeat_customer"])),
    "m_new_customers": _star(lambda w: timeline.new_customers(w, ["year_month"])),
    "m_new_customers_region": _star(lambda w: report(w, ["new_customers", "active_customers"], ["region", "year_month"])),
    "m_new_customers_category": _star(lambda w: report(w, ["new_customers"], ["category_en", "year"])),
    # Days with gaps between them, and a group of days that overlaps with others.
    "m_new_customers_weekend": _star(lambda w: report(w, ["new_customers"], ["year"], {"is_weekend": True})),
    "m_new_customers_weekend_state": _star(
        lambda w: report(w, ["new_customers"], ["year"], {"is_weekend": True, "customer_state": STATE}),
    ),
    "m_gmv_ytd_region": _star(lambda w: report(w, ["gmv", "gmv_ytd"], ["region", "year_month"])),
    "m_gmv_rolling_30d_category": _star(lambda w: report(w, ["gmv_rolling_30d"], ["category_en", "year_month"])),
    "m_gmv_rolling_30d_daily": _star(
        lambda w: report(w, ["gmv_rolling_30d", "gmv_ytd"], ["customer_state", "date"], {"year": YEAR, "region": REGION}),
    ),
    "m_gmv_yoy_state": _star(lambda w: report(w, ["gmv", "gmv_ly", "gmv_yoy_pct"], ["customer_state", "year"])),
    "m_gmv_mom_category": _star(lambda w: report(w, ["gmv_mom_pct"], ["category_en", "year_month"])),
    "m_gmv_ly_month_name": _star(lambda w: report(w, ["gmv", "gmv_ly"], ["year"], {"month_name": MONTH_NAME})),
    "m_gmv_ly_daily": _star(lambda w: report(w, ["gmv", "gmv_ly", "gmv_pm"], ["date"], {"category_en": CATEGORY})),
    "m_category_mix_region": _star(
        lambda w: report(w, ["category_pct_of_total", "cumulative_gmv_pct"], ["region", "category_en"], {"year": YEAR}),
    ),
    "m_one_category_share": _star(
        lambda w: report(w, ["gmv", "category_pct_of_total", "cumulative_gmv_pct"], ["year"], {"category_en": CATEGORY}),
    ),
    "m_gmv_ytd": _star(timeline.gmv_ytd),
    "m_gmv_ly": _star(timeline.gmv_ly),
    "m_gmv_yoy_pct": _star(timeline.gmv_yoy),
    "m_gmv_mom_pct": _star(timeline.gmv_mom),
    "m_gmv_rolling_30d": _star(timeline.gmv_rolling),
    "m_category_pct_of_total": _star(timeline.category_share),
    "m_category_pct_of_year": _star(lambda w: timeline.category_share(w, ["year"])),
    "m_cumulative_gmv_pct": _star(
        lambda w: timeline.pareto(w).select("category_en", "cumulative_gmv_pct"),
    ),
    "m_installment_mix": _star(reports.installment_mix),
    # Executive
    "kpi_executive": _star(lambda w: reports.executive_kpis(w, YEAR)),
    "v_gmv_month_ly": _star(timeline.gmv_ly),
    "q_top_categories": _star(reports.top_categories),
    "v_pareto": _star(timeline.pareto),
    "v_gmv_by_state": _star(reports.gmv_by_state),
    "v_sliced_kpis": _star(
        lambda w: reports.sliced_kpis(w, {"year": YEAR, "month_name": MONTH_NAME, "region": REGION}),
    ),
    # Operations
    "kpi_operations": _star(reports.operations_kpis),
    "kpi_cancel_item_rate": _star(lambda w: report(w, ["canceled_item_rows", "cancel_item_rate"])),
    "kpi_delivered_item_rows": _star(lambda w: report(w, ["delivered_item_rows"])),
    "v_delivery_histogram": _star(reports.delivery_histogram),
    "v_on_time_by_state": _star(lambda w: reports.on_time_by(w, "customer_state")),
    "v_on_time_by_region": _star(lambda w: reports.on_time_by(w, "region")),
    "v_delivery_trend": _star(reports.delivery_trend),
    "q_slowest_sellers": _star(reports.slowest_sellers),
    # Customers
    "kpi_customer": _star(reports.customer_kpis),
    "kpi_single_order_customers": _star(reports.single_order_customers),
    "kpi_repeat_all_customers": _star(reports.repeat_share),
    "v_new_vs_returning": _star(timeline.new_and_returning),
    "v_customers_by_state": _star(reports.customers_by_state),
    "v_review_distribution": _star(reports.review_distribution),
    "v_category_reviews": _star(reports.category_reviews),
    "v_drill_state": _star(lambda w: drill_state(w, STATE)),
    "v_drill_through": _star(lambda w: pages.listed(pages.drill_through(w, STATE))),
    "v_executive_page": _star(lambda w: pages.listed({"executive": pages.executive(w, {"year": YEAR, "region": REGION})})),
    # Questions
    "q_top_categories_year": _star(lambda w: reports.top_categories(w, 5, {"year": YEAR})),
    "q_region_delivery": _star(reports.region_delivery),
    "q_month_revenue": _star(lambda w: reports.month_revenue(w, YEAR)),
    "q_region_revenue": _star(reports.region_revenue),
    "q_cancel_by_state": _star(reports.cancellations_by_state),
    "q_repeat_by_region": _star(reports.repeat_by_region),
    "q_five_star_share": _star(reports.five_star_share),
    "q_payment_mix": _star(reports.payment_mix),
    "q_one_month_revenue": _star(lambda w: report(w, ["gmv"], where={"year": YEAR, "month": MONTH})),
    "q_worst_state": _star(reports.worst_state),
    "q_top_sellers_year": _star(lambda w: reports.top_sellers(w, 10, {"year": YEAR})),
    "q_late_rate_state": _star(lambda w: reports.late_rate(w, STATE)),
    "q_last_month_top": _star(reports.last_month_top),
    "q_last_month_best_in_state": _star(lambda w: reports.last_month_top(w, 1, STATE)),
    "q_one_category": _star(lambda w: report(w, ["gmv", "items_sold"], ["year"], {"category_en": CATEGORY})),
    # Periods
    "t_this_month": period_gmv("this month"),
    "t_last_month": period_gmv("last month"),
    "t_ytd": period_gmv("year to date"),
    "t_last_30_days": period_gmv("last 30 days"),
    "t_gmv_by_weekday": _star(lambda w: report(w, ["gmv"], ["day_name"])),
    "t_weekend_gmv": _star(weekend_gmv),
    "gmv_by_delivered_month": _star(gmv_by_delivered_month),
    # Hierarchies and the metric layer
    "rollup_date": _star(lambda w: reports.rollup_of(w, reports.HIERARCHIES["date"])),
    "rollup_geo_distinct": _star(lambda w: hierarchies.distinct_rollup(w, reports.HIERARCHIES["geography"])),
    "rollup_product_distinct": _star(lambda w: hierarchies.distinct_rollup(w, reports.HIERARCHIES["product"])),
    "rollup_date_distinct": _star(lambda w: hierarchies.distinct_rollup(w, reports.HIERARCHIES["date"], {"category_en": CATEGORY})),
    "rollup_geo": _star(lambda w: reports.rollup_of(w, reports.HIERARCHIES["geography"])),
    "rollup_product": _star(lambda w: reports.rollup_of(w, reports.HIERARCHIES["product"])),
    "metric_layer_two_facts": _star(
        lambda w: report(w, ["gmv", "total_payments", "order_count", "avg_review_score"], ["region", "year"]),
    ),
    # Data quality
    "dq_pk_violations": dq_pk_violations,
    "dq_null_counts": lambda spark, root: quality.all_null_counts(_layers(spark, root)),
    "dq_orphans": lambda spark, root: quality.all_orphans(_layers(spark, root)),
    "dq_layer_profile": dq_layer_profile,
    "dq_payments_vs_gmv": lambda spark, root: quality.payments_vs_gmv(_layers(spark, root)),
    "dq_two_builds": dq_two_builds,
    "dq_batch_and_deltas": dq_batch_and_deltas,
    "dq_pending_items": dq_pending_items,
    "layer_row_counts": layer_row_counts,
    # Incremental
    "incremental_delta": incremental_delta,
    "incremental_upsert": incremental_upsert,
    "incremental_deltas": incremental_deltas,
    "stream_upsert_items": stream_upsert_items,
}

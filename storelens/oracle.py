"""The expected result of every query, as one SQL statement over the given tables.

``RELATIONS`` are common table expressions in order of dependency; a statement gets those it mentions,
directly or through another. They go from the given tables to the star without the library's help.
"""

from __future__ import annotations

import re

from storelens.queries import CATEGORY, MONTH, MONTH_NAME, REGION, STATE, YEAR

RELATIONS = {
    "b_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate + INTERVAL 7 DAY AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
                    AS DECIMAL(12,2)) AS freight_value,
               l_shipdate AS _ingested_at
        FROM lineitem""",
    "b_items_last": """
        SELECT * FROM b_items
        QUALIFY row_number() OVER (
            PARTITION BY order_id, order_item_id
            ORDER BY _ingested_at DESC NULLS LAST, product_id NULLS FIRST, seller_id NULLS FIRST,
                     shipping_limit_date NULLS FIRST, price NULLS FIRST, freight_value NULLS FIRST) = 1""",
    "b_items_early": """
        SELECT * FROM b_items WHERE _ingested_at <= (SELECT MAX(o_orderdate) FROM orders)
        QUALIFY row_number() OVER (
            PARTITION BY order_id, order_item_id
            ORDER BY _ingested_at DESC NULLS LAST, product_id NULLS FIRST, seller_id NULLS FIRST,
                     shipping_limit_date NULLS FIRST, price NULLS FIRST, freight_value NULLS FIRST) = 1""",
    "s_items": """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date AS shipping_limit_ts,
               price, freight_value
        FROM b_items_last""",
    "placed": """
        SELECT *, o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS BIGINT)) AS bought FROM orders""",
    "s_orders": """
        SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                                  WHEN 'P' THEN 'canceled' END AS order_status,
               bought AS order_purchase_ts,
               CASE WHEN o_orderkey % 53 <> 0 AND o_orderkey % 59 <> 0
                    THEN bought + INTERVAL 1 HOUR END AS order_approved_ts,
               CASE WHEN o_orderstatus <> 'P' THEN bought + INTERVAL 2 DAY END AS order_delivered_carrier_ts,
               CASE WHEN o_orderstatus = 'F'
                    THEN bought + to_days(CAST(3 + o_orderkey % 40 AS INTEGER))
                                + to_minutes(CAST(o_orderkey % 1000 AS BIGINT)) END AS order_delivered_customer_ts,
               o_orderdate + to_days(CAST(20 + o_orderkey * 7 % 15 AS INTEGER)) AS order_estimated_delivery_ts
        FROM placed""",
    "s_payments": """
        SELECT event_id // 2 AS order_id, CAST(event_id % 2 + 1 AS INTEGER) AS payment_sequential,
               CASE event_type WHEN 'purchase' THEN 'credit_card' WHEN 'click' THEN 'boleto'
                               WHEN 'view' THEN 'voucher' WHEN 'signup' THEN 'debit_card'
                               ELSE 'not_defined' END AS payment_type,
               CAST(1 + event_id % 12 AS INTEGER) AS payment_installments,
               CAST(value AS DECIMAL(12,2)) AS payment_value
        FROM events""",
    "s_reviews": """
        SELECT event_id - CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS review_id,
               event_id AS order_id, CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) AS review_score,
               event_type AS review_comment_title, props AS review_comment_message,
               ts AS review_creation_ts, ts + to_days(CAST(event_id % 9 AS INTEGER)) AS review_answer_ts
        FROM events
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY ts DESC NULLS LAST, event_id) = 1""",
    "s_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS category_pt,
               CASE WHEN p_partkey % 50 = 0 OR p_type IS NULL THEN 'unknown' WHEN p_type = 'PROMO' THEN 'PROMO'
                    ELSE 'cat_' || lower(p_type) END AS category_en,
               CAST(length(p_name) AS INTEGER) AS name_length,
               CAST(length(p_brand) AS INTEGER) AS description_length,
               CAST(p_size % 5 AS INTEGER) AS photos_qty,
               CASE WHEN p_partkey % 97 <> 0 THEN CAST(p_size * 300 AS INTEGER) END AS weight_g,
               CAST(p_size + 10 AS INTEGER) AS length_cm, CAST(p_size + 5 AS INTEGER) AS height_cm,
               CAST(p_size + 2 AS INTEGER) AS width_cm
        FROM part""",
    "s_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_prefix, upper(s_name) AS seller_city,
               upper(n_name) AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "s_customers": """
        SELECT o_orderkey AS customer_id,
               CASE WHEN o_orderkey % 10 = 0 THEN o_custkey ELSE 1000000000000 + o_orderkey END
                   AS customer_unique_id,
               c_nationkey AS customer_zip_prefix, upper(o_orderpriority) AS customer_city,
               upper(n_name) AS customer_state
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "s_geolocation": """
        SELECT c_nationkey AS zip_prefix,
               CAST(SUM(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(24,14))) AS DOUBLE) / COUNT(c_acctbal) AS lat,
               CAST(SUM(CAST(CAST(CAST(c_custkey AS DOUBLE) / 1000 AS VARCHAR) AS DECIMAL(24,14))) AS DOUBLE)
                   / COUNT(c_custkey) AS lng,
               MAX(upper(c_mktsegment)) AS city, MAX(upper(n_name)) AS state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey""",
    "span": """
        SELECT make_date(CAST(year(MIN(seen)) AS INTEGER), 1, 1) AS first_day,
               make_date(CAST(year(MAX(seen)) AS INTEGER), 12, 31) AS last_day
        FROM (SELECT MIN(o_orderdate) AS seen FROM orders UNION ALL SELECT MAX(ts) FROM events) AS seen_days""",
    "dates": """
        SELECT CAST(d AS DATE) AS date
        FROM (SELECT unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP),
                                            INTERVAL 1 DAY)) AS d FROM span) AS listed""",
    "d_date": """
        SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date,
               CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, strftime(date, '%B') AS month_name,
               CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
               strftime(date, '%A') AS day_name, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
               CAST(weekofyear(date) AS INTEGER) AS week_of_year, dayofweek(date) IN (0, 6) AS is_weekend,
               year(date) || '-Q' || quarter(date) AS year_quarter, strftime(date, '%Y-%m') AS year_month
        FROM dates""",
    "people": """
        SELECT customer_unique_id, MAX(customer_id) AS last_id, COUNT(DISTINCT customer_id) AS n
        FROM s_customers GROUP BY customer_unique_id""",
    "d_customer": """
        SELECT dense_rank() OVER (ORDER BY p.customer_unique_id) AS customer_key, p.customer_unique_id,
               c.customer_zip_prefix, c.customer_city, c.customer_state,
               CAST(p.n AS INTEGER) AS n_orders_per_unique, p.n > 1 AS is_repeat_customer
        FROM people p JOIN s_customers c ON c.customer_id = p.last_id""",
    "d_bridge": """
        SELECT customer_id, customer_key FROM s_customers JOIN d_customer USING (customer_unique_id)""",
    "d_product": """
        SELECT dense_rank() OVER (ORDER BY product_id) AS product_key, product_id, category_pt, category_en,
               photos_qty, weight_g, length_cm, height_cm, width_cm,
               CASE WHEN weight_g IS NULL THEN 'unknown' WHEN weight_g >= 10000 THEN '10kg+'
                    WHEN weight_g >= 2000 THEN '2-10kg' WHEN weight_g >= 500 THEN '500g-2kg'
                    ELSE '0-500g' END AS weight_bucket
        FROM s_products""",
    "d_seller": """
        SELECT dense_rank() OVER (ORDER BY seller_id) AS seller_key, seller_id, seller_zip_prefix,
               seller_city, seller_state
        FROM s_sellers""",
    "d_geography": """
        SELECT dense_rank() OVER (ORDER BY state) AS geography_key, state, COALESCE(r_name, 'Unknown') AS region
        FROM (SELECT customer_state AS state FROM s_customers UNION SELECT seller_state FROM s_sellers) AS states
        LEFT JOIN nation ON n_name = state LEFT JOIN region ON r_regionkey = n_regionkey
        WHERE state IS NOT NULL""",
    "headers": """
        SELECT order_id, customer_key, order_status,
               CAST(strftime(order_purchase_ts, '%Y%m%d') AS INTEGER) AS purchase_date_key,
               CAST(strftime(order_delivered_customer_ts, '%Y%m%d') AS INTEGER) AS delivered_date_key,
               CAST(strftime(order_estimated_delivery_ts, '%Y%m%d') AS INTEGER) AS estimated_date_key,
               CAST(date_diff('day', CAST(order_purchase_ts AS DATE), CAST(order_delivered_customer_ts AS DATE))
                    AS INTEGER) AS delivery_days,
               CAST(date_diff('day', CAST(order_estimated_delivery_ts AS DATE),
                              CAST(order_delivered_customer_ts AS DATE)) AS INTEGER) AS delivery_vs_estimate_days,
               CASE WHEN order_delivered_customer_ts <= order_estimated_delivery_ts THEN 1 ELSE 0 END
                   AS on_time_flag
        FROM s_orders LEFT JOIN d_bridge USING (customer_id)""",
    "f_items": """
        SELECT order_id, order_item_id, purchase_date_key, delivered_date_key, estimated_date_key, customer_key,
               product_key, seller_key, order_status, price, freight_value,
               CAST(price + freight_value AS DECIMAL(12,2)) AS total_value, delivery_days,
               delivery_vs_estimate_days, on_time_flag
        FROM s_items JOIN headers USING (order_id)
        LEFT JOIN d_product USING (product_id) LEFT JOIN d_seller USING (seller_id)""",
    "f_payments": """
        SELECT order_id, payment_sequential, purchase_date_key, customer_key, payment_type,
               payment_installments, payment_value
        FROM s_payments JOIN headers USING (order_id)""",
    "f_reviews": """
        SELECT review_id, order_id, purchase_date_key,
               CAST(strftime(review_creation_ts, '%Y%m%d') AS INTEGER) AS review_date_key, customer_key,
               review_score,
               CAST(date_diff('day', CAST(review_creation_ts AS DATE), CAST(review_answer_ts AS DATE)) AS INTEGER)
                   AS response_days
        FROM s_reviews JOIN headers USING (order_id)""",
    "items": """
        SELECT f.*, d.date, d.year, d.quarter, d.month, d.day, d.year_month, d.month_name, d.day_name,
               d.is_weekend, c.customer_state, c.customer_city, c.is_repeat_customer, g.region, p.category_en,
               p.product_id, s.seller_id, s.seller_state
        FROM f_items f JOIN d_date d ON d.date_key = f.purchase_date_key
        JOIN d_customer c USING (customer_key) JOIN d_geography g ON g.state = c.customer_state
        JOIN d_product p USING (product_key) JOIN d_seller s USING (seller_key)""",
    "payments": """
        SELECT f.*, d.year, d.year_month, c.customer_state, g.region
        FROM f_payments f JOIN d_date d ON d.date_key = f.purchase_date_key
        JOIN d_customer c USING (customer_key) JOIN d_geography g ON g.state = c.customer_state""",
    "reviews": """
        SELECT f.*, d.year, d.year_month, c.customer_state, g.region
        FROM f_reviews f JOIN d_date d ON d.date_key = f.purchase_date_key
        JOIN d_customer c USING (customer_key) JOIN d_geography g ON g.state = c.customer_state""",
    "month_list": """
        SELECT year, month, year_month, MIN(date) AS first_day, MAX(date) AS last_day
        FROM d_date GROUP BY year, month, year_month""",
    "month_gmv": """
        SELECT year_month, CAST(SUM(total_value) AS DECIMAL(28,2)) AS gmv FROM items GROUP BY year_month""",
    "firsts": """
        SELECT customer_key, MIN(purchase_date_key) AS first_key FROM f_items
        WHERE customer_key IS NOT NULL GROUP BY customer_key""",
    "category_gmv": """
        SELECT category_en, CAST(SUM(total_value) AS DECIMAL(28,2)) AS gmv FROM items GROUP BY category_en""",
    "last_buy": """
        SELECT MAX(date) AS as_of FROM items""",
    "item_reviews": """
        SELECT p.category_en, r.review_score
        FROM f_items i JOIN d_product p USING (product_key) JOIN f_reviews r USING (order_id)""",
}


def _share(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / NULLIF(CAST({denominator} AS DOUBLE), 0)"


def _money(column: str) -> str:
    return f"CAST(SUM({column}) AS DECIMAL(28,2))"


_DELIVERED = "COUNT(delivery_days)"
_ON_TIME = "SUM(CASE WHEN delivery_days IS NOT NULL THEN on_time_flag ELSE 0 END)"
_ORDERS = "COUNT(DISTINCT order_id)"

# Each measure over item, payment or review rows.
MEASURE = {
    "total_sales": ("items", _money("price")),
    "total_freight": ("items", _money("freight_value")),
    "gmv": ("items", _money("total_value")),
    "total_payments": ("payments", _money("payment_value")),
    "order_count": ("items", _ORDERS),
    "items_sold": ("items", "COUNT(*)"),
    "average_order_value": ("items", _share("SUM(total_value)", _ORDERS)),
    "average_item_price": ("items", _share("SUM(price)", "COUNT(price)")),
    "active_customers": ("items", "COUNT(DISTINCT customer_key)"),
    "repeat_customer_pct": (
        "items",
        _share("COUNT(DISTINCT customer_key) FILTER (is_repeat_customer)", "COUNT(DISTINCT customer_key)"),
    ),
    "avg_delivery_days": ("items", _share("SUM(delivery_days)", _DELIVERED)),
    "on_time_delivery_pct": ("items", _share(_ON_TIME, _DELIVERED)),
    "delivered_orders": ("items", "COUNT(DISTINCT order_id) FILTER (order_status = 'delivered')"),
    "cancellation_rate": ("items", _share("COUNT(DISTINCT order_id) FILTER (order_status = 'canceled')", _ORDERS)),
    "avg_review_score": ("reviews", _share("SUM(review_score)", "COUNT(review_score)")),
    "five_star_pct": ("reviews", _share("COUNT(*) FILTER (review_score = 5)", "COUNT(*)")),
    "late_items": ("items", "COUNT(*) FILTER (delivery_vs_estimate_days > 0)"),
    "late_delivery_pct": ("items", _share("COUNT(*) FILTER (delivery_vs_estimate_days > 0)", _DELIVERED)),
}


def _select(measures: list[str], by: str = "", where: str = "TRUE") -> str:
    """Measures on one fact."""
    fact = MEASURE[measures[0]][0]
    columns = ", ".join(f"{MEASURE[m][1]} AS {m}" for m in measures)
    if not by:
        return f"SELECT {columns} FROM {fact} WHERE {where}"
    return f"SELECT {by}, {columns} FROM {fact} WHERE {where} GROUP BY {by}"


def _pk(layer: str, table: str, relation: str, keys: str) -> str:
    return f"""SELECT '{layer}.{table}' AS "table", '{keys}' AS key_columns, COUNT(*) AS violating_keys,
        CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows
        FROM (SELECT COUNT(*) AS n FROM {relation} GROUP BY {keys} HAVING COUNT(*) > 1) AS repeated"""


def _nulls(layer: str, table: str, relation: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{layer}.{table}' AS "table", '{c}' AS "column", COUNT(*) FILTER ({c} IS NULL) AS nulls
            FROM {relation}"""
        for c in columns.split(",")
    )


def _orphans(table: str, relation: str, column: str, dimension: str, one: str, key: str) -> str:
    return f"""SELECT '{table}.{column}' AS many_side, '{dimension}.{key}' AS one_side,
        COUNT(DISTINCT {column}) AS orphan_keys, COUNT(*) AS orphan_rows
        FROM {relation} m WHERE {column} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {one} d WHERE d.{key} = m.{column})"""


def _count(label: str, name: str, relation: str) -> str:
    return f"SELECT '{label}' AS layer, '{name}' AS \"table\", COUNT(*) AS n FROM {relation}"


_BRONZE = {
    "orders": "orders",
    "order_items": "lineitem",
    "order_payments": "events",
    "order_reviews": "events",
    "products": "part",
    "sellers": "supplier",
    "customers": "orders",
    "geolocation": "customer",
    "category_translation": "part",
}
_SILVER = {
    "orders": "s_orders",
    "order_items": "s_items",
    "order_payments": "s_payments",
    "order_reviews": "s_reviews",
    "products": "s_products",
    "sellers": "s_sellers",
    "customers": "s_customers",
    "geolocation": "s_geolocation",
}
_GOLD = {
    "DimDate": "d_date",
    "DimCustomer": "d_customer",
    "_bridge_customer": "d_bridge",
    "DimProduct": "d_product",
    "DimSeller": "d_seller",
    "DimGeography": "d_geography",
    "FactOrderItems": "f_items",
    "FactPayments": "f_payments",
    "FactReviews": "f_reviews",
}
_KEYS = (
    ("silver", "orders", "order_id"),
    ("silver", "order_items", "order_id,order_item_id"),
    ("silver", "order_payments", "order_id,payment_sequential"),
    ("silver", "order_reviews", "review_id"),
    ("silver", "products", "product_id"),
    ("silver", "sellers", "seller_id"),
    ("silver", "customers", "customer_id"),
    ("silver", "geolocation", "zip_prefix"),
    ("gold", "DimDate", "date_key"),
    ("gold", "DimCustomer", "customer_key"),
    ("gold", "_bridge_customer", "customer_id"),
    ("gold", "DimProduct", "product_key"),
    ("gold", "DimSeller", "seller_key"),
    ("gold", "DimGeography", "geography_key"),
    ("gold", "DimGeography", "state"),
    ("gold", "FactOrderItems", "order_id,order_item_id"),
    ("gold", "FactPayments", "order_id,payment_sequential"),
    ("gold", "FactReviews", "review_id"),
)
_REQUIRED = (
    ("silver", "orders", "order_id,customer_id"),
    ("silver", "order_items", "order_id,order_item_id"),
    ("silver", "order_payments", "order_id,payment_sequential"),
    ("silver", "order_reviews", "review_id,order_id"),
    ("silver", "products", "product_id"),
    ("silver", "sellers", "seller_id"),
    ("silver", "customers", "customer_id,customer_unique_id"),
    ("silver", "geolocation", "zip_prefix"),
    ("gold", "DimDate", "date_key,date"),
    ("gold", "DimCustomer", "customer_key,customer_unique_id"),
    ("gold", "_bridge_customer", "customer_id,customer_key"),
    ("gold", "DimProduct", "product_key,product_id"),
    ("gold", "DimSeller", "seller_key,seller_id"),
    ("gold", "DimGeography", "geography_key,state"),
    ("gold", "FactOrderItems", "order_id,order_item_id"),
    ("gold", "FactPayments", "order_id,payment_sequential"),
    ("gold", "FactReviews", "review_id,order_id"),
)
_PATHS = (
    ("FactOrderItems", "purchase_date_key", "DimDate", "date_key"),
    ("FactOrderItems", "delivered_date_key", "DimDate", "date_key"),
    ("FactOrderItems", "customer_key", "DimCustomer", "customer_key"),
    ("FactOrderItems", "product_key", "DimProduct", "product_key"),
    ("FactOrderItems", "seller_key", "DimSeller", "seller_key"),
    ("DimCustomer", "customer_state", "DimGeography", "state"),
    ("FactPayments", "purchase_date_key", "DimDate", "date_key"),
    ("FactPayments", "customer_key", "DimCustomer", "customer_key"),
    ("FactReviews", "purchase_date_key", "DimDate", "date_key"),
    ("FactReviews", "customer_key", "DimCustomer", "customer_key"),
)
_TABLES = {"silver": _SILVER, "gold": _GOLD}
_UNION = " UNION ALL "


def _profile() -> str:
    kept = _UNION.join(
        f"""SELECT '{n}' AS "table", (SELECT COUNT(*) FROM {_BRONZE[n]}) AS bronze_rows,
            (SELECT COUNT(*) FROM {s}) AS silver_rows,
            CAST((SELECT COUNT(*) FROM {s}) AS DOUBLE) / (SELECT COUNT(*) FROM {_BRONZE[n]}) AS kept_share,
            NULL AS "column", NULL AS failures"""
        for n, s in _SILVER.items()
    )
    failed = {
        "order_purchase_timestamp": "FALSE",
        "order_approved_at": "o_orderkey % 53 = 0 OR o_orderkey % 59 = 0",
        "order_delivered_carrier_date": "FALSE",
        "order_delivered_customer_date": "FALSE",
        "order_estimated_delivery_date": "FALSE",
    }
    failures = _UNION.join(
        f"""SELECT 'orders', NULL, NULL, NULL, '{c}', COUNT(*) FILTER ({test}) FROM orders"""
        for c, test in failed.items()
    )
    return kept + _UNION + failures


def _against(months: int, name: str) -> str:
    return f"""
        SELECT m.year_month, now.gmv, before.gmv AS {name}
        FROM month_list m
        LEFT JOIN month_gmv now ON now.year_month = m.year_month
        LEFT JOIN month_gmv before
            ON before.year_month = strftime(m.first_day - INTERVAL {months} MONTH, '%Y-%m')
        WHERE now.gmv IS NOT NULL OR before.gmv IS NOT NULL"""


def _change(months: int, name: str) -> str:
    return f"""SELECT year_month, {_share("gmv - earlier", "earlier")} AS {name}
        FROM ({_against(months, "earlier")}) AS both_months"""


def _period(where: str) -> str:
    return f"""SELECT {_money("total_value")} AS gmv, {_ORDERS} AS order_count FROM items, last_buy WHERE {where}"""


def _last_month(n: int, where: str = "TRUE") -> str:
    return f"""SELECT category_en, {_money("total_value")} AS gmv FROM items, last_buy
        WHERE year_month = strftime(as_of - INTERVAL 1 MONTH, '%Y-%m') AND {where}
        GROUP BY category_en ORDER BY gmv DESC, category_en LIMIT {n}"""


def _rollup(levels: str) -> str:
    return f"""SELECT {levels}, {_money("total_value")} AS gmv, COUNT(*) AS items_sold,
        CAST(GROUPING({levels}) AS INTEGER) AS level_id FROM items GROUP BY ROLLUP ({levels})"""


_PARETO = f"""
    SELECT a.category_en, a.gmv,
           {_share("(SELECT SUM(gmv) FROM category_gmv b WHERE b.gmv >= a.gmv)", "(SELECT SUM(gmv) FROM category_gmv)")}
               AS cumulative_gmv_pct,
           CAST(row_number() OVER (ORDER BY a.gmv DESC, a.category_en) AS INTEGER) AS category_rank
    FROM category_gmv a"""


def _distinct_rollup(levels: str, where: str = "TRUE") -> str:
    return f"""
        SELECT {levels}, CAST(GROUPING({levels}) AS INTEGER) AS level_id, {_ORDERS} AS order_count,
               COUNT(DISTINCT customer_key) AS active_customers
        FROM items WHERE {where} GROUP BY ROLLUP ({levels})"""


def _cells(groups: str, where: str = "TRUE") -> str:
    """First and last day of each group of calendar days."""
    return f"SELECT {groups}, MIN(date) AS a, MAX(date) AS b FROM d_date WHERE {where} GROUP BY {groups}"


def _new(group: str, cells: str, condition: str = "TRUE") -> str:
    """Buyers among the items that meet ``condition`` in a span, with their first purchase ever in it."""
    return f"""
        SELECT {group}, COUNT(DISTINCT i.customer_key) AS new_customers
        FROM ({cells}) c JOIN items i ON i.date BETWEEN c.a AND c.b AND {condition}
        JOIN firsts f ON f.customer_key = i.customer_key
             AND f.first_key BETWEEN CAST(strftime(c.a, '%Y%m%d') AS INTEGER) AND CAST(strftime(c.b, '%Y%m%d') AS INTEGER)
        GROUP BY {group}"""


def _rolling(group: str, cells: str, condition: str = "TRUE", name: str = "gmv_rolling_30d") -> str:
    since = "c.b - INTERVAL 29 DAY" if name == "gmv_rolling_30d" else "date_trunc('year', c.b)"
    return f"""
        SELECT {group}, {_money("total_value")} AS {name}
        FROM ({cells}) c JOIN items i ON i.date <= c.b AND i.date >= {since} AND {condition} GROUP BY {group}"""


def _moved(months: int, days: str, keys: str) -> str:
    """The days of each group of ``days`` moved back as a set, to the month's end where the last two days are among them."""
    return f"""
        SELECT {keys}, CAST(date - INTERVAL {months} MONTH AS DATE) AS date FROM ({days}) AS own
        UNION
        SELECT {keys}, CAST(d AS DATE) AS date
        FROM (SELECT {keys}, unnest(generate_series(CAST(last AS TIMESTAMP), last_day(last), INTERVAL 1 DAY)) AS d
              FROM (SELECT {keys}, CAST(last_day(date) - INTERVAL {months} MONTH AS DATE) AS last FROM ({days}) AS own
                    WHERE date >= last_day(date) - 1 GROUP BY {keys}, last_day(date) HAVING COUNT(*) = 2) AS ends) AS listed"""


def _visual(page: str, visual: str, label: str, measures: list[str], rows: str) -> str:
    return _UNION.join(
        f"""SELECT '{page}' AS page, '{visual}' AS visual, CAST({label} AS VARCHAR) AS label, '{m}' AS measure,
            CAST({m} AS DOUBLE) AS value FROM ({rows}) AS visual_rows"""
        for m in measures
    )


def _executive_page() -> str:
    chosen = f"year = {YEAR} AND region = '{REGION}'"
    before = f"(SELECT SUM(total_value) FROM items WHERE year = {YEAR - 1} AND region = '{REGION}')"
    headline = f"""
        SELECT {_money("total_value")} AS gmv, {_ORDERS} AS order_count, {_share("SUM(total_value)", _ORDERS)} AS average_order_value,
               {_share(f"SUM(total_value) - {before}", before)} AS gmv_yoy_pct, COUNT(DISTINCT customer_key) AS active_customers
        FROM items WHERE {chosen}"""
    by_month = f"""
        SELECT m.year_month, n.gmv, l.gmv AS gmv_ly
        FROM month_list m
        LEFT JOIN ({_select(["gmv"], "year_month", f"region = '{REGION}'")}) n ON n.year_month = m.year_month
        LEFT JOIN ({_select(["gmv"], "year_month", f"region = '{REGION}'")}) l
               ON l.year_month = strftime(m.first_day - INTERVAL 1 YEAR, '%Y-%m')
        WHERE m.year = {YEAR} AND (n.gmv IS NOT NULL OR l.gmv IS NOT NULL)"""
    categories = _select(["gmv"], "category_en", chosen)
    pareto = f"""
        SELECT category_en, gmv, {_share("SUM(gmv) OVER (ORDER BY gmv DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
                                         "SUM(gmv) OVER ()")} AS cumulative_gmv_pct FROM ({categories}) AS c"""
    page = lambda *rest: _visual("executive", *rest)
    return _UNION.join(
        [
            page("headline", "''", ["gmv", "order_count", "average_order_value", "gmv_yoy_pct", "active_customers"], headline),
            page("gmv by month", "year_month", ["gmv", "gmv_ly"], by_month),
            page("top categories", "category_en", ["gmv"], f"{categories} ORDER BY gmv DESC, category_en LIMIT 10"),
            page("pareto", "category_en", ["gmv", "cumulative_gmv_pct"], pareto),
            page("gmv by state", "customer_state", ["gmv"], _select(["gmv"], "customer_state", chosen)),
        ]
    )


def _drill_through() -> str:
    here = f"customer_state = '{STATE}'"
    names = ["on_time_delivery_pct", "avg_delivery_days", "cancellation_rate", "delivered_orders"]
    histogram = f"""
        SELECT CASE WHEN delivery_days >= 30 THEN '30+' WHEN delivery_days >= 15 THEN '15-30'
                    WHEN delivery_days >= 10 THEN '10-15' WHEN delivery_days >= 5 THEN '5-10'
                    WHEN delivery_days >= 0 THEN '0-5' ELSE '<0' END AS delivery_bin, COUNT(*) AS item_rows
        FROM items WHERE delivery_days IS NOT NULL AND {here} GROUP BY 1"""
    trend = f"""
        SELECT year_month, {MEASURE["avg_delivery_days"][1]} AS avg_delivery_days
        FROM items, last_buy WHERE year_month > strftime(as_of - INTERVAL 12 MONTH, '%Y-%m') AND {here} GROUP BY year_month"""
    sellers = f"""
        SELECT seller_id, seller_state, COUNT(*) AS item_rows, {_ORDERS} AS order_count,
               {_share("SUM(delivery_days)", "COUNT(*)")} AS avg_delivery_days,
               {_share("SUM(on_time_flag)", "COUNT(*)")} AS on_time_delivery_pct
        FROM items WHERE delivery_days IS NOT NULL AND {here} GROUP BY seller_id, seller_state HAVING COUNT(*) >= 10
        ORDER BY avg_delivery_days DESC, seller_id LIMIT 10"""
    people = f"""
        SELECT COUNT(DISTINCT customer_key) AS active_customers, {MEASURE["repeat_customer_pct"][1]} AS repeat_customer_pct,
               (SELECT {MEASURE["avg_review_score"][1]} FROM reviews WHERE {here}) AS avg_review_score,
               COUNT(DISTINCT customer_key) AS new_customers
        FROM items WHERE {here}"""
    fresh = f"""
        SELECT i.year_month,
               COUNT(DISTINCT i.customer_key) FILTER (i.purchase_date_key // 100 = f.first_key // 100) AS new_customers,
               COUNT(DISTINCT i.customer_key) FILTER (i.purchase_date_key // 100 > f.first_key // 100) AS returning_customers
        FROM items i JOIN firsts f USING (customer_key) WHERE {here} GROUP BY i.year_month"""
    scores = f"""
        SELECT review_score, COUNT(*) AS reviews, {_share("COUNT(*)", f"(SELECT COUNT(*) FROM reviews WHERE {here})")} AS share
        FROM reviews WHERE {here} GROUP BY review_score"""
    rated = f"""
        SELECT category_en, {_share("SUM(r.review_score)", "COUNT(r.review_score)")} AS avg_review_score,
               COUNT(DISTINCT (order_id, order_item_id)) AS items_sold
        FROM items i LEFT JOIN f_reviews r USING (order_id) WHERE {here} GROUP BY category_en HAVING COUNT(r.review_score) > 0
        ORDER BY avg_review_score DESC, category_en LIMIT 10"""
    first = lambda *rest: _visual("operations", *rest)
    second = lambda *rest: _visual("customer", *rest)
    return _UNION.join(
        [
            first("headline", "''", names, _select(names, where=here)),
            first("delivery days", "delivery_bin", ["item_rows"], histogram),
            first("on time by state", "customer_state", ["on_time_delivery_pct"], _select(["on_time_delivery_pct"], "customer_state", here)),
            first("trend", "year_month", ["avg_delivery_days"], trend),
            first("slowest sellers", "seller_state", ["seller_id", "item_rows", "order_count", "avg_delivery_days", "on_time_delivery_pct"], sellers),
            second("headline", "''", ["active_customers", "repeat_customer_pct", "avg_review_score", "new_customers"], people),
            second("new and returning", "year_month", ["new_customers", "returning_customers"], fresh),
            second("customers by state", "customer_state", ["customers"], f"SELECT customer_state, COUNT(*) AS customers FROM d_customer WHERE {here} GROUP BY customer_state"),
            second("review scores", "COALESCE(CAST(review_score AS VARCHAR), '-')", ["reviews", "share"], scores),
            second("categories by review", "category_en", ["avg_review_score", "items_sold"], rated),
        ]
    )


STATEMENTS: dict[str, str] = {
    "bronze_audit": _UNION.join(
        f"""SELECT '{n}' AS "table", '{t}.parquet' AS source_file, COUNT(*) AS "rows", COUNT(*) AS rows_stamped
            FROM {t}"""
        for n, t in _BRONZE.items()
    ),
    "dedup_latest": "SELECT * FROM b_items_last",
    "dense_key": """SELECT dense_rank() OVER (ORDER BY order_id) AS order_key, order_id, order_item_id FROM b_items""",
    **{f"silver_{n}": f"SELECT * FROM {r}" for n, r in _SILVER.items()},
    "dim_date": "SELECT * FROM d_date",
    "m_order_status": f"""
        SELECT order_status, (SELECT {MEASURE["delivered_orders"][1]} FROM items) AS delivered_orders,
               {_share("(SELECT COUNT(DISTINCT order_id) FILTER (order_status = 'canceled') FROM items)", _ORDERS)}
                   AS cancellation_rate
        FROM items GROUP BY order_status""",
    "m_order_status_year": f"""
        SELECT i.year, i.order_status, MAX(t.delivered) AS delivered_orders,
               {_share("MAX(t.canceled)", _ORDERS)} AS cancellation_rate
        FROM items i JOIN (SELECT year, COUNT(DISTINCT order_id) FILTER (order_status = 'delivered') AS delivered,
                                  COUNT(DISTINCT order_id) FILTER (order_status = 'canceled') AS canceled
                           FROM items GROUP BY year) t ON t.year = i.year
        GROUP BY i.year, i.order_status""",
    "m_repeat_flag": f"""
        SELECT is_repeat_customer,
               {_share("(SELECT COUNT(DISTINCT customer_key) FILTER (is_repeat_customer) FROM items)", "COUNT(DISTINCT customer_key)")}
                   AS repeat_customer_pct
        FROM items GROUP BY is_repeat_customer""",
    "dim_customer": "SELECT * FROM d_customer",
    "bridge_customer": "SELECT * FROM d_bridge",
    "dim_product": "SELECT * FROM d_product",
    "dim_seller": "SELECT * FROM d_seller",
    "dim_geography": "SELECT * FROM d_geography",
    "fact_order_items": "SELECT * FROM f_items",
    "fact_payments": "SELECT * FROM f_payments",
    "fact_reviews": "SELECT * FROM f_reviews",
    "gold_row_counts": _UNION.join(
        f"""SELECT '{n}' AS "table", COUNT(*) AS "rows" FROM {r}""" for n, r in _GOLD.items() if n[0] != "_"
    ),
    **{f"m_{m}": _select([m], "year_month") for m in MEASURE if m != "late_delivery_pct"},
    "m_review_response_rate": f"""
        SELECT year_month, {_share("reviewed", "ordered")} AS review_response_rate
        FROM (SELECT year_month, {_ORDERS} AS ordered FROM items GROUP BY year_month) AS sold
        FULL JOIN (SELECT year_month, {_ORDERS} AS reviewed FROM reviews GROUP BY year_month) AS rated
            USING (year_month)""",
    "m_new_customers": """
        SELECT year_month, COUNT(*) AS new_customers FROM firsts JOIN d_date ON date_key = first_key
        GROUP BY year_month""",
    "m_new_customers_region": f"""
        SELECT region, year_month, new_customers, active_customers
        FROM ({_select(["active_customers"], "region, year_month")}) AS active
        LEFT JOIN ({_new("region, c.year_month", _cells("year_month"))}) AS fresh USING (region, year_month)""",
    "m_new_customers_category": _new("category_en, c.year", _cells("year")),
    "m_new_customers_weekend": _new("c.year", _cells("year", "is_weekend")),
    "m_new_customers_weekend_state": _new("c.year", _cells("year", "is_weekend"), f"customer_state = '{STATE}'"),
    "m_gmv_ytd_region": f"""
        SELECT region, year_month, gmv, gmv_ytd
        FROM ({_rolling("region, c.year_month", _cells("year_month"), name="gmv_ytd")}) AS running
        FULL JOIN ({_select(["gmv"], "region, year_month")}) AS own USING (region, year_month)""",
    "m_gmv_rolling_30d_category": _rolling("category_en, c.year_month", _cells("year_month")),
    "m_gmv_rolling_30d_daily": f"""
        SELECT customer_state, date, gmv_rolling_30d, gmv_ytd
        FROM ({_rolling("customer_state, c.date", _cells("date", f"year = {YEAR}"), f"region = '{REGION}'")}) AS rolling
        FULL JOIN ({_rolling("customer_state, c.date", _cells("date", f"year = {YEAR}"), f"region = '{REGION}'", "gmv_ytd")}) AS running
        USING (customer_state, date)""",
    "m_gmv_yoy_state": f"""
        SELECT customer_state, year, n.gmv, l.gmv AS gmv_ly, {_share("n.gmv - l.gmv", "l.gmv")} AS gmv_yoy_pct
        FROM ({_select(["gmv"], "customer_state, year")}) n
        FULL JOIN (SELECT customer_state, year + 1 AS year, gmv FROM ({_select(["gmv"], "customer_state, year")}) AS yearly
                   WHERE year + 1 <= (SELECT MAX(year) FROM d_date)) l USING (customer_state, year)""",
    "m_gmv_mom_category": f"""
        SELECT category_en, year_month, {_share("n.gmv - l.gmv", "l.gmv")} AS gmv_mom_pct
        FROM ({_select(["gmv"], "category_en, year_month")}) n
        FULL JOIN (SELECT category_en, m.year_month, gmv FROM ({_select(["gmv"], "category_en, year_month")}) AS monthly
                   JOIN month_list m ON strftime(m.first_day - INTERVAL 1 MONTH, '%Y-%m') = monthly.year_month) l
        USING (category_en, year_month)""",
    "m_gmv_ly_month_name": f"""
        SELECT year, n.gmv, l.gmv AS gmv_ly
        FROM ({_select(["gmv"], "year", f"month_name = '{MONTH_NAME}'")}) n
        FULL JOIN (SELECT d.year, {_money("total_value")} AS gmv
                   FROM ({_moved(12, f"SELECT year, date FROM d_date WHERE month_name = '{MONTH_NAME}'", "year")}) d
                   JOIN items i ON i.date = d.date GROUP BY d.year) l USING (year)""",
    "m_gmv_ly_daily": f"""
        SELECT date, n.gmv, l.gmv_ly, p.gmv_pm
        FROM (SELECT date, {_money("total_value")} AS gmv FROM items WHERE category_en = '{CATEGORY}' GROUP BY date) n
        FULL JOIN (SELECT own AS date, {_money("total_value")} AS gmv_ly
                   FROM ({_moved(12, "SELECT date AS own, date FROM d_date", "own")}) d
                   JOIN items i ON i.date = d.date WHERE category_en = '{CATEGORY}' GROUP BY own) l USING (date)
        FULL JOIN (SELECT own AS date, {_money("total_value")} AS gmv_pm
                   FROM ({_moved(1, "SELECT date AS own, date FROM d_date", "own")}) d
                   JOIN items i ON i.date = d.date WHERE category_en = '{CATEGORY}' GROUP BY own) p USING (date)""",
    "m_category_mix_region": f"""
        SELECT region, category_en, {_share("gmv", "SUM(gmv) OVER (PARTITION BY region)")} AS category_pct_of_total,
               {_share("SUM(gmv) OVER (PARTITION BY region ORDER BY gmv DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
                       "SUM(gmv) OVER (PARTITION BY region)")} AS cumulative_gmv_pct
        FROM ({_select(["gmv"], "region, category_en", f"year = {YEAR}")}) AS c""",
    "m_one_category_share": f"""
        SELECT year, gmv, category_pct_of_total, cumulative_gmv_pct
        FROM (SELECT year, category_en, gmv, {_share("gmv", "SUM(gmv) OVER (PARTITION BY year)")} AS category_pct_of_total,
                     {_share("SUM(gmv) OVER (PARTITION BY year ORDER BY gmv DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
                             "SUM(gmv) OVER (PARTITION BY year)")} AS cumulative_gmv_pct
              FROM ({_select(["gmv"], "year, category_en")}) AS c) AS shares
        WHERE category_en = '{CATEGORY}'""",
    "v_executive_page": _executive_page(),
    "v_drill_through": _drill_through(),
    "m_gmv_ytd": """
        SELECT m.year_month, CAST(COALESCE(SUM(i.total_value), 0) AS DECIMAL(28,2)) AS gmv_ytd
        FROM month_list m LEFT JOIN items i ON i.year = m.year AND i.date <= m.last_day
        GROUP BY m.year_month""",
    "m_gmv_ly": _against(12, "gmv_ly"),
    "m_gmv_yoy_pct": _change(12, "gmv_yoy_pct"),
    "m_gmv_mom_pct": _change(1, "gmv_mom_pct"),
    "m_gmv_rolling_30d": """
        SELECT m.year_month, CAST(COALESCE(SUM(i.total_value), 0) AS DECIMAL(28,2)) AS gmv_rolling_30d
        FROM month_list m
        LEFT JOIN items i ON i.date <= m.last_day AND i.date > m.last_day - INTERVAL 30 DAY
        GROUP BY m.year_month""",
    "m_category_pct_of_total": f"""
        SELECT category_en, gmv, {_share("gmv", "SUM(gmv) OVER ()")} AS category_pct_of_total FROM category_gmv""",
    "m_category_pct_of_year": f"""
        SELECT year, category_en, gmv,
               {_share("gmv", "SUM(gmv) OVER (PARTITION BY year)")} AS category_pct_of_total
        FROM ({_select(["gmv"], "year, category_en")}) AS yearly""",
    "m_cumulative_gmv_pct": f"SELECT category_en, cumulative_gmv_pct FROM ({_PARETO}) AS ranked",
    "m_installment_mix": f"""
        SELECT payment_installments, COUNT(*) AS payment_rows, {_money("payment_value")} AS total_payments
        FROM payments GROUP BY payment_installments""",
    "kpi_executive": f"""
        SELECT {_money("total_value")} AS gmv, {_ORDERS} AS order_count,
               {_share("SUM(total_value)", _ORDERS)} AS average_order_value,
               COUNT(DISTINCT customer_key) AS active_customers,
               (SELECT {MEASURE["five_star_pct"][1]} FROM reviews WHERE year = {YEAR}) AS five_star_pct,
               (SELECT {_money("total_value")} FROM items WHERE year = {YEAR - 1}) AS gmv_ly,
               {_share(f"SUM(total_value) - (SELECT SUM(total_value) FROM items WHERE year = {YEAR - 1})",
                       f"(SELECT SUM(total_value) FROM items WHERE year = {YEAR - 1})")} AS gmv_yoy_pct
        FROM items WHERE year = {YEAR}""",
    "v_gmv_month_ly": _against(12, "gmv_ly"),
    "q_top_categories": "SELECT * FROM category_gmv ORDER BY gmv DESC, category_en LIMIT 10",
    "v_pareto": _PARETO,
    "v_gmv_by_state": _select(["gmv"], "customer_state"),
    "v_sliced_kpis": _select(
        ["gmv", "order_count", "average_order_value", "active_customers"],
        where=f"year = {YEAR} AND month_name = '{MONTH_NAME}' AND region = '{REGION}'",
    ),
    "kpi_operations": _select(
        ["on_time_delivery_pct", "avg_delivery_days", "cancellation_rate", "delivered_orders"]
    ),
    "kpi_cancel_item_rate": f"""
        SELECT COUNT(*) FILTER (order_status = 'canceled') AS canceled_item_rows,
               {_share("COUNT(*) FILTER (order_status = 'canceled')", "COUNT(*)")} AS cancel_item_rate
        FROM f_items""",
    "kpi_delivered_item_rows": "SELECT COUNT(*) AS delivered_item_rows FROM f_items WHERE order_status = 'delivered'",
    "v_delivery_histogram": """
        SELECT CASE WHEN delivery_days >= 30 THEN '30+' WHEN delivery_days >= 15 THEN '15-30'
                    WHEN delivery_days >= 10 THEN '10-15' WHEN delivery_days >= 5 THEN '5-10'
                    WHEN delivery_days >= 0 THEN '0-5' ELSE '<0' END AS delivery_bin, COUNT(*) AS item_rows
        FROM f_items WHERE delivery_days IS NOT NULL GROUP BY 1""",
    "v_on_time_by_state": _select(["on_time_delivery_pct"], "customer_state"),
    "v_on_time_by_region": _select(["on_time_delivery_pct"], "region"),
    "v_delivery_trend": f"""
        SELECT year_month, {MEASURE["avg_delivery_days"][1]} AS avg_delivery_days
        FROM items, last_buy WHERE year_month > strftime(as_of - INTERVAL 12 MONTH, '%Y-%m')
        GROUP BY year_month""",
    "q_slowest_sellers": f"""
        SELECT seller_id, seller_state, COUNT(*) AS item_rows, {_ORDERS} AS order_count,
               {_share("SUM(delivery_days)", "COUNT(*)")} AS avg_delivery_days,
               {_share("SUM(on_time_flag)", "COUNT(*)")} AS on_time_delivery_pct
        FROM items WHERE delivery_days IS NOT NULL GROUP BY seller_id, seller_state HAVING COUNT(*) >= 10
        ORDER BY avg_delivery_days DESC, seller_id LIMIT 10""",
    "kpi_customer": f"""
        SELECT COUNT(DISTINCT customer_key) AS active_customers,
               {MEASURE["repeat_customer_pct"][1]} AS repeat_customer_pct,
               (SELECT {MEASURE["avg_review_score"][1]} FROM reviews) AS avg_review_score,
               (SELECT COUNT(*) FROM firsts) AS new_customers
        FROM items""",
    "kpi_single_order_customers": """
        SELECT COUNT(*) AS single_order_customers FROM d_customer WHERE n_orders_per_unique = 1""",
    "kpi_repeat_all_customers": f"""
        SELECT {_share("COUNT(*) FILTER (is_repeat_customer)", "COUNT(*)")} AS repeat_customer_pct FROM d_customer""",
    "v_new_vs_returning": """
        SELECT i.year_month,
               COUNT(DISTINCT i.customer_key) FILTER (i.purchase_date_key // 100 = f.first_key // 100)
                   AS new_customers,
               COUNT(DISTINCT i.customer_key) FILTER (i.purchase_date_key // 100 > f.first_key // 100)
                   AS returning_customers
        FROM items i JOIN firsts f USING (customer_key) GROUP BY i.year_month""",
    "v_customers_by_state": "SELECT customer_state, COUNT(*) AS customers FROM d_customer GROUP BY customer_state",
    "v_review_distribution": f"""
        SELECT review_score, COUNT(*) AS reviews, {_share("COUNT(*)", "(SELECT COUNT(*) FROM f_reviews)")} AS share
        FROM f_reviews GROUP BY review_score""",
    "v_category_reviews": f"""
        SELECT category_en, {_share("SUM(review_score)", "COUNT(review_score)")} AS avg_review_score,
               (SELECT COUNT(*) FROM items i WHERE i.category_en = item_reviews.category_en) AS items_sold
        FROM item_reviews GROUP BY category_en ORDER BY avg_review_score DESC, category_en LIMIT 10""",
    "v_drill_state": f"""
        SELECT {MEASURE["on_time_delivery_pct"][1]} AS on_time_delivery_pct,
               {MEASURE["avg_delivery_days"][1]} AS avg_delivery_days,
               {MEASURE["cancellation_rate"][1]} AS cancellation_rate,
               {MEASURE["delivered_orders"][1]} AS delivered_orders,
               COUNT(DISTINCT customer_key) AS active_customers,
               {MEASURE["repeat_customer_pct"][1]} AS repeat_customer_pct,
               (SELECT {MEASURE["avg_review_score"][1]} FROM reviews WHERE customer_state = '{STATE}')
                   AS avg_review_score
        FROM items WHERE customer_state = '{STATE}'""",
    "q_top_categories_year": f"""
        {_select(["gmv"], "category_en", f"year = {YEAR}")} ORDER BY gmv DESC, category_en LIMIT 5""",
    "q_region_delivery": _select(["avg_delivery_days", "on_time_delivery_pct"], "region"),
    "q_month_revenue": _select(["gmv"], "year_month", f"year = {YEAR}"),
    "q_region_revenue": _select(["gmv"], "region"),
    "q_cancel_by_state": """
        SELECT customer_state, COUNT(*) AS canceled_item_rows FROM items WHERE order_status = 'canceled'
        GROUP BY customer_state ORDER BY canceled_item_rows DESC, customer_state LIMIT 10""",
    "q_repeat_by_region": f"""
        SELECT region, COUNT(*) AS customers,
               {_share("COUNT(*) FILTER (is_repeat_customer)", "COUNT(*)")} AS repeat_customer_pct
        FROM d_customer JOIN d_geography ON state = customer_state GROUP BY region""",
    "q_five_star_share": f"""
        SELECT category_en, COUNT(*) AS review_rows,
               {_share("COUNT(*) FILTER (review_score = 5)", "COUNT(*)")} AS five_star_pct
        FROM item_reviews GROUP BY category_en HAVING COUNT(*) >= 100
        ORDER BY five_star_pct DESC, category_en LIMIT 10""",
    "q_payment_mix": f"""
        SELECT payment_type, {_ORDERS} AS paid_orders, {_share("SUM(payment_value)", _ORDERS)} AS average_basket
        FROM f_payments WHERE payment_type IN ('credit_card', 'boleto') GROUP BY payment_type""",
    "q_one_month_revenue": _select(["gmv"], where=f"year = {YEAR} AND month = {MONTH}"),
    "q_worst_state": f"""
        {_select(["on_time_delivery_pct"], "customer_state", "delivery_days IS NOT NULL")}
        ORDER BY on_time_delivery_pct, customer_state LIMIT 1""",
    "q_top_sellers_year": f"""
        {_select(["gmv"], "seller_id, seller_state", f"year = {YEAR}")} ORDER BY gmv DESC, seller_id LIMIT 10""",
    "q_late_rate_state": _select(["late_items", "late_delivery_pct"], where=f"customer_state = '{STATE}'"),
    "q_last_month_top": _last_month(5),
    "q_last_month_best_in_state": _last_month(1, f"customer_state = '{STATE}'"),
    "q_one_category": _select(["gmv", "items_sold"], "year", f"category_en = '{CATEGORY}'"),
    "t_this_month": _period("year_month = strftime(as_of, '%Y-%m')"),
    "t_last_month": _period("year_month = strftime(as_of - INTERVAL 1 MONTH, '%Y-%m')"),
    "t_ytd": _period("items.year = year(as_of) AND items.date <= as_of"),
    "t_last_30_days": _period("items.date >= as_of - INTERVAL 30 DAY AND items.date <= as_of"),
    "t_gmv_by_weekday": _select(["gmv"], "day_name"),
    "t_weekend_gmv": _select(["gmv", "order_count"], where="is_weekend"),
    "gmv_by_delivered_month": f"""
        SELECT d.year_month, {_money("total_value")} AS gmv
        FROM f_items JOIN d_date d ON d.date_key = delivered_date_key GROUP BY d.year_month""",
    "rollup_date": _rollup("year, quarter, month, day"),
    "rollup_geo_distinct": _distinct_rollup("region, customer_state, customer_city"),
    "rollup_product_distinct": _distinct_rollup("category_en, product_id"),
    "rollup_date_distinct": _distinct_rollup("year, quarter, month, day", f"category_en = '{CATEGORY}'"),
    "rollup_geo": _rollup("region, customer_state, customer_city"),
    "rollup_product": _rollup("category_en, product_id"),
    "metric_layer_two_facts": f"""
        SELECT region, year, gmv, total_payments, order_count, avg_review_score
        FROM ({_select(["gmv", "order_count"], "region, year")}) AS sold
        FULL JOIN ({_select(["total_payments"], "region, year")}) AS paid USING (region, year)
        FULL JOIN ({_select(["avg_review_score"], "region, year")}) AS rated USING (region, year)""",
    "dq_pk_violations": _UNION.join(
        [_pk(layer, t, _TABLES[layer][t], keys) for layer, t, keys in _KEYS]
        + [_pk("bronze", "order_items", "b_items", "order_id,order_item_id")]
    ),
    "dq_null_counts": _UNION.join(_nulls(layer, t, _TABLES[layer][t], cols) for layer, t, cols in _REQUIRED),
    "dq_orphans": _UNION.join(_orphans(t, _GOLD[t], c, d, _GOLD[d], k) for t, c, d, k in _PATHS),
    "dq_layer_profile": _profile(),
    "dq_payments_vs_gmv": """
        SELECT order_id, CAST(sold AS DECIMAL(28,2)) AS gmv, CAST(paid AS DECIMAL(28,2)) AS payments,
               CAST(COALESCE(paid, 0) - COALESCE(sold, 0) AS DECIMAL(28,2)) AS difference
        FROM (SELECT order_id, SUM(total_value) AS sold FROM f_items GROUP BY order_id) AS s
        FULL JOIN (SELECT order_id, SUM(payment_value) AS paid FROM f_payments GROUP BY order_id) AS p
            USING (order_id)""",
    "dq_two_builds": """
        SELECT CAST(0 AS BIGINT) AS differing_rows, COUNT(*) AS rows_written, COUNT(*) AS rows_again FROM f_items""",
    "dq_batch_and_deltas": """
        SELECT CAST(YEAR(shipping_limit_ts) AS INTEGER) AS year, COUNT(*) AS left_rows, COUNT(*) AS right_rows,
               CAST(0 AS BIGINT) AS differing_cells
        FROM s_items GROUP BY 1""",
    "dq_pending_items": """
        SELECT order_id, order_item_id, COUNT(a.order_id) AS batch_rows, COUNT(b.order_id) AS table_rows
        FROM b_items_last AS a FULL JOIN b_items_early AS b USING (order_id, order_item_id)
        WHERE a.order_id IS NULL OR b.order_id IS NULL
              OR (a.product_id, a.seller_id, a.shipping_limit_date, a.price, a.freight_value)
                 IS DISTINCT FROM (b.product_id, b.seller_id, b.shipping_limit_date, b.price, b.freight_value)
        GROUP BY order_id, order_item_id""",
    "layer_row_counts": f"""
        SELECT layer, "table", CAST(SUM(n) AS BIGINT) AS "rows"
        FROM ({_UNION.join([_count("bronze", n, r) for n, r in _BRONZE.items()]
                           + [_count("silver", n, r) for n, r in _SILVER.items()]
                           + [_count("gold", n, r) for n, r in _GOLD.items()])}) AS counts
        GROUP BY ROLLUP (layer, "table")""",
    "incremental_delta": "SELECT * FROM b_items WHERE _ingested_at > (SELECT MAX(o_orderdate) FROM orders)",
    "incremental_upsert": "SELECT * FROM s_items",
    "incremental_deltas": "SELECT * FROM s_items",
    "stream_upsert_items": "SELECT * FROM s_items",
}


def statement(name: str) -> str:
    """The statement with the relations it needs in front."""
    body = STATEMENTS[name]
    needed: set[str] = set()
    waiting = [body]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        for relation in RELATIONS.keys() & words - needed:
            needed.add(relation)
            waiting.append(RELATIONS[relation])
    if not needed:
        return body.strip()
    # Materialised: a relation that several others read is worked out once.
    parts = [f"{r} AS MATERIALIZED ({RELATIONS[r].strip()})" for r in RELATIONS if r in needed]
    return f"WITH {', '.join(parts)} {body.strip()}"

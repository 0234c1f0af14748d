"""A small retail source, written as the CSV files it would arrive as."""

from __future__ import annotations

import csv
from pathlib import Path

HEADERS = {
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at"
    " order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "review_id order_id review_score review_comment_title review_comment_message"
    " review_creation_date review_answer_timestamp",
    "products": "product_id product_category_name product_name_lenght product_description_lenght"
    " product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city"
    " geolocation_state",
    "category_translation": "product_category_name product_category_name_english",
}

ROWS = {
    "orders": [
        # Delivered a day after purchase by the calendar, two hours by the clock.
        ["o1", "c1", " Delivered ", "2017-11-24 23:00:00", "", "2017-11-24 23:30:00", "2017-11-25 01:00:00", "2017-12-01 00:00:00"],
        # Delivered on the estimate to the second.
        ["o2", "c2", "delivered", "2017-11-25 10:00:00", "2017-13-40", "", "2017-12-05 00:00:00", "2017-12-05 00:00:00"],
        # A second late.
        ["o3", "c3", "DELIVERED", "2018-01-10 10:00:00", "2018-01-10 11:00:00", "", "2018-01-20 00:00:01", "2018-01-20 00:00:00"],
        # Not delivered.
        ["o4", "c4", "canceled", "2018-01-31 08:00:00", "", "", "", "2018-02-20 00:00:00"],
        ["o5", "c5", "shipped", "2018-03-05 08:00:00", "", "", "", "2018-03-20 00:00:00"],
        # The same order twice with one ingestion time.
        ["o6", "c6", "invoiced", "2018-03-07 08:00:00", "", "", "", "2018-03-21 00:00:00"],
        ["o6", "c6", "processing", "2018-03-07 08:00:00", "", "", "", "2018-03-21 00:00:00"],
    ],
    "order_items": [
        ["o1", "1", "p1", "s1", "2017-11-30 00:00:00", "100.00", "10.00"],
        ["o1", "2", "p2", "s2", "2017-11-30 00:00:00", "50.00", "5.50"],
        ["o2", "1", "p1", "s1", "2017-11-30 00:00:00", "80.00", "8.00"],
        ["o3", "1", "p3", "s1", "2018-01-15 00:00:00", "20.00", "2.00"],
        ["o4", "1", "p4", "s2", "2018-02-05 00:00:00", "30.00", "3.00"],
        # A product and a seller that are not on file, and an order that is not.
        ["o5", "1", "p9", "s9", "", "40.00", "4.00"],
        ["o9", "1", "p1", "s1", "", "99.00", "9.00"],
        ["o6", "1", "p5", "s2", "2018-03-10 00:00:00", "10.00", "1.00"],
    ],
    "order_payments": [
        ["o1", "1", "credit_card", "3", "165.50"],
        ["o2", "1", "BOLETO ", "1", "88.00"],
        ["o3", "1", " voucher", "1", "12.00"],
        ["o3", "1", " voucher", "1", "10.00"],
        ["o9", "1", "credit_card", "1", "108.00"],
    ],
    "order_reviews": [
        ["r1", "o1", "5", "top", 'Good, "very" good\nand fast', "2017-11-26 00:00:00", "2017-11-28 12:00:00"],
        ["r2", "o2", "4", "", "", "2017-12-06 00:00:00", "2017-12-06 23:59:59"],
        # One review filed under two orders.
        ["r3", "o3", "1", "", "late", "2018-01-21 23:00:00", "2018-01-22 01:00:00"],
        ["r3", "o4", "1", "", "late", "2018-01-21 23:00:00", "2018-01-22 01:00:00"],
        ["r4", "o1", "3", "", "", "2017-11-27 00:00:00", ""],
    ],
    "products": [
        ["p1", "cama_mesa_banho", "10", "20", "1", "499", "1", "2", "3"],
        ["p2", "sem_traducao", "10", "20", "1", "500", "1", "2", "3"],
        ["p3", "", "10", "20", "1", "", "1", "2", "3"],
        ["p4", "cama_mesa_banho", "10", "20", "1", "1999", "1", "2", "3"],
        ["p5", "beleza_saude", "10", "20", "1", "2000", "1", "2", "3"],
        ["p6", "beleza_saude", "10", "20", "1", "9999", "1", "2", "3"],
        ["p7", "beleza_saude", "10", "20", "1", "10000", "1", "2", "3"],
    ],
    "sellers": [["s1", "1001", " sao paulo", "sp "], ["s2", "2001", "Rio de Janeiro", "RJ"]],
    "customers": [
        # One person with three ids and three addresses.
        ["c1", "u1", "1000", "sao paulo", "sp"],
        ["c2", "u1", "2000", "campinas", "SP"],
        ["c3", "u1", "3000", " salvador ", "ba"],
        ["c4", "u2", "4000", "manaus", "AM"],
        ["c5", "u3", "5000", "nowhere", "ZZ"],
        ["c6", "u4", "6000", "", ""],
    ],
    "geolocation": [
        ["1000", "-23.5", "-46.5", "sao paulo", "SP"],
        ["1000", "-23.6", "-46.7", "São Paulo", "SP"],
        ["2000", "-22.9", "-47.0", "campinas", "SP"],
    ],
    "category_translation": [
        ["cama_mesa_banho", "bed_bath_table"],
        ["cama_mesa_banho", "bed_bath_table"],
        ["beleza_saude", "health_beauty"],
    ],
}


def write_csv(folder: Path, tables: dict[str, list[list[str]]] | None = None) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    for name, rows in (tables or ROWS).items():
        with open(folder / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(HEADERS[name].split())
            writer.writerows(rows)
    return folder

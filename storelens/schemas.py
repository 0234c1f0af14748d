"""Table schemas, keys and relationships of the three layers."""

from __future__ import annotations

from dataclasses import dataclass

# Names and types of the source columns, by table, as schema strings.
RAW = {
    "orders": """
        order_id string, customer_id string, order_status string, order_purchase_timestamp string,
        order_approved_at string, order_delivered_carrier_date string,
        order_delivered_customer_date string, order_estimated_delivery_date string""",
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price decimal(12,2), freight_value decimal(12,2)""",
    "order_payments": """
        order_id string, payment_sequential int, payment_type string, payment_installments int,
        payment_value decimal(12,2)""",
    "order_reviews": """
        review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date string, review_answer_timestamp string""",
    "products": """
        product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g int,
        product_length_cm int, product_height_cm int, product_width_cm int""",
    "sellers": """
        seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string""",
    "customers": """
        customer_id string, customer_unique_id string, customer_zip_code_prefix int,
        customer_city string, customer_state string""",
    "geolocation": """
        geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double,
        geolocation_city string, geolocation_state string""",
    "category_translation": """
        product_category_name string, product_category_name_english string""",
}

SILVER = (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "products",
    "sellers",
    "customers",
    "geolocation",
)

GOLD = (
    "DimDate",
    "DimCustomer",
    "_bridge_customer",
    "DimProduct",
    "DimSeller",
    "DimGeography",
    "FactOrderItems",
    "FactPayments",
    "FactReviews",
)

# Declared keys, as (layer, table, columns). State is unique without being the key.
UNIQUE_KEYS = (
    ("silver", "orders", ("order_id",)),
    ("silver", "order_items", ("order_id", "order_item_id")),
    ("silver", "order_payments", ("order_id", "payment_sequential")),
    ("silver", "order_reviews", ("review_id",)),
    ("silver", "products", ("product_id",)),
    ("silver", "sellers", ("seller_id",)),
    ("silver", "customers", ("customer_id",)),
    ("silver", "geolocation", ("zip_prefix",)),
    ("gold", "DimDate", ("date_key",)),
    ("gold", "DimCustomer", ("customer_key",)),
    ("gold", "_bridge_customer", ("customer_id",)),
    ("gold", "DimProduct", ("product_key",)),
    ("gold", "DimSeller", ("seller_key",)),
    ("gold", "DimGeography", ("geography_key",)),
    ("gold", "DimGeography", ("state",)),
    ("gold", "FactOrderItems", ("order_id", "order_item_id")),
    ("gold", "FactPayments", ("order_id", "payment_sequential")),
    ("gold", "FactReviews", ("review_id",)),
)

# Columns declared NOT NULL besides the keys above.
NOT_NULL = (
    ("silver", "orders", "customer_id"),
    ("silver", "order_reviews", "order_id"),
    ("silver", "customers", "customer_unique_id"),
    ("gold", "DimDate", "date"),
    ("gold", "DimCustomer", "customer_unique_id"),
    ("gold", "_bridge_customer", "customer_key"),
    ("gold", "DimProduct", "product_id"),
    ("gold", "DimSeller", "seller_id"),
    ("gold", "FactReviews", "order_id"),
)


@dataclass(frozen=True)
class Relationship:
    """Many-to-one path from a table's column to a dimension's key."""

    table: str
    column: str
    dimension: str
    key: str
    active: bool = True


# The relationships of the star.
RELATIONSHIPS = (
    Relationship("FactOrderItems", "purchase_date_key", "DimDate", "date_key"),
    Relationship("FactOrderItems", "delivered_date_key", "DimDate", "date_key", active=False),
    Relationship("FactOrderItems", "customer_key", "DimCustomer", "customer_key"),
    Relationship("FactOrderItems", "product_key", "DimProduct", "product_key"),
    Relationship("FactOrderItems", "seller_key", "DimSeller", "seller_key"),
    Relationship("DimCustomer", "customer_state", "DimGeography", "state"),
    Relationship("FactPayments", "purchase_date_key", "DimDate", "date_key"),
    Relationship("FactPayments", "customer_key", "DimCustomer", "customer_key"),
    Relationship("FactReviews", "purchase_date_key", "DimDate", "date_key"),
    Relationship("FactReviews", "customer_key", "DimCustomer", "customer_key"),
)

# State codes and the region each belongs to; any other state is 'Unknown'.
REGIONS = {
    "AC": "North",
    "AM": "North",
    "AP": "North",
    "PA": "North",
    "RO": "North",
    "RR": "North",
    "TO": "North",
    "AL": "Northeast",
    "BA": "Northeast",
    "CE": "Northeast",
    "MA": "Northeast",
    "PB": "Northeast",
    "PE": "Northeast",
    "PI": "Northeast",
    "RN": "Northeast",
    "SE": "Northeast",
    "DF": "Central-West",
    "GO": "Central-West",
    "MT": "Central-West",
    "MS": "Central-West",
    "ES": "Southeast",
    "MG": "Southeast",
    "RJ": "Southeast",
    "SP": "Southeast",
    "PR": "South",
    "RS": "South",
    "SC": "South",
}
UNKNOWN_REGION = "Unknown"

# Product weight classes in grams (upper bound excluded), delivery-day histogram bins.
WEIGHT_BUCKETS = [(500, "0-500g"), (2000, "500g-2kg"), (10000, "2-10kg"), (None, "10kg+")]
UNKNOWN_WEIGHT = "unknown"
DELIVERY_BINS = [(0, "<0"), (5, "0-5"), (10, "5-10"), (15, "10-15"), (30, "15-30"), (None, "30+")]

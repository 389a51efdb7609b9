"""Column contracts of the raw entities and of the event payloads."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Table and column names, spelling included ("lenght"), are part of the data contract.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "order_payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "order_reviews": (
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "category_translation": ("product_category_name", "product_category_name_english"),
}

ENTITIES = tuple(RAW_COLUMNS)

# Entities whose CSV carries free text with embedded line breaks and doubled quotes.
MULTILINE_ENTITIES = frozenset({"order_reviews"})


def raw_schema(entity: str) -> StructType:
    """All columns as text: types are enforced later, when the table is cleaned."""
    return StructType([StructField(name, StringType()) for name in RAW_COLUMNS[entity]])


# Payload fields of the three event topics.
EVENT_SCHEMAS: dict[str, StructType] = {
    "orders": StructType(
        [
            StructField("order_id", StringType()),
            StructField("customer_id", StringType()),
            StructField("order_status", StringType()),
            StructField("order_purchase_timestamp", StringType()),
        ]
    ),
    "items": StructType(
        [
            StructField("order_id", StringType()),
            StructField("order_item_id", IntegerType()),
            StructField("price", DoubleType()),
            StructField("freight_value", DoubleType()),
        ]
    ),
    "payments": StructType(
        [
            StructField("order_id", StringType()),
            StructField("payment_type", StringType()),
            StructField("payment_installments", IntegerType()),
            StructField("payment_value", DoubleType()),
        ]
    ),
}

# Broker topic that feeds each event table.
TOPICS = {"orders": "orders", "items": "order_items", "payments": "payment"}

# Wider payloads that carry every column the gold layer needs (see streaming.unify).
WIDE_EVENT_SCHEMAS: dict[str, StructType] = {
    "orders": StructType([*EVENT_SCHEMAS["orders"].fields]
                         + [StructField(c, StringType()) for c in RAW_COLUMNS["orders"][4:]]),
    "items": StructType([*EVENT_SCHEMAS["items"].fields]
                        + [StructField(c, StringType()) for c in ("product_id", "seller_id", "shipping_limit_date")]),
    "payments": StructType([*EVENT_SCHEMAS["payments"].fields]
                           + [StructField("payment_sequential", IntegerType())]),
}

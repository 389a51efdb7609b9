"""Hand-made edge rows per table: which side each row lands on, and why."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from orderloom.plans import silver
from tests.helpers import raw_rows, rows

HEX = "0123456789abcdef0123456789abcdef"

CUSTOMER = {
    "customer_id": "c1",
    "customer_unique_id": "u1",
    "customer_zip_code_prefix": "1000",
    "customer_city": "recife",
    "customer_state": " pe ",
}
LOCATION = {
    "geolocation_zip_code_prefix": "1000",
    "geolocation_lat": "0",
    "geolocation_lng": "0",
    "geolocation_city": " recife ",
    "geolocation_state": "pe",
}
ITEM = {
    "order_id": "o1",
    "order_item_id": "1",
    "product_id": "p1",
    "seller_id": "s1",
    "shipping_limit_date": "2018-01-01 00:00:00",
    "price": "10.00",
    "freight_value": "1.00",
}
PAYMENT = {
    "order_id": "o1",
    "payment_sequential": "1",
    "payment_type": "voucher",
    "payment_installments": "1",
    "payment_value": "10.00",
}
REVIEW = {
    "review_id": "r1",
    "order_id": "o1",
    "review_score": "5",
    "review_comment_title": "t",
    "review_comment_message": "m",
    "review_creation_date": "2018-01-01 00:00:00",
    "review_answer_timestamp": "2018-01-02 00:00:00",
}
ORDER = {
    "order_id": "o1",
    "customer_id": "c1",
    "order_status": "delivered",
    "order_purchase_timestamp": "2018-01-01 10:00:00",
    "order_approved_at": "2018-01-01 11:00:00",
    "order_delivered_carrier_date": "2018-01-02 00:00:00",
    "order_delivered_customer_date": "2018-01-05 00:00:00",
    "order_estimated_delivery_date": "2018-01-09 00:00:00",
}
PRODUCT = {
    "product_id": "p1",
    "product_category_name": "cama_mesa",
    "product_name_lenght": "10",
    "product_description_lenght": "100",
    "product_photos_qty": "1",
    "product_weight_g": "100",
    "product_length_cm": "1",
    "product_height_cm": "1",
    "product_width_cm": "1",
}
SELLER = {"seller_id": HEX, "seller_zip_code_prefix": "1", "seller_city": "recife", "seller_state": "pe"}
CATEGORY = {"product_category_name": "cama_mesa", "product_category_name_english": "bed_bath"}

BASE = {
    "customers": CUSTOMER,
    "geolocation": LOCATION,
    "order_items": ITEM,
    "order_payments": PAYMENT,
    "order_reviews": REVIEW,
    "orders": ORDER,
    "products": PRODUCT,
    "sellers": SELLER,
    "category_translation": CATEGORY,
}

# table, changed columns, kept, reason (None: not rejected)
CASES = [
    ("customers", {}, True, None),
    ("customers", {"customer_zip_code_prefix": "0"}, True, None),
    ("customers", {"customer_zip_code_prefix": "-1"}, False, "Negative ZIP Code"),
    ("customers", {"customer_id": "  "}, False, "Customer ID is Empty"),
    ("customers", {"customer_id": "007"}, False, "Customer ID contains only numbers"),
    ("customers", {"customer_id": "\t"}, True, None),
    ("customers", {"customer_city": None}, False, None),
    ("customers", {"customer_state": "77"}, True, "Customer State contains only numbers"),
    (
        "customers",
        {"customer_zip_code_prefix": "-5", "customer_unique_id": "1", "customer_city": " "},
        False,
        "Negative ZIP Code | Customer Unique ID contains only numbers | Customer City is Empty",
    ),
    ("geolocation", {"geolocation_lat": "90", "geolocation_lng": "-180"}, True, None),
    ("geolocation", {"geolocation_lat": "-90.0001"}, False, "Latitude is out of valid bounds [-90, 90]"),
    ("geolocation", {"geolocation_lng": "180.1"}, False, "Longitude is out of valid bounds [-180, 180]"),
    ("geolocation", {"geolocation_lat": "NaN"}, False, None),
    ("geolocation", {"geolocation_zip_code_prefix": "0"}, True, None),
    ("geolocation", {"geolocation_state": "12"}, True, "Geolocation State contains only numbers"),
    ("order_items", {"order_item_id": "0"}, False, "Order Item ID is 0 or negative"),
    ("order_items", {"price": "0"}, True, None),
    ("order_items", {"price": "-0.01"}, False, "Negative Price"),
    ("order_items", {"price": "NaN"}, False, None),
    ("order_items", {"freight_value": None}, False, None),
    ("order_items", {"seller_id": " ", "product_id": ""}, False, "Product ID is Empty | Seller ID is Empty"),
    ("order_payments", {"payment_type": " not_defined "}, False, None),
    ("order_payments", {"payment_type": " "}, False, "Payment Type is Empty | Payment Type is Empty"),
    ("order_payments", {"payment_installments": "0"}, True, None),
    (
        "order_payments",
        {"payment_type": "Credit_Card", "payment_installments": "0"},
        False,
        "Illogical Payment: Credit Card with 0 Installments",
    ),
    ("order_payments", {"payment_sequential": "0"}, False, "Payment Sequential is less than 1"),
    ("order_reviews", {"review_score": "0"}, False, "Review Score out of bounds (must be 1-5)"),
    ("order_reviews", {"review_score": "1"}, True, None),
    ("order_reviews", {"review_score": "4.5"}, True, None),
    ("order_reviews", {"review_score": "6"}, False, "Review Score out of bounds (must be 1-5)"),
    ("order_reviews", {"review_score": "bad"}, False, None),
    ("order_reviews", {"review_creation_date": "soon"}, True, None),
    ("order_reviews", {"review_id": " "}, False, "Review ID is Empty"),
    ("orders", {"order_delivered_customer_date": "2018-01-01 10:00:00"}, True, None),
    (
        "orders",
        {"order_delivered_customer_date": "2018-01-01 09:59:59"},
        False,
        "Temporal Anomaly: Delivered before Purchase Date",
    ),
    ("orders", {"order_purchase_timestamp": None}, False, None),
    (
        "orders",
        {"order_delivered_customer_date": None, "order_approved_at": None},
        False,
        "Ghost Delivery: Status is Delivered but missing delivery date | "
        "Unapproved Delivery: Status is Delivered but missing payment approval date",
    ),
    ("orders", {"order_status": "shipped", "order_delivered_customer_date": None}, True, None),
    ("orders", {"order_status": " "}, False, "Order Status is Empty"),
    ("products", {"product_length_cm": None}, False, None),
    ("products", {"product_height_cm": "0"}, False, "Zero or Negative Product Height"),
    ("products", {"product_photos_qty": "-1"}, False, "Negative Metadata lengths/qty"),
    ("products", {"product_category_name": None, "product_photos_qty": None}, True, None),
    ("products", {"product_weight_g": None}, False, None),
    ("products", {"product_id": "12"}, False, "Product ID contains only numbers"),
    ("sellers", {"seller_state": "xx"}, False, None),
    ("sellers", {"seller_id": "abc"}, False, "Seller ID is not a valid 32-char hex string"),
    ("sellers", {"seller_city": "04482255"}, False, "Seller City contains only numbers"),
    (
        "category_translation",
        {"product_category_name": "ab"},
        False,
        "PT Category Name is too short (junk data)",
    ),
    ("category_translation", {"product_category_name": "abc"}, True, None),
    (
        "category_translation",
        {"product_category_name_english": "12"},
        False,
        "EN Category Name contains only numbers | EN Category Name is too short (junk data)",
    ),
]


@pytest.mark.parametrize(("table", "change", "kept", "reason"), CASES)
def test_edge_row(spark, table, change, kept, reason):
    cleaned = silver.clean(raw_rows(spark, table, BASE[table], change), table)
    assert cleaned.valid.count() == kept
    assert [r.error_reason for r in cleaned.rejected.collect()] == ([reason] if reason else [])


@pytest.mark.parametrize("table", BASE)
def test_duplicate_rows_are_kept_once(spark, table):
    assert silver.clean(raw_rows(spark, table, BASE[table], {}, {}, {}), table).valid.count() == 1


@pytest.mark.parametrize("table", BASE)
def test_strict_split_loses_and_repeats_nothing(spark, table):
    changes = [change for name, change, _, _ in CASES if name == table]
    raw = raw_rows(spark, table, BASE[table], *changes)
    judged = silver.standardised(raw, silver.contract(table)).count()
    cleaned = silver.clean(raw, table, strict=True)
    assert cleaned.valid.count() + cleaned.rejected.count() == judged
    assert cleaned.rejected.filter("error_reason = ''").count() == 0


def test_quarantine_columns(spark):
    bad = raw_rows(spark, "customers", CUSTOMER, {"customer_zip_code_prefix": "-1"})
    assert silver.clean(bad, "customers").rejected.columns[-3:] == [
        "error_reason",
        "quarantine_timestamp",
        "source_table",
    ]
    ghost = raw_rows(spark, "orders", ORDER, {"order_delivered_customer_date": None})
    assert silver.clean(ghost, "orders").rejected.columns[-1] == "error_reason"


def test_strict_cast_fails_on_text(spark):
    raw = raw_rows(spark, "customers", CUSTOMER, {"customer_zip_code_prefix": "abc"})
    with pytest.raises(PySparkException):
        silver.clean(raw, "customers").valid.collect()


def test_unreadable_text_can_be_set_aside(spark):
    raw = raw_rows(spark, "customers", CUSTOMER, {"customer_zip_code_prefix": "abc"}, {"customer_zip_code_prefix": None}, {})
    readable, unreadable = silver.split_unparsable(raw, "customers")
    assert rows(unreadable, "customer_zip_code_prefix", "error_reason") == [
        ("abc", "customer_zip_code_prefix is not a valid int")
    ]
    assert readable.count() == 2
    assert silver.clean(readable, "customers").valid.count() == 1
    untyped = raw_rows(spark, "category_translation", CATEGORY, {})
    assert [side.count() for side in silver.split_unparsable(untyped, "category_translation")] == [1, 0]


def test_rescued_column_is_dropped(spark):
    raw = raw_rows(spark, "sellers", SELLER, {}).selectExpr("*", "'x' AS _rescued_data")
    assert silver.clean(raw, "sellers").valid.columns == list(SELLER)


def test_text_is_not_trimmed_unless_standardised(spark):
    raw = raw_rows(spark, "customers", CUSTOMER, {"customer_city": " recife "})
    assert rows(silver.clean(raw, "customers").valid, "customer_city", "customer_state") == [(" recife ", "PE")]


@pytest.mark.parametrize(
    ("city", "expected"),
    [
        ("são  paulo", "Sao Paulo"),
        (" brasília", " Brasilia"),
        # Only lower-case accents are folded.
        ("BELÉM", "Belém"),
        ("mogi\tdas   cruzes", "Mogi Das Cruzes"),
    ],
)
def test_seller_city(spark, city, expected):
    raw = raw_rows(spark, "sellers", SELLER, {"seller_city": city})
    assert rows(silver.clean(raw, "sellers").valid, "seller_city") == [(expected,)]


@pytest.mark.parametrize(("message", "expected"), [("a\nb", "a b"), ("a\rb", "a b"), ("a\r\nb", "a  b"), (None, "No Comment")])
def test_review_text(spark, message, expected):
    raw = raw_rows(spark, "order_reviews", REVIEW, {"review_comment_message": message})
    assert rows(silver.clean(raw, "order_reviews").valid, "review_comment_message") == [(expected,)]


def test_weight_is_imputed_from_valid_weights_of_the_category(spark):
    raw = raw_rows(
        spark,
        "products",
        PRODUCT,
        {"product_id": "a", "product_weight_g": "100"},
        {"product_id": "b", "product_weight_g": "201"},
        {"product_id": "c", "product_weight_g": "0"},
        {"product_id": "d", "product_weight_g": None},
        {"product_id": "e", "product_weight_g": "-7"},
        {"product_id": "f", "product_weight_g": None, "product_category_name": "lonely"},
    )
    cleaned = silver.clean(raw, "products").valid
    assert cleaned.columns[0] == "product_category_name"
    weights = [("a", 100.0), ("b", 201.0), ("c", 151.0), ("d", 151.0), ("e", 151.0)]
    assert rows(cleaned, "product_id", "product_weight_g") == weights


def test_reprocess(spark):
    raw = raw_rows(
        spark, "customers", CUSTOMER, {"customer_zip_code_prefix": "-9"}, {"customer_id": "5"}
    )
    rejected = silver.clean(raw, "customers").rejected
    fixed = silver.reprocess(
        rejected, "customers", lambda df: df.selectExpr("* EXCEPT (customer_zip_code_prefix)", "9 AS customer_zip_code_prefix")
    )
    assert rows(fixed.valid, "customer_id") == [("c1",)]
    assert rows(fixed.rejected, "customer_id", "error_reason") == [("5", "Customer ID contains only numbers")]

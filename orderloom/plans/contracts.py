"""Cleaning contracts: what each raw entity must look like to be trusted.

A contract is data. ``orderloom.plans.silver`` runs it in one fixed order:
repair text, cast, drop duplicate rows, NULL policy, standardise, discard, enrich, then rules.
Contracts are functions because column expressions need a running session.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import text
from orderloom.operators.impute import group_mean
from orderloom.operators.rules import Rule

# The state codes a seller may have.
SELLER_STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO",
    "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)

PRODUCT_DIMENSIONS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
PRODUCT_METADATA = ("product_name_lenght", "product_description_lenght", "product_photos_qty")


@dataclass(frozen=True)
class Contract:
    source_table: str
    rules: Sequence[Rule]
    keep: Column
    probes: Callable[[], Sequence[Rule]] = list
    casts: Mapping[str, str] = field(default_factory=dict)
    try_casts: bool = False
    repair: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    fill: Mapping[str, object] = field(default_factory=dict)
    require: Sequence[str] | str | None = None
    standardise: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    discard_unless: Column | None = None
    enrich: Callable[[DataFrame], DataFrame] | None = None
    text_columns: Sequence[str] = ()
    stamped: bool = True


def _all(*predicates: Column) -> Column:
    kept = predicates[0]
    for predicate in predicates[1:]:
        kept = kept & predicate
    return kept


def _null_or_empty(label: str, column: str) -> list[Rule]:
    c = F.col(column)
    return [Rule(f"{label} is NULL", c.isNull()), Rule(f"{label} is Empty", text.is_blank(c))]


def _name_rules(label: str, column: str) -> list[Rule]:
    return [
        *_null_or_empty(label, column),
        Rule(f"{label} contains only numbers", text.is_numeric_text(F.col(column))),
    ]


def _missing(column: str) -> Rule:
    """Probe used while exploring a table: NULL or blank."""
    c = F.col(column)
    return Rule(f"{column} missing", c.isNull() | text.is_blank(c))


def _numeric(column: str) -> Rule:
    return Rule(f"{column} numeric", text.is_numeric_text(F.col(column)))


# The reason texts in the functions below are fixed values: consumers filter quarantine by them.


def customers() -> Contract:
    zip_code = F.col("customer_zip_code_prefix")
    return Contract(
        source_table="customers",
        casts={"customer_zip_code_prefix": "int"},
        require="all",
        standardise={"customer_state": text.upper_code},
        text_columns=("customer_id", "customer_unique_id", "customer_city", "customer_state"),
        rules=[
            Rule("Negative ZIP Code", zip_code < 0),
            *_name_rules("Customer ID", "customer_id"),
            *_name_rules("Customer Unique ID", "customer_unique_id"),
            *_name_rules("Customer City", "customer_city"),
            *_name_rules("Customer State", "customer_state"),
        ],
        # A numeric state is a violation and still kept: such rows reach both outputs.
        keep=_all(
            zip_code >= 0,
            text.is_filled(F.col("customer_state")),
            *[text.is_named(F.col(c)) for c in ("customer_id", "customer_unique_id", "customer_city")],
        ),
        probes=lambda: [
            Rule("customer_zip_code_prefix negative", zip_code < 0),
            _missing("customer_state"),
            *[_numeric(c) for c in ("customer_id", "customer_unique_id", "customer_city")],
        ],
    )


def geolocation() -> Contract:
    zip_code, lat, lng = (F.col(f"geolocation_{c}") for c in ("zip_code_prefix", "lat", "lng"))
    city, state = F.col("geolocation_city"), F.col("geolocation_state")
    return Contract(
        source_table="geolocation",
        casts={"geolocation_zip_code_prefix": "int", "geolocation_lat": "double", "geolocation_lng": "double"},
        require="all",
        standardise={"geolocation_city": F.trim, "geolocation_state": text.upper_code},
        text_columns=("geolocation_city", "geolocation_state"),
        rules=[
            Rule("Negative ZIP Code", zip_code < 0),
            *_name_rules("Geolocation City", "geolocation_city"),
            *_name_rules("Geolocation State", "geolocation_state"),
            Rule("Latitude is out of valid bounds [-90, 90]", (lat < -90) | (lat > 90)),
            Rule("Longitude is out of valid bounds [-180, 180]", (lng < -180) | (lng > 180)),
        ],
        # As for customers, a numeric state is rejected and kept.
        keep=_all(
            zip_code >= 0,
            text.is_filled(state),
            text.is_named(city),
            lat.between(-90, 90),
            lng.between(-180, 180),
        ),
        probes=lambda: [
            Rule("geolocation_zip_code_prefix zero or negative", zip_code <= 0),
            Rule("geolocation_lat out of bounds", (lat < -90) | (lat > 90)),
            Rule("geolocation_lng out of bounds", (lng < -180) | (lng > 180)),
            Rule("geolocation_city or state empty", (city == "") | (state == "")),
        ],
    )


def order_items() -> Contract:
    item, price, freight = F.col("order_item_id"), F.col("price"), F.col("freight_value")
    ids = {"order_id": "Order ID", "product_id": "Product ID", "seller_id": "Seller ID"}
    return Contract(
        source_table="order_items",
        casts={
            "order_item_id": "int",
            "shipping_limit_date": "timestamp",
            "price": "double",
            "freight_value": "double",
        },
        require="all",
        text_columns=tuple(ids),
        rules=[
            Rule("Order Item ID is 0 or negative", item <= 0),
            Rule("Negative Price", price < 0),
            Rule("Negative Freight Value", freight < 0),
            *[rule for column, label in ids.items() for rule in _null_or_empty(label, column)],
        ],
        keep=_all(item > 0, price >= 0, freight >= 0, *[text.is_filled(F.col(c)) for c in ids]),
        probes=lambda: [
            Rule("order_item_id zero or negative", item <= 0),
            Rule("price negative", price < 0),
            Rule("freight_value negative", freight < 0),
            *[_missing(c) for c in ids],
        ],
    )


def order_payments() -> Contract:
    sequential, installments, value = (F.col(f"payment_{c}") for c in ("sequential", "installments", "value"))
    kind = F.col("payment_type")
    free_credit = (kind == "CREDIT_CARD") & (installments == 0)
    return Contract(
        source_table="order_payments",
        casts={"payment_sequential": "int", "payment_installments": "int", "payment_value": "double"},
        require="all",
        standardise={"payment_type": text.upper_code},
        discard_unless=kind != "NOT_DEFINED",
        text_columns=("order_id", "payment_type"),
        rules=[
            Rule("Payment Sequential is less than 1", sequential < 1),
            Rule("Negative Payment Installments", installments < 0),
            Rule("Negative Payment Value", value < 0),
            *_null_or_empty("Order ID", "order_id"),
            *_null_or_empty("Payment Type", "payment_type"),
            # The blank payment type is reported twice; consumers see that text.
            Rule("Payment Type is Empty", text.is_blank(kind)),
            Rule("Illogical Payment: Credit Card with 0 Installments", free_credit),
        ],
        keep=_all(
            sequential >= 1,
            installments >= 0,
            value >= 0,
            text.is_filled(F.col("order_id")),
            text.is_filled(kind),
            ~free_credit,
        ),
        probes=lambda: [
            Rule("payment_sequential below 1", sequential < 1),
            Rule("payment_installments negative", installments < 0),
            Rule("payment_value negative", value < 0),
            _missing("order_id"),
            _missing("payment_type"),
        ],
    )


def order_reviews() -> Contract:
    score = F.col("review_score")
    out_of_bounds = (score < 1) | (score > 5)
    return Contract(
        source_table="order_reviews",
        repair={"review_comment_title": text.single_line, "review_comment_message": text.single_line},
        casts={
            "review_score": "double",
            "review_creation_date": "timestamp",
            "review_answer_timestamp": "timestamp",
        },
        try_casts=True,
        fill={"review_comment_title": "No Title", "review_comment_message": "No Comment"},
        require=("review_id", "order_id", "review_score"),
        text_columns=("review_id", "order_id"),
        rules=[
            Rule("Review Score out of bounds (must be 1-5)", out_of_bounds),
            *_null_or_empty("Review ID", "review_id"),
            *_null_or_empty("Order ID", "order_id"),
        ],
        keep=_all(
            score.between(1, 5), text.is_filled(F.col("review_id")), text.is_filled(F.col("order_id"))
        ),
        probes=lambda: [
            Rule("review_score out of bounds", out_of_bounds),
            _missing("review_id"),
            _missing("order_id"),
        ],
    )


def orders() -> Contract:
    purchased, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    is_delivered = F.col("order_status") == "DELIVERED"
    ghost = is_delivered & delivered.isNull()
    unapproved = is_delivered & F.col("order_approved_at").isNull()
    ids = {"order_id": "Order ID", "customer_id": "Customer ID", "order_status": "Order Status"}
    return Contract(
        source_table="orders",
        casts=dict.fromkeys(
            (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
            "timestamp",
        ),
        require=tuple(ids),
        standardise={"order_status": text.upper_code},
        text_columns=tuple(ids),
        rules=[
            *[rule for column, label in ids.items() for rule in _null_or_empty(label, column)],
            Rule("Temporal Anomaly: Delivered before Purchase Date", delivered < purchased),
            Rule("Ghost Delivery: Status is Delivered but missing delivery date", ghost),
            Rule("Unapproved Delivery: Status is Delivered but missing payment approval date", unapproved),
        ],
        # A delivered order without a purchase time is neither kept nor rejected.
        keep=_all(
            *[text.is_filled(F.col(c)) for c in ids],
            delivered.isNull() | (delivered >= purchased),
            ~ghost,
            ~unapproved,
        ),
        probes=lambda: [
            _missing("order_id"),
            _missing("customer_id"),
            Rule("delivered before purchase", delivered < purchased),
        ],
        stamped=False,
    )


def products() -> Contract:
    category = F.col("product_category_name")
    sizes = [F.col(c) for c in PRODUCT_DIMENSIONS]
    metadata = [F.col(c) for c in PRODUCT_METADATA]
    name_length, description_length, photos = metadata
    negative_metadata = (name_length < 0) | (description_length < 0) | (photos < 0)
    return Contract(
        source_table="products",
        casts=dict.fromkeys((*PRODUCT_METADATA, *PRODUCT_DIMENSIONS), "int"),
        fill={"product_category_name": "Unknown", **dict.fromkeys(PRODUCT_METADATA, 0)},
        standardise={"product_category_name": text.spaced_lower},
        enrich=lambda df: group_mean(df, "product_category_name", {"product_weight_g": F.col("product_weight_g") > 0}),
        text_columns=("product_id", "product_category_name"),
        rules=[
            *_name_rules("Product ID", "product_id"),
            Rule("Product Category is NULL or Empty", category.isNull() | text.is_blank(category)),
            *[
                Rule(f"Zero or Negative Product {label}", size <= 0)
                for label, size in zip(("Weight", "Length", "Height", "Width"), sizes, strict=True)
            ],
            Rule("Negative Metadata lengths/qty", negative_metadata),
        ],
        # A NULL dimension decides nothing: such rows are in neither output.
        keep=_all(
            text.is_named(F.col("product_id")),
            text.is_filled(category),
            *[size > 0 for size in sizes],
            *[value >= 0 for value in metadata],
        ),
        probes=lambda: [
            *[Rule(f"{name} zero or negative", F.col(name) <= 0) for name in PRODUCT_DIMENSIONS],
            _numeric("product_id"),
            Rule("metadata negative", negative_metadata),
        ],
    )


def sellers() -> Contract:
    zip_code, seller, city, state = (F.col(f"seller_{c}") for c in ("zip_code_prefix", "id", "city", "state"))
    not_hex, not_code = ~seller.rlike(text.HEX_32), ~state.rlike(text.TWO_CAPITALS)
    return Contract(
        source_table="sellers",
        casts={"seller_zip_code_prefix": "int"},
        require="all",
        standardise={"seller_state": text.upper_code, "seller_city": text.city_title},
        # Rows with an unknown state leave without a quarantine record.
        discard_unless=state.isin(*SELLER_STATES),
        text_columns=("seller_id", "seller_city", "seller_state"),
        rules=[
            Rule("Negative ZIP Code", zip_code < 0),
            *_null_or_empty("Seller ID", "seller_id"),
            Rule("Seller ID is not a valid 32-char hex string", not_hex),
            *_name_rules("Seller City", "seller_city"),
            *_null_or_empty("Seller State", "seller_state"),
            Rule("Seller State is not exactly 2 uppercase letters", not_code),
        ],
        keep=_all(
            zip_code >= 0,
            text.is_filled(state) & ~not_code,
            text.is_filled(seller) & ~not_hex,
            text.is_named(city),
        ),
        probes=lambda: [
            Rule("seller_zip_code_prefix negative", zip_code < 0),
            Rule("seller_state not a code", state.isNull() | text.is_blank(state) | not_code),
            Rule("seller_id not hex", seller.isNull() | text.is_blank(seller) | not_hex),
            _numeric("seller_city"),
        ],
    )


def category_translation() -> Contract:
    names = {"product_category_name": "PT Category Name", "product_category_name_english": "EN Category Name"}

    def unusable(column: str) -> Column:
        c = F.col(column)
        return c.isNull() | text.is_blank(c) | text.is_numeric_text(c) | (F.length(c) < 3)

    return Contract(
        source_table="category_translation",
        require="all",
        standardise=dict.fromkeys(names, text.spaced_lower),
        text_columns=tuple(names),
        rules=[
            rule
            for column, label in names.items()
            for rule in (
                *_name_rules(label, column),
                Rule(f"{label} is too short (junk data)", F.length(F.col(column)) < 3),
            )
        ],
        keep=_all(*[text.is_named(F.col(c)) & (F.length(F.col(c)) >= 3) for c in names]),
        probes=lambda: [Rule(f"{column} unusable", unusable(column)) for column in names],
    )


CONTRACTS: dict[str, Callable[[], Contract]] = {
    "customers": customers,
    "geolocation": geolocation,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "orders": orders,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
}

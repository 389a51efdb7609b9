"""Star schema: five dimensions and three facts that share them.

The large joins (items and payments to orders) carry no hint. Both sides grow with the data, so they
are shuffle joins, and adaptive execution splits the partition of an order that is far above the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import calendar_columns, date_key
from orderloom.operators.packing import MISSING_TOO, ids, packed, unpacked
from orderloom.schemas import RAW_COLUMNS


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category, NULL where there is no translation."""
    key, english = RAW_COLUMNS["category_translation"]
    product_id, category, *measures = RAW_COLUMNS["products"]
    return products.join(translation, key, "left").select(product_id, category, english, *measures)


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(*RAW_COLUMNS["sellers"])


def dim_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*RAW_COLUMNS["orders"])


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day with a purchase.

    Days are made distinct first, so one date column is shuffled and the attributes, string formatting
    included, are computed once per day rather than once per order.
    """
    days = orders.select(F.to_date("order_purchase_timestamp").alias("day")).filter(F.col("day").isNotNull()).distinct()
    return days.select(*calendar_columns(F.col("day")))


def _order_dates(orders: DataFrame, *columns: str) -> DataFrame:
    return orders.select("order_id", *columns, date_key(F.col("order_purchase_timestamp")).alias("date_key"))


def _of_orders(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows joined to their orders; ids are packed on the way. A missing order id meets none."""
    both = packed(rows, ids(rows)).join(packed(orders, ids(orders), MISSING_TOO), "order_id", "inner")
    return unpacked(both, dict.fromkeys([*ids(rows), *ids(orders)]), hold=True)


def fact_orders(order_items: DataFrame, orders: DataFrame, attributes: Sequence[str] = ()) -> DataFrame:
    """One row per sold item of a trusted order.

    ``attributes`` are further columns of ``orders`` to carry, such as those of customers joined to them beforehand: orders are
    fewer and narrower than items, so that join moves less than one of the fact.
    """
    items = order_items.select("order_item_id", "order_id", "product_id", "seller_id", "price", "freight_value")
    return _of_orders(items, _order_dates(orders, "customer_id", *attributes)).select(
        "order_item_id", "order_id", "customer_id", "product_id", "seller_id", "date_key", "price", "freight_value", *attributes
    )


def fact_payments(order_payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment of a trusted order."""
    payments = order_payments.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")
    return _of_orders(payments, _order_dates(orders)).select(
        "order_id", "payment_sequential", "date_key", "payment_type", "payment_installments", "payment_value"
    )


def fact_reviews(order_reviews: DataFrame) -> DataFrame:
    """One row per review, dated by its creation."""
    created = F.col("review_creation_date")
    return order_reviews.select(
        "review_id",
        "order_id",
        date_key(created).alias("date_key"),
        "review_score",
        "review_creation_date",
        "review_answer_timestamp",
    )


# Gold table -> (builder, silver tables it reads).
TABLES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_customers": (dim_customers, ("customers",)),
    "dim_products": (dim_products, ("products", "category_translation")),
    "dim_sellers": (dim_sellers, ("sellers",)),
    "dim_orders": (dim_orders, ("orders",)),
    "dim_date": (dim_date, ("orders",)),
    "fact_orders": (fact_orders, ("order_items", "orders")),
    "fact_payments": (fact_payments, ("order_payments", "orders")),
    "fact_reviews": (fact_reviews, ("order_reviews",)),
}


def build(table: str, silver: Callable[[str], DataFrame] | Mapping[str, DataFrame]) -> DataFrame:
    """One gold table from silver tables, given as a mapping or a function of the name."""
    builder, inputs = TABLES[table]
    get = silver.__getitem__ if isinstance(silver, Mapping) else silver
    return builder(*[get(name) for name in inputs])

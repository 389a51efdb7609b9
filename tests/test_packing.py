"""Packed ids: every text comes back, none meets another, and the copies' shuffle moves them at half their size."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators.dedupe import distinct_packed
from orderloom.operators.packing import MISSING_TOO, pack, unpack
from orderloom.plans import gold, silver
from tests.helpers import plan, rows

HEX = "0123456789abcdef" * 2
TEXTS = [None, "", " ", "a", "5", HEX, HEX.upper(), HEX[:-1], HEX[:-1] + "g", HEX + "0", HEX[:16], HEX[:15], HEX[:14], HEX[:15] + "\0", HEX[:14] + "\1", HEX[:14] + "\0", HEX + "\n"]
TEXTS += ["\0", "\1", "\2", "ã" * 7 + "b", "ã" * 8, "ã" * 16, HEX[:15] + "\0\1"]


def test_every_text_comes_back_and_meets_no_other(spark):
    df = spark.createDataFrame([(x,) for x in TEXTS], "x string").select("x", pack(F.col("x")).alias("p"))
    found = df.select("x", "p", unpack(F.col("p")).alias("back")).collect()
    assert [r.back for r in found] == [r.x for r in found]
    assert len({bytes(r.p) for r in found}) == len(TEXTS)
    assert [len(r.p) for r in found if r.x == HEX] == [16]
    assert unpack(F.lit(MISSING_TOO)) is not None and spark.range(1).select(unpack(F.lit(MISSING_TOO))).first()[0] is None


def test_distinct_rows_with_packed_ids(spark):
    df = spark.createDataFrame([(x, n) for x in TEXTS for n in (1, 1, 2)], "order_id string, n int")
    assert rows(distinct_packed(df)) == rows(df.distinct())


def test_the_copies_shuffle_moves_packed_ids_and_filters_pack_none(spark):
    raw = spark.createDataFrame([], "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, price string, freight_value string")
    for df in silver.clean(raw, "order_items"):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("unhex(order_id") and text.count("unhex(seller_id")
        assert not [line for line in text.splitlines() if "Filter" in line and "unhex" in line]


def test_the_fact_join_moves_packed_ids_and_missing_ones_meet_none(spark):
    items = spark.createDataFrame([(1, o, HEX, "s", 1.0, 2.0) for o in (HEX, "x", None)], "order_item_id int, order_id string, product_id string, seller_id string, price double, freight_value double")
    orders = spark.createDataFrame([(o, "c") for o in (HEX, "x", None)], "order_id string, customer_id string").withColumn("order_purchase_timestamp", F.lit("2024-01-05").cast("timestamp"))
    fact = gold.fact_orders(items, orders)
    assert rows(fact, "order_id", "product_id", "seller_id", "customer_id") == [(HEX, HEX, "s", "c"), ("x", HEX, "s", "c")]
    assert "unhex" in plan(fact)


def test_a_join_on_another_id_packs_none_in_filters(spark):
    raw = spark.createDataFrame([], "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, price string, freight_value string")
    items = silver.clean(raw, "order_items").valid
    orders = spark.createDataFrame([], "order_id string, customer_id string, order_purchase_timestamp timestamp")
    products = spark.createDataFrame([], "product_id string, product_category_name string").filter("trim(product_id) <> ''")
    text = gold.fact_orders(items, orders).join(products, "product_id")._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in text.splitlines() if "Filter" in line and "unhex" in line]

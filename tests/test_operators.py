"""Deduplication, imputation, profiles and rules against brute force and by plan shape."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.operators import dedupe, impute, profile, rules
from orderloom.plans import gold, kpi, silver
from tests.helpers import final_plan, plan, raw_rows, rows
from tests.test_contracts import CUSTOMER, ITEM

maybe = st.one_of(st.none(), st.integers(0, 2))
BRIEF = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _nulls_last(values):
    return [(v is None, v if v is not None else 0) for v in values]


@BRIEF
@given(st.lists(st.tuples(maybe, maybe, maybe), max_size=20))
def test_one_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, a int, b int").repartition(3)
    expected = {}
    for k, a, b in data:
        if k not in expected or _nulls_last((a, b)) < _nulls_last(expected[k][1:]):
            expected[k] = (k, a, b)
    assert set(rows(dedupe.one_per_key(df, ["k"]))) == set(expected.values())


@BRIEF
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)), max_size=20))
def test_latest_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, batch_id int, v int").repartition(3)
    expected = {k: max(row for row in data if row[0] == k) for k, _, _ in data}
    assert set(rows(dedupe.latest_per_key(df, ["k"], ["batch_id"]))) == set(expected.values())


def test_all_columns_as_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert rows(dedupe.one_per_key(df, ["a", "b"])) == [(1, 2)]


def test_keyed_dedupe_combines_before_the_shuffle(spark):
    text = plan(dedupe.one_per_key(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), ["k"]))
    assert "partial_min" in text[text.index("Exchange"):]
    assert "Window" not in text


def test_rule_filters_run_below_the_deduplication_shuffle(spark):
    cleaned = silver.clean(raw_rows(spark, "order_items", ITEM, {}), "order_items")
    for side in cleaned:
        text = plan(side)
        assert text.count("Exchange") == 1
        assert text.index("Exchange") < text.index("Filter")


def test_hot_order_is_split_in_the_fact_join(spark, tmp_path):
    """One order holds a third of all items and the join still runs in several tasks for it."""
    items = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('o', id) END AS order_id",
        "CAST(id AS int) AS order_item_id", "concat('p', id) AS product_id", "'s' AS seller_id",
        "CAST(id AS double) AS price", "1D AS freight_value",
    )
    orders = spark.range(60_000).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE concat('o', id) END AS order_id",
        "'c' AS customer_id", "timestamp'2018-01-01 00:00:00' AS order_purchase_timestamp",
    )
    items.repartition(8).write.parquet(f"{tmp_path}/items")
    orders.repartition(8).write.parquet(f"{tmp_path}/orders")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = gold.fact_orders(spark.read.parquet(f"{tmp_path}/items"), spark.read.parquet(f"{tmp_path}/orders"))
        assert "skew=true" in final_plan(fact)
        assert fact.count() == 60_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_report_shuffles_each_side_once_without_broadcast(spark, tmp_path):
    """The aggregate below the join leaves its rows where the join needs them."""
    spark.range(1000).selectExpr("id % 50 AS customer_id", "CAST(id AS double) AS price").write.parquet(f"{tmp_path}/f")
    spark.range(50).selectExpr("id AS customer_id", "id % 5 AS customer_state").write.parquet(f"{tmp_path}/d")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = {"fact_orders": f"{tmp_path}/f", "dim_customers": f"{tmp_path}/d"}
        text = plan(kpi.run("kpi_revenue_by_state", lambda t: spark.read.parquet(tables[t])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning(customer_id") == 2
    assert text.count("Exchange hashpartitioning(customer_state") == 1
    assert "ReadSchema: struct<customer_id:bigint,price:double>" in text


@BRIEF
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(-2, 9))), max_size=20))
def test_group_mean(spark, data):
    df = spark.createDataFrame(data, "g string, v int")
    means = {}
    for group in "abc":
        good = [v for g, v in data if g == group and v is not None and v > 0]
        # Half-up, as for positive decimals.
        means[group] = float(int(sum(good) / len(good) + 0.5)) if good else None
    expected = [(g, float(v) if v is not None and v > 0 else means[g]) for g, v in data]
    actual = [tuple(r) for r in impute.group_mean(df, "g", {"v": F.col("v") > 0}).collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)


def test_profiles(spark):
    df = spark.createDataFrame([(1, " a"), (1, " a"), (None, "b"), (2, None)], "n int, t string")
    assert rows(profile.nulls(df)) == [(1, 1)]
    assert rows(profile.duplicates(df)) == [(1,)]
    assert rows(profile.duplicates(df.filter("n = 9"))) == [(0,)]
    assert rows(profile.duplicate_keys(df, ["n"])) == [(1, 2)]
    assert rows(profile.untrimmed(df, ["t"]), "n") == [(1,), (1,)]
    assert [tuple(r) for r in profile.value_counts(df, "n").collect()][0] == (1, 2)
    found = profile.violations(df, [rules.Rule("low", F.col("n") < 2), rules.Rule("never", F.col("n") > 9)])
    assert rows(found) == [("low", 2), ("never", 0)]


def test_reasons_keep_order_and_skip_unknown(spark):
    df = spark.createDataFrame([(5,), (None,), (1,)], "n int")
    checks = [rules.Rule("odd", F.col("n") % 2 == 1), rules.Rule("big", F.col("n") > 3)]
    assert [r.error_reason for r in rules.tag(df, checks).collect()] == ["odd | big", "", "odd"]


def test_reconcile_counts_both_and_neither(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    checks = [rules.Rule("positive", F.col("n") > 0)]
    assert rules.reconcile(df, checks, F.col("n") > 3).first() == (1, 2, 1, 1)
    valid, rejected = rules.split_strict(df, checks, "undecided")
    assert valid.count() == 0
    assert sorted(r.error_reason for r in rejected.collect()) == ["positive", "positive", "undecided"]


def test_gap_is_visible(spark):
    raw = raw_rows(spark, "customers", CUSTOMER, {"customer_state": "77"}, {"customer_id": "x"})
    counted = silver.reconcile(raw, "customers").first()
    assert counted.asDict() == {"kept_rows": 2, "rejected_rows": 1, "both_rows": 1, "neither_rows": 0}


@pytest.mark.parametrize("name", ["dim_customers", "dim_products", "dim_sellers", "dim_date"])
def test_dimension_keys_are_unique_on_clean_input(spark, name):
    from testbed.fixtures import raw

    sf = "/root/testdata/sf0.001"
    table = gold.build(name, lambda t: silver.clean(raw(spark, sf, t), t).valid)
    key = {"dim_customers": "customer_id", "dim_products": "product_id", "dim_sellers": "seller_id"}.get(name, "date_key")
    assert profile.duplicate_keys(table, [key]).count() == 0


def test_a_hot_key_is_spread(spark):
    """A third of all rows share a key, and the other side is an aggregate on it: no task holds them all."""
    from orderloom.operators.joins import join_one_per_key

    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    means = df.groupBy("k").agg(F.avg("v").alias("m"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for c, v in zip(before, ("-1", "false", "32"), strict=True):
        spark.conf.set(c, v)
    try:
        joined = join_one_per_key(df, means, ["k"])
        tasks = joined.filter("k = -1").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == 3000 and max(r["count"] for r in tasks) < 1000
        assert rows(joined) == rows(df.join(means, "k").select("k", "v", "m"))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_a_repeated_side_is_not_broadcast(spark):
    """Adaptive execution measures the side with one row per key before it is repeated, and must not broadcast it afterwards."""
    from orderloom.operators.joins import join_one_per_key

    df = spark.range(5000).selectExpr("id % 700 AS k", "id AS v")
    for how in ("left", "left_anti"):
        text = final_plan(join_one_per_key(df, df.filter("k < 300").select("k").distinct(), ["k"], how))
        assert "SortMergeJoin" in text and "Broadcast" not in text


def test_customers_meet_orders_before_items(spark):
    """Items are many and wide: what hangs on an order joins the orders, so items are not shuffled by customer."""
    from testbed.queries import QUERIES

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan(QUERIES["jn6_fact_dimensions"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set(key, before)
    assert text.index("Exchange hashpartitioning(order_id") < text.index("Exchange hashpartitioning(customer_id")

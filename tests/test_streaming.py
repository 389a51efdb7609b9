"""Event parsing, micro-batch cleaning, idempotent sinks and state across batches."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from orderloom.schemas import EVENT_SCHEMAS, WIDE_EVENT_SCHEMAS
from orderloom.sources import events
from orderloom.streaming import cleaners, state, unify
from orderloom.streaming import silver as stream_silver
from orderloom.streaming.bronze import start_bronze
from tests.helpers import plan, rows


def _bodies(spark, *messages):
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    return spark.createDataFrame([(t,) for t in texts], "Body string")


def _order(order_id="o1", customer_id="c1", status=" Delivered ", at="2018-01-01 10:00:00", **more):
    return {"order_id": order_id, "customer_id": customer_id, "order_status": status, "order_purchase_timestamp": at} | more


def test_orders(spark):
    df = _bodies(
        spark,
        _order(extra=1),
        _order(),
        _order("o2", customer_id=None),
        _order("o3", at="NaT"),
        _order("o4", at=None),
        {"order_id": "o5", "customer_id": "c5", "order_purchase_timestamp": "2018-01-01 10:00:00"},
        "not json",
        "",
    )
    kept = cleaners.clean_events(df, "orders")
    assert rows(kept, "order_id", "order_status") == [("o1", "delivered"), ("o5", None)]


def test_items(spark):
    def item(n, price, freight):
        return {"order_id": "o1", "order_item_id": n, "price": price, "freight_value": freight}

    df = _bodies(spark, item(1, 5, 1), item(2, -1, 1), item(3, 5, None), item(4, None, 1), item(5, 0, 0))
    assert rows(cleaners.clean_events(df, "items"), "order_item_id") == [(1,), (5,)]


def test_nan_is_missing_where_required_and_not_negative_elsewhere(spark):
    df = _bodies(
        spark,
        '{"order_id":"o","order_item_id":1,"price":NaN,"freight_value":1}',
        '{"order_id":"o","order_item_id":2,"price":1,"freight_value":NaN}',
    )
    assert rows(cleaners.clean_events(df, "items"), "order_item_id") == [(2,)]
    valid, rejected = cleaners.split_tagged(cleaners.tag_events(df, "items"))
    assert rows(valid, "order_item_id") == [(2,)]
    assert rows(rejected, "order_item_id", "error_reason") == [(1, "price is NULL or negative")]


def test_json_types_are_not_coerced(spark):
    df = _bodies(spark, {"order_id": "o", "order_item_id": 1.0, "price": "9.5", "freight_value": 2})
    parsed = cleaners.parse(df, EVENT_SCHEMAS["items"])
    assert rows(parsed) == [("o", None, None, 2.0)]


def test_payments(spark):
    def pay(kind, installments=1, value=9.5):
        return {"order_id": "o1", "payment_type": kind, "payment_installments": installments, "payment_value": value}

    df = _bodies(
        spark, pay(" CC "), pay("Credit Card"), pay("creditcard"), pay("Boleto"), pay("Boleto"), pay("x", -1), pay("y", 1, -1)
    )
    kinds = rows(cleaners.clean_events(df, "payments"), "payment_type")
    assert kinds == [("boleto",), ("credit_card",), ("credit_card",), ("credit_card",)]


@pytest.mark.parametrize("table", EVENT_SCHEMAS)
def test_split_is_complete_and_agrees_with_the_cleaner(spark, table):
    from testbed.fixtures import bodies

    df = bodies(spark, "/root/testdata/sf0.001", table)
    valid, rejected = cleaners.split_tagged(cleaners.tag_events(df, table))
    assert rows(valid) == rows(cleaners.clean_events(df, table))
    assert valid.count() + rejected.count() == cleaners.tag_events(df, table).count()
    lost = cleaners.parse(df, cleaners.CONTRACTS[table].schema, with_body=True).filter("order_id IS NULL")
    assert rows(lost, "Body") == rows(rejected.filter("order_id IS NULL"), "Body")


def test_each_malformed_body_is_kept(spark):
    df = _bodies(spark, *[f"junk {i}" for i in range(50)], "junk 1", "", {"customer_id": "c"}, _order())
    valid, rejected = cleaners.split_tagged(cleaners.tag_events(df, "orders"))
    assert rows(valid, "order_id") == [("o1",)]
    assert rejected.count() == 53 and rejected.filter(F.col("error_reason").startswith(cleaners.MALFORMED)).count() == 52


def test_a_new_checkpoint_adds_to_what_is_there(spark, tmp_path):
    for name in ("one", "two"):
        _bodies(spark, _order(name)).write.parquet(f"{tmp_path}/{name}")
        stream = events.body_stream(spark, f"{tmp_path}/{name}")
        stream_silver.start_silver(stream, "orders", f"{tmp_path}/silver", f"{tmp_path}/c-{name}", None).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/silver"), "order_id", "batch_id") == [("one", 0), ("two", 0)]


def test_a_repeated_batch_is_written_once(spark, tmp_path):
    process = stream_silver.batch_sink("orders", f"{tmp_path}/silver", f"{tmp_path}/quarantine")
    batch = _bodies(spark, _order("o1"), _order("o2", at="NaT"))
    for _ in range(3):
        process(batch, 7)
    process(batch.limit(0), 8)
    assert rows(spark.read.parquet(f"{tmp_path}/silver"), "order_id", "batch_id") == [("o1", 7)]
    assert rows(spark.read.parquet(f"{tmp_path}/quarantine"), "error_reason") == [("order_purchase_timestamp is NULL",)]


def test_restart_continues_after_the_last_batch(spark, tmp_path):
    def run():
        stream = events.body_stream(spark, f"{tmp_path}/bronze")
        stream_silver.start_silver(
            stream, "orders", f"{tmp_path}/silver", f"{tmp_path}/checkpoint", None
        ).awaitTermination()

    _bodies(spark, _order("o1")).write.parquet(f"{tmp_path}/bronze")
    run()
    run()
    _bodies(spark, _order("o2")).write.mode("append").parquet(f"{tmp_path}/bronze")
    run()
    assert rows(spark.read.parquet(f"{tmp_path}/silver"), "order_id", "batch_id") == [("o1", 0), ("o2", 1)]


def test_two_hops_on_an_interval(spark, tmp_path):
    _bodies(spark, _order("o1"), "junk").write.parquet(f"{tmp_path}/topic")
    raw = start_bronze(
        events.body_stream(spark, f"{tmp_path}/topic"), f"{tmp_path}/bronze", f"{tmp_path}/c1", "1 second"
    )
    raw.processAllAvailable()
    clean = stream_silver.start_silver(
        events.body_stream(spark, f"{tmp_path}/bronze"), "orders", f"{tmp_path}/silver", f"{tmp_path}/c2", "1 second"
    )
    clean.processAllAvailable()
    raw.stop()
    clean.stop()
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 2
    assert rows(spark.read.parquet(f"{tmp_path}/silver"), "order_id") == [("o1",)]


@pytest.mark.parametrize("salts", [0, 4])
def test_duplicates_across_batches(spark, tmp_path, salts):
    """Two files in two batches, with a hot order id in both; one row per id comes out."""
    for n in range(2):
        messages = [_order("hot", customer_id=f"c{i}") for i in range(50)] + [_order(f"o{n}"), _order("both")]
        _bodies(spark, *messages).coalesce(1).write.mode("append").parquet(f"{tmp_path}/bronze")
    stream = events.body_stream(spark, f"{tmp_path}/bronze", maxFilesPerTrigger="1")
    parsed = cleaners.CONTRACTS["orders"].prepare(cleaners.parse(stream, EVENT_SCHEMAS["orders"]))
    unique = state.dedupe_stream(
        parsed, ["order_id"], "order_purchase_timestamp", "1 day", salts, ["customer_id"]
    )
    query = (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True)
        .start(f"{tmp_path}/silver")
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/silver"), "order_id") == [("both",), ("hot",), ("o0",), ("o1",)]


def test_newest_version_and_compaction(spark, tmp_path):
    for batch_id, status in enumerate(["created", "shipped"]):
        df = spark.createDataFrame([("o1", status), (f"only{batch_id}", status)], "order_id string, order_status string")
        stream_silver.write_batch(df, f"{tmp_path}/history", batch_id)
        state.compact(spark, f"{tmp_path}/history", f"{tmp_path}/current", ["order_id"])
    expected = [("o1", "shipped"), ("only0", "created"), ("only1", "shipped")]
    assert rows(state.compacted(spark, f"{tmp_path}/current"), "order_id", "order_status") == expected


def _version(spark, path, batch_id, writer, *pairs):
    df = spark.createDataFrame(list(pairs), "order_id string, order_status string")
    stream_silver.write_batch(df, path, batch_id, writer=writer)


def test_a_new_checkpoint_wins_and_history_is_pruned(spark, tmp_path):
    history, current = f"{tmp_path}/history", f"{tmp_path}/current"
    _version(spark, history, 5, "a", ("o1", "old"), *((f"x{i}", "old") for i in range(200)))
    state.compact(spark, history, current, ["order_id"], buckets=16)
    files = {str(f) for f in (tmp_path / "current").rglob("*.parquet")}
    _version(spark, history, 0, "b", ("o1", "new"))
    state.compact(spark, history, current, ["order_id"])
    now = state.compacted(spark, current)
    assert now.filter("order_id = 'o1'").first().order_status == "new" and now.count() == 201
    # one bucket was touched: the files of the fifteen others are still those that are read
    after = {f.removeprefix("file://") for f in now.inputFiles()}
    assert len(after & files) == 15 and len(after - files) == 1
    gone = state.retire(spark, current)
    assert len(gone) == 1 and state.compacted(spark, current).count() == 201
    found = state.manifest(spark, current)
    assert (found.marks, found.count) == ({"a": 5, "b": 0}, 16)
    text = plan(state.read_history(spark, history).filter(state.unseen(found.marks)))
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    state.compact(spark, history, current, ["order_id"])
    assert state.manifest(spark, current).version == 1  # nothing new, nothing written
    _version(spark, history, 6, "a", ("o1", "last"))
    state.compact(spark, history, current, ["order_id"])
    assert state.compacted(spark, current).filter("order_id = 'o1'").first().order_status == "last"


def test_an_unfinished_compaction_is_not_seen(spark, tmp_path):
    history, current = f"{tmp_path}/history", f"{tmp_path}/current"
    _version(spark, history, 0, "a", ("o1", "first"))
    state.compact(spark, history, current, ["order_id"])
    (tmp_path / "current" / "_manifests" / "1").mkdir()
    assert rows(state.compacted(spark, current), "order_status") == [("first",)]
    _version(spark, history, 1, "a", ("o1", "second"))
    state.compact(spark, history, current, ["order_id"])
    assert rows(state.compacted(spark, current), "order_status") == [("second",)]


def test_unify_orders_versions_across_writers(spark, tmp_path):
    _version(spark, f"{tmp_path}/h", 500, "a", ("o1", "old"))
    _version(spark, f"{tmp_path}/h", 0, "b", ("o1", "new"))
    batch = spark.createDataFrame([("o0", "KEPT")], "order_id string, order_status string")
    found = unify.unify(batch, state.read_history(spark, f"{tmp_path}/h"), "orders")
    assert rows(found, "order_id", "order_status") == [("o0", "KEPT"), ("o1", "NEW")]


def test_copies_within_reach_go_across_batches_and_writers(spark, tmp_path):
    unique = state.Unique(("k",), "at", 7, f"{tmp_path}/digest")

    def batch(writer, batch_id, *pairs):
        df = spark.createDataFrame([(k, at) for k, at in pairs], "k string, at string").withColumn("at", F.col("at").cast("timestamp"))
        fresh = unique.fresh(df, writer, batch_id)
        out = rows(fresh.select("k", F.col("at").cast("string")))
        unique.remember(fresh, writer, batch_id)
        return out

    assert len(batch("a", 0, ("x", "2024-01-28 10:00:00"), ("y", "2024-01-28"), (None, "2024-01-28"), ("z", None))) == 4
    assert batch("a", 0, ("x", "2024-01-28 10:00:00")) == [("x", "2024-01-28 10:00:00")]  # repeated: it doesn't meet itself
    again = batch("b", 0, ("x", "2024-02-04 10:00:00"), ("x", "2024-02-04 10:00:01"), ("x", "2024-01-20"), (None, "2024-01-28"), ("w", "2024-01-01"))
    assert [k for k, _ in again] == [None, "w", "x", "x"] and ("x", "2024-02-04 10:00:00") not in again
    assert batch("b", 1, ("x", "2024-02-11"), (None, None)) == [(None, None)]
    assert [p.rsplit("/", 1)[1] for p in unique.forget(spark, "2024-02-15")] == ["month=2024-01-01"]
    assert batch("c", 0, ("w", "2024-01-01")) == [("w", "2024-01-01 00:00:00")]


def test_unify_keeps_batch_rows_and_adds_new_orders(spark):
    batch = spark.createDataFrame(
        [("o1", "c1", "DELIVERED"), ("o1", "c1", "SHIPPED")], "order_id string, customer_id string, order_status string"
    )
    streamed = spark.createDataFrame(
        [("o1", "c1", "created"), ("o2", "c2", "created"), ("o2", "c2", "created")], batch.schema
    )
    merged = unify.unify(batch, streamed, "orders")
    expected = [("o1", "c1", "DELIVERED"), ("o1", "c1", "SHIPPED"), ("o2", "c2", "CREATED")]
    assert rows(merged) == expected


def test_unify_shuffles_events_and_batch_keys_once(spark):
    """Events of one row per key are joined where their aggregate left them, and no key is repeated."""
    batch = spark.range(9).selectExpr("CAST(id AS string) AS order_id", "'S' AS order_status")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(unify.unify(batch, batch.withColumn("batch_id", F.lit(1)), "orders"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange") == 2 and "_salt" not in text


@pytest.mark.parametrize("table", cleaners.CONTRACTS)
def test_each_text_is_parsed_once(spark, table):
    bodies = spark.createDataFrame([("not json",), ("not json",), (None,), ('{"order_id": "o1"}',)], "Body string")
    for cleaned in (cleaners.clean_events(bodies, table), cleaners.tag_events(bodies, table)):
        assert plan(cleaned).count("from_json(") == 1
    assert rows(cleaned, "Body") == [(None,), ("not json",), ("not json",), ('{"order_id": "o1"}',)]


def test_wide_payload(spark):
    message = {"order_id": "o1", "payment_type": "cc", "payment_installments": 1, "payment_value": 2, "payment_sequential": 3}
    kept = cleaners.clean_events(_bodies(spark, message), "payments", WIDE_EVENT_SCHEMAS["payments"])
    assert rows(kept, "payment_type", "payment_sequential") == [("credit_card", 3)]


def test_events_are_valid_json_with_nulls(spark):
    df = spark.createDataFrame([("a", float("nan"), None), ("b", 1.5, "x")], "id string, v double, t string")
    found = sorted((json.loads(r.Body) for r in events.to_events(df).collect()), key=lambda m: m["id"])
    assert found == [{"id": "a", "v": None, "t": None}, {"id": "b", "v": 1.5, "t": "x"}]


def test_children_are_published_with_their_order(spark):
    orders = spark.createDataFrame([("o1",), ("o1",), ("o2",)], "order_id string")
    items = spark.createDataFrame([("o1", 1), ("o3", 1)], "order_id string, order_item_id int")
    payments = spark.createDataFrame([("o2", 9.0)], "order_id string, payment_value double")
    sent = rows(events.order_events(orders, items, payments), "topic", "key")
    assert sent == [("order_items", "o1"), ("order_items", "o1"), ("orders", "o1"), ("orders", "o1"), ("orders", "o2"), ("payment", "o2")]


def test_kafka_options():
    plain = events.kafka_options("host:9092", "orders")
    assert plain["subscribe"] == "orders"
    assert plain["startingOffsets"] == "latest"
    assert plain["failOnDataLoss"] == "false"
    assert "kafka.sasl.mechanism" not in plain
    secure = events.kafka_options("host:9093", "payment", "login", startingOffsets="earliest")
    assert secure["kafka.security.protocol"] == "SASL_SSL"
    assert secure["startingOffsets"] == "earliest"

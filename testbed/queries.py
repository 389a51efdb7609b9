"""Registered queries: one per operator, each over whole given tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame. ``testbed.oracles`` states the same
results independently in DuckDB SQL under the same names.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import calendar, measures, text
from orderloom.lake import Lake, scratch_root
from orderloom.operators import casting, dedupe, impute, nulls, profile, rules
from orderloom.operators.joins import join_one_per_key
from orderloom.plans import batch, corrections, gold, kpi, silver
from orderloom.plans.contracts import CONTRACTS, PRODUCT_DIMENSIONS, SELLER_STATES
from orderloom.schemas import EVENT_SCHEMAS, WIDE_EVENT_SCHEMAS
from orderloom.sources import events, files, landing, tables
from orderloom.streaming import cleaners, state, supervise, unify
from orderloom.streaming import silver as stream_silver
from orderloom.streaming.bronze import start_bronze
from testbed.fixtures import bodies, raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Quarantine stamps the processing time; comparisons need a constant one.
AS_OF = "2024-01-05 12:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def _clean(spark: SparkSession, sf_dir: str, table: str) -> silver.Cleaned:
    return silver.clean(raw(spark, sf_dir, table), table, _as_of())


def _valid(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _clean(spark, sf_dir, table).valid


def _refined(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver.refined(raw(spark, sf_dir, table), silver.contract(table))


def _standardised(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver.standardised(raw(spark, sf_dir, table), silver.contract(table))


def _typed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver.typed(raw(spark, sf_dir, table), silver.contract(table))


def _gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return gold.build(table, lambda name: _valid(spark, sf_dir, name))


# --- cleaned tables, quarantine, gold, reports ----------------------------------------------------

for _table in CONTRACTS:
    QUERIES[f"silver_{_table}"] = lambda spark, sf, t=_table: _clean(spark, sf, t).valid
    QUERIES[f"quarantine_{_table}"] = lambda spark, sf, t=_table: _clean(spark, sf, t).rejected
    QUERIES[f"dq_reconcile_{_table}"] = lambda spark, sf, t=_table: silver.reconcile(raw(spark, sf, t), t)
    QUERIES[f"profile_nulls_{_table}"] = lambda spark, sf, t=_table: profile.nulls(
        dedupe.distinct_rows(_typed(spark, sf, t))
    )
    QUERIES[f"profile_duplicates_{_table}"] = lambda spark, sf, t=_table: profile.duplicates(_typed(spark, sf, t))
    QUERIES[f"profile_untrimmed_{_table}"] = lambda spark, sf, t=_table: profile.untrimmed(
        raw(spark, sf, t), CONTRACTS[t]().text_columns
    )
    QUERIES[f"profile_violations_{_table}"] = lambda spark, sf, t=_table: profile.violations(
        _refined(spark, sf, t), CONTRACTS[t]().rules
    )
    QUERIES[f"profile_probes_{_table}"] = lambda spark, sf, t=_table: profile.violations(
        _standardised(spark, sf, t), CONTRACTS[t]().probes()
    )

for _table in gold.TABLES:
    QUERIES[_table] = lambda spark, sf, t=_table: _gold(spark, sf, t)

for _name in kpi.REPORTS:
    QUERIES[_name] = lambda spark, sf, n=_name: kpi.run(n, lambda t: _gold(spark, sf, t))

DISTINCT_COLUMNS = (
    ("customers", "customer_state"),
    ("customers", "customer_city"),
    ("order_payments", "payment_type"),
    ("order_reviews", "review_score"),
    ("orders", "order_status"),
    ("products", "product_category_name"),
    ("sellers", "seller_state"),
    ("sellers", "seller_city"),
    ("category_translation", "product_category_name"),
    ("category_translation", "product_category_name_english"),
)
for _table, _column in DISTINCT_COLUMNS:
    QUERIES[f"profile_distinct_{_table}_{_column}"] = lambda spark, sf, t=_table, c=_column: profile.distinct_values(
        _standardised(spark, sf, t), c
    )

QUERIES["profile_distinct_orders_raw_status"] = lambda spark, sf: profile.distinct_values(
    _typed(spark, sf, "orders"), "order_status"
)
QUERIES["profile_distinct_payments_accepted_type"] = lambda spark, sf: profile.distinct_values(
    _refined(spark, sf, "order_payments"), "payment_type"
)


# --- sources --------------------------------------------------------------------------------------


CSV_AS_IS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _land_csv(df: DataFrame, path: str, multiline: bool = False) -> str:
    """Write a raw landing folder, spaces and NULLs intact.

    Files without line breaks in their fields are compressed and small, as they are not split; the others are read split by split.
    """
    options = dict(CSV_AS_IS)
    options |= {"quote": '"', "escape": '"'} if multiline else {"compression": "gzip", "maxRecordsPerFile": "500000"}
    df.write.options(**options).csv(path)
    return path


def _land(df: DataFrame, path: str) -> str:
    df.write.option("compression", tables.COMPRESSION).parquet(path)
    return path


def _lake(spark: SparkSession) -> Lake:
    return Lake(scratch_root(spark))


def _ingested(spark: SparkSession, sf_dir: str, entity: str, runs: int = 1) -> DataFrame:
    lake = _lake(spark)
    _land_csv(raw(spark, sf_dir, entity), lake.raw(entity), entity in batch.MULTILINE_ENTITIES)
    for _ in range(runs):
        batch.ingest(spark, lake, [entity])
    return batch.bronze(spark, lake, entity)


@query
def src1_csv_stream(spark, sf_dir):
    return _ingested(spark, sf_dir, "customers")


@query
def src2_multiline_csv(spark, sf_dir):
    return _ingested(spark, sf_dir, "order_reviews")


@query
def src3_schema_drift(spark, sf_dir):
    """A second delivery carries one more column; bronze keeps both deliveries."""
    lake = _lake(spark)
    first = raw(spark, sf_dir, "sellers")
    second = raw(spark, sf_dir, "customers").select(
        F.col("customer_id").alias("seller_id"),
        F.col("customer_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("customer_city").alias("seller_city"),
        F.col("customer_state").alias("seller_state"),
        F.col("customer_unique_id").alias("seller_group"),
    )
    for name, delivery in (("first", first), ("second", second)):
        folder = _land_csv(delivery, f"{lake.raw('sellers')}/{name}")
        resolved = files.resolve_schema(spark, folder, lake.schema_file("sellers"), infer_types=False)
        stream = files.csv_stream(spark, f"{lake.raw('sellers')}/*", resolved.file_schema)
        rows = files.conform(stream, resolved.schema)
        files.drain(rows, lake.bronze("sellers"), lake.checkpoint("bronze", "sellers")).awaitTermination()
    # Read with the resolved schema: the older files simply lack the new column.
    return spark.read.schema(resolved.schema).parquet(lake.bronze("sellers"))


def _small_splits(spark: SparkSession, df: Callable[[], DataFrame], path: str) -> DataFrame:
    """df, planned and written while files are read in splits of 64 KiB."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        return tables.read_path(spark, _land(df(), path))
    finally:
        spark.conf.set(key, before)


@query
def src2_split_csv(spark, sf_dir):
    """One file with line breaks in its fields, read in many splits."""
    root = scratch_root(spark)
    folder = _land_csv(raw(spark, sf_dir, "order_reviews").repartition(1), f"{root}/reviews", multiline=True)

    def read() -> DataFrame:
        (layout,) = landing.layouts(spark, [folder])
        return landing.read_layout(spark, layout, multiline=True)

    return _small_splits(spark, read, f"{root}/records")


@query
def src3_ingest_drift(spark, sf_dir):
    """One folder with three layouts, one of them reordered, through ingestion and the whole run: silver sellers and what else the files brought."""
    lake = _lake(spark)
    for entity in CONTRACTS:
        if entity != "sellers":
            _land_csv(raw(spark, sf_dir, entity), lake.raw(entity), entity in batch.MULTILINE_ENTITIES)
    sellers = raw(spark, sf_dir, "sellers")
    third = F.ascii(F.right("seller_id", F.lit(1))) % 3
    group = F.concat(F.lit("group "), "seller_state").alias("seller_group")
    deliveries = {
        0: sellers.filter(third == 0),
        1: sellers.filter(third == 1).select("seller_state", "seller_id", "seller_zip_code_prefix", "seller_city"),
        2: sellers.filter(third == 2).select("seller_id", group, "seller_zip_code_prefix", "seller_city", "seller_state"),
    }
    for rows in deliveries.values():
        rows.write.mode("append").options(**CSV_AS_IS).csv(lake.raw("sellers"))
    batch.run_batch(spark, lake, "r1")
    brought = batch.bronze(spark, lake, "sellers", every_column=True).select("seller_id", "seller_group").distinct()
    return batch.silver_rows(spark, lake, "sellers").join(brought, "seller_id", "left")


@query
def src4_rescued_fields(spark, sf_dir):
    """Every field of the reviews by its type; what doesn't fit is kept by field."""
    folder = _land_csv(raw(spark, sf_dir, "order_reviews"), f"{scratch_root(spark)}/reviews", multiline=True)
    (layout,) = landing.layouts(spark, [folder])
    types = {"review_score": "double", "review_creation_date": "timestamp", "review_answer_timestamp": "timestamp"}
    found = landing.rescue_fields(landing.read_layout(spark, layout, multiline=True, with_path=True), types)
    lost = F.from_json(files.RESCUED, "review_score string, review_creation_date string, review_answer_timestamp string, _file_path string")
    shown = found.withColumn("lost", lost).withColumns({f"lost_{c}": F.col(f"lost.{c}") for c in types})
    return shown.withColumn("lost_in", F.col("lost._file_path").contains("/reviews/")).drop("lost", files.RESCUED)


@query
def src4_rescued_data(spark, sf_dir):
    """Scores that are not numbers leave the record in the rescue column."""
    folder = _land_csv(
        raw(spark, sf_dir, "order_reviews").select("review_id", "order_id", "review_score"),
        f"{scratch_root(spark)}/reviews",
    )
    typed = "review_id string, order_id string, review_score double"
    schema = spark.createDataFrame([], typed).schema
    return files.csv_table(spark, folder, schema, rescue=True).withColumnRenamed(files.RESCUED, "rescued_data")


@query
def src5_csv_read(spark, sf_dir):
    folder = _land_csv(raw(spark, sf_dir, "order_items"), f"{scratch_root(spark)}/items")
    return files.csv_table(spark, folder)


@query
def src6_table_by_path(spark, sf_dir):
    return tables.read_path(spark, _land(raw(spark, sf_dir, "sellers"), f"{scratch_root(spark)}/sellers"))


@query
def src7_table_by_name(spark, sf_dir):
    path = _land(raw(spark, sf_dir, "sellers"), f"{scratch_root(spark)}/sellers")
    name = _fresh_name("sellers")
    tables.register(spark, name, path)
    return tables.read_table(spark, name)


@query
def src8_sql_over_path(spark, sf_dir):
    return tables.query_path(spark, _land(bodies(spark, sf_dir, "orders"), f"{scratch_root(spark)}/bodies"))


@query
def src9_topic_bodies(spark, sf_dir):
    """Binary broker values to text, through a stream."""
    root = scratch_root(spark)
    messages = bodies(spark, sf_dir, "orders").select(F.col("Body").cast("binary").alias("value"))
    stream = spark.readStream.schema("value binary").parquet(_land(messages, f"{root}/topic"))
    start_bronze(events.body_text(stream), f"{root}/bronze", f"{root}/checkpoint", None).awaitTermination()
    return tables.read_path(spark, f"{root}/bronze")


@query
def src10_table_stream(spark, sf_dir):
    root = scratch_root(spark)
    stream = events.body_stream(spark, _land(bodies(spark, sf_dir, "items"), f"{root}/bronze"))
    files.drain(stream, f"{root}/copy", f"{root}/checkpoint").awaitTermination()
    return tables.read_path(spark, f"{root}/copy")


# --- sinks ----------------------------------------------------------------------------------------


def _fresh_name(table: str) -> str:
    import uuid

    return f"{table}_{uuid.uuid4().hex[:12]}"


@query
def snk1_drain_append(spark, sf_dir):
    """Drained twice: the second run finds no new file and adds nothing."""
    return _ingested(spark, sf_dir, "geolocation", runs=2)


@query
def snk2_interval_append(spark, sf_dir):
    root = scratch_root(spark)
    stream = events.body_stream(spark, _land(bodies(spark, sf_dir, "payments"), f"{root}/topic"))
    running = start_bronze(stream, f"{root}/bronze", f"{root}/checkpoint", "1 second")
    running.processAllAvailable()
    running.stop()
    return tables.read_path(spark, f"{root}/bronze")


@query
def snk3_foreach_batch(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "items")


@query
def snk4_batch_append(spark, sf_dir):
    """Two batches, the second delivered twice: its rows are there once."""
    path = f"{scratch_root(spark)}/silver"
    stream_silver.write_batch(cleaners.clean_events(bodies(spark, sf_dir, "payments"), "payments"), path, 0)
    again = cleaners.clean_events(bodies(spark, sf_dir, "payments"), "payments")
    for _ in range(2):
        stream_silver.write_batch(again, path, 1)
    return tables.read_path(spark, path).drop("writer")


@query
def snk4_new_checkpoint(spark, sf_dir):
    """A stream that starts over with a new checkpoint adds its rows to those of the old one."""
    root = scratch_root(spark)
    _land(bodies(spark, sf_dir, "orders"), f"{root}/bronze")
    for name in ("c1", "c2"):
        stream = events.body_stream(spark, f"{root}/bronze")
        stream_silver.start_silver(stream, "orders", f"{root}/silver", f"{root}/{name}", None).awaitTermination()
    return tables.read_path(spark, f"{root}/silver").drop("writer", "batch_id")


@query
def snk5_overwrite(spark, sf_dir):
    path = f"{scratch_root(spark)}/silver"
    tables.overwrite(_standardised(spark, sf_dir, "customers"), path)
    tables.overwrite(_valid(spark, sf_dir, "customers"), path)
    return tables.read_path(spark, path)


@query
def snk6_quarantine_append(spark, sf_dir):
    """Two runs, the second repeated: each run's rows are there once."""
    path = f"{scratch_root(spark)}/quarantine"
    for run in ("r1", "r2", "r2"):
        tables.write_run(_clean(spark, sf_dir, "order_items").rejected, path, run)
    return tables.read_path(spark, path)


@query
def snk6_run_id_text(spark, sf_dir):
    """Run ids that look like numbers and dates stay the text that they are."""
    path = f"{scratch_root(spark)}/quarantine"
    for run in ("007", "2024-01-05", "it's"):
        tables.write_run(_clean(spark, sf_dir, "order_items").rejected, path, run)
    return tables.read_runs(spark, path)


@query
def snk7_replace_table(spark, sf_dir):
    name, path = _fresh_name("dim_sellers"), f"{scratch_root(spark)}/gold"
    for rows in (raw(spark, sf_dir, "sellers"), _gold(spark, sf_dir, "dim_sellers")):
        tables.replace_table(rows, name, path)
    return tables.read_table(spark, name)


@query
def snk8_register_table(spark, sf_dir):
    schema, path = _fresh_name("lake"), f"{scratch_root(spark)}/silver"
    tables.overwrite(_valid(spark, sf_dir, "sellers"), path)
    tables.create_schema(spark, schema, "registered tables")
    tables.register(spark, f"{schema}.sellers", path)
    (listed,) = tables.list_tables(spark, schema).collect()
    return tables.read_table(spark, f"{schema}.sellers").withColumn("table_name", F.lit(listed.tableName))


@query
def snk8_quarantine_by_name(spark, sf_dir):
    """A quarantine read by name after its first run and again after its second."""
    name, path = _fresh_name("quarantine"), f"{scratch_root(spark)}/quarantine"
    for run in ("r1", "r2"):
        tables.write_run(_clean(spark, sf_dir, "order_items").rejected, path, run)
        tables.register(spark, name, path, parts=tables.RUN_PARTS)
        tables.read_table(spark, name).count()
    return tables.read_table(spark, name)


@query
def snk8_gold_after_rerun(spark, sf_dir):
    """A table that was read by name, rewritten, and read by name again."""
    name, path = _fresh_name("fact_orders"), f"{scratch_root(spark)}/gold"
    for _ in range(2):
        tables.overwrite(_gold(spark, sf_dir, "fact_orders"), path)
        tables.register(spark, name, path)
        tables.read_table(spark, name).count()
    return tables.read_table(spark, name)


@query
def snk9_event_json(spark, sf_dir):
    return events.to_events(_typed(spark, sf_dir, "order_payments"))


@query
def snk10_order_events(spark, sf_dir):
    return events.order_events(
        _typed(spark, sf_dir, "orders"),
        raw(spark, sf_dir, "order_items"),
        _typed(spark, sf_dir, "order_payments"),
    )


# --- projections and filters ----------------------------------------------------------------------


@query
def prj1_subset(spark, sf_dir):
    return raw(spark, sf_dir, "order_reviews").select("order_id", "review_id")


@query
def prj2_drop(spark, sf_dir):
    return raw(spark, sf_dir, "order_payments").drop("payment_value", "payment_type")


@query
def prj3_replace(spark, sf_dir):
    zip_code = F.col("customer_zip_code_prefix").cast("int")
    return raw(spark, sf_dir, "customers").withColumns(
        {"customer_zip_code_prefix": zip_code, "customer_state": text.upper_code(F.col("customer_state"))}
    )


@query
def prj4_struct_flatten(spark, sf_dir):
    return cleaners.parse(bodies(spark, sf_dir, "payments"), EVENT_SCHEMAS["payments"])


@query
def prj5_cast_rename(spark, sf_dir):
    messages = bodies(spark, sf_dir, "payments").select(F.encode("Body", "UTF-8").alias("value"))
    return events.body_text(messages)


@query
def prj6_alias(spark, sf_dir):
    p, c = raw(spark, sf_dir, "products").alias("p"), raw(spark, sf_dir, "category_translation").alias("c")
    same = F.col("p.product_category_name") == F.col("c.product_category_name")
    return p.join(c, same).select("p.product_id", F.col("c.product_category_name_english").alias("english_name"))


@query
def prj7_constant(spark, sf_dir):
    return raw(spark, sf_dir, "sellers").withColumn("source_table", F.lit("sellers"))


@query
def flt1_ranges(spark, sf_dir):
    lat, lng = F.col("geolocation_lat"), F.col("geolocation_lng")
    zip_code = F.col("geolocation_zip_code_prefix")
    keep = (lat >= -90) & (lat < 90) & (lng > -180) & (lng <= 180) & (zip_code != 1005)
    return _typed(spark, sf_dir, "geolocation").filter(keep | (zip_code == -1))


@query
def flt2_nulls(spark, sf_dir):
    orders = _typed(spark, sf_dir, "orders")
    return orders.filter(
        F.col("order_approved_at").isNull() & F.col("order_purchase_timestamp").isNotNull()
    ).select("order_id", "order_status", "order_purchase_timestamp")


@query
def flt3_blank(spark, sf_dir):
    return raw(spark, sf_dir, "order_items").filter(text.is_blank(F.col("seller_id")))


@query
def flt4_regex(spark, sf_dir):
    seller, state = F.col("seller_id"), text.upper_code(F.col("seller_state"))
    bad = ~seller.rlike(text.HEX_32) | text.is_numeric_text(F.col("seller_city")) | ~state.rlike(text.TWO_CAPITALS)
    return raw(spark, sf_dir, "sellers").filter(bad)


@query
def flt5_membership(spark, sf_dir):
    state = text.upper_code(F.col("seller_state"))
    return raw(spark, sf_dir, "sellers").withColumn("is_known", state.isin(*SELLER_STATES)).filter(
        ~state.isin("SP", "RJ")
    )


@query
def flt6_column_compare(spark, sf_dir):
    late = F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    padded = text.is_untrimmed(F.col("order_status"))
    return _typed(spark, sf_dir, "orders").filter(late & padded)


@query
def flt7_three_valued(spark, sf_dir):
    """AND, OR and NOT over NULL operands, shown per row."""
    heavy, long = F.col("product_weight_g") > 600, F.col("product_length_cm") > 20
    return _typed(spark, sf_dir, "products").select(
        "product_id",
        (heavy & long).alias("heavy_and_long"),
        (heavy | long).alias("heavy_or_long"),
        (~heavy).alias("not_heavy"),
    )


@query
def flt8_contains(spark, sf_dir):
    return raw(spark, sf_dir, "order_reviews").filter(F.col("review_answer_timestamp").contains("1996-07")).select(
        "review_id", "order_id", "review_answer_timestamp"
    )


@query
def flt9_drop_value(spark, sf_dir):
    df = _standardised(spark, sf_dir, "order_payments")
    return df.filter(F.col("payment_type") != "NOT_DEFINED")


@query
def flt10_status_subset(spark, sf_dir):
    wanted = ("processing", "canceled", "unavailable", "created")
    return _typed(spark, sf_dir, "orders").filter(F.col("order_status").isin(*wanted)).select(
        "order_status", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"
    )


# --- joins ----------------------------------------------------------------------------------------


@query
def jn1_left_to_group_mean(spark, sf_dir):
    products = _standardised(spark, sf_dir, "products")
    means = impute.group_means(products, "product_category_name", {"product_weight_g": F.col("product_weight_g") > 0})
    joined = join_one_per_key(products, means, ["product_category_name"])
    return joined.select(
        "product_category_name", "product_id", F.col("product_weight_g__mean").alias("category_mean_weight")
    )


@query
def jn2_left_translation(spark, sf_dir):
    rows = _gold(spark, sf_dir, "dim_products")
    return rows.select("product_id", "product_category_name", "product_category_name_english")


@query
def jn3_items_orders(spark, sf_dir):
    items, orders = _valid(spark, sf_dir, "order_items"), _valid(spark, sf_dir, "orders")
    return items.join(orders, "order_id", "inner").select("order_id", "order_item_id", "customer_id", "price")


@query
def jn4_payments_orders(spark, sf_dir):
    payments, orders = _valid(spark, sf_dir, "order_payments"), _valid(spark, sf_dir, "orders")
    return payments.join(orders, "order_id", "inner").select("order_id", "payment_type", "order_status")


@query
def jn5_fact_date(spark, sf_dir):
    fact, days = _gold(spark, sf_dir, "fact_payments"), _gold(spark, sf_dir, "dim_date")
    return fact.join(days, "date_key", "inner").select("order_id", "date_key", "day_name", "payment_value")


@query
def jn6_fact_dimensions(spark, sf_dir):
    def dimension(name, *columns):
        return _gold(spark, sf_dir, name).select(*columns)

    orders = _valid(spark, sf_dir, "orders").join(dimension("dim_customers", "customer_id", "customer_state"), "customer_id", "inner")
    return (
        gold.fact_orders(_valid(spark, sf_dir, "order_items"), orders, ["customer_state"])
        .join(dimension("dim_products", "product_id", "product_category_name"), "product_id", "inner")
        .join(dimension("dim_sellers", "seller_id", "seller_city"), "seller_id", "inner")
        .select("order_id", "order_item_id", "customer_state", "product_category_name", "seller_city", "price")
    )


# --- aggregates -----------------------------------------------------------------------------------


@query
def ag1_row_count(spark, sf_dir):
    return profile.row_total(raw(spark, sf_dir, "order_items"))


@query
def ag2_global_sum(spark, sf_dir):
    both = [measures.total("revenue", "price"), measures.total("revenue_rounded", "price", 2)]
    return measures.summarise(_typed(spark, sf_dir, "order_items"), (), both)


@query
def ag3_global_count(spark, sf_dir):
    return measures.summarise(_typed(spark, sf_dir, "order_payments"), (), [measures.row_count("rows_total")])


@query
def ag4_global_mean(spark, sf_dir):
    return measures.summarise(
        _typed(spark, sf_dir, "order_items"), (), [measures.average("mean_freight", "freight_value", 2)]
    )


@query
def ag5_grouped_sum(spark, sf_dir):
    return measures.summarise(
        _typed(spark, sf_dir, "order_items"), ("seller_id",), [measures.total("revenue", "price")]
    )


@query
def ag6_grouped_rounded_sum(spark, sf_dir):
    return measures.summarise(
        _standardised(spark, sf_dir, "order_payments"),
        ("payment_type",),
        [measures.total("paid", "payment_value", 2)],
    )


@query
def ag7_grouped_count(spark, sf_dir):
    return measures.summarise(_typed(spark, sf_dir, "orders"), ("order_status",), [measures.row_count("order_count")])


@query
def ag8_grouped_mean_count(spark, sf_dir):
    return measures.summarise(
        _typed(spark, sf_dir, "order_reviews"),
        ("review_comment_title",),
        [measures.average("mean_score", "review_score", 2), measures.row_count("review_count")],
    )


@query
def ag9_filtered_group_mean(spark, sf_dir):
    weight = F.col("product_weight_g")
    heavy = _standardised(spark, sf_dir, "products").filter(weight > 0)
    return heavy.groupBy("product_category_name").agg(F.round(F.mean(weight)).alias("mean_weight"))


@query
def ag10_null_profile(spark, sf_dir):
    return profile.nulls(raw(spark, sf_dir, "products"))


def _doubled(df: DataFrame) -> DataFrame:
    """Every row twice: duplicates for tables that have none of their own."""
    return df.unionAll(df)


@query
def ag11_duplicate_count(spark, sf_dir):
    return profile.duplicates(_doubled(_typed(spark, sf_dir, "order_payments")))


@query
def ag12_duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(raw(spark, sf_dir, "order_items"), ["order_id", "order_item_id"])


@query
def ag13_value_counts(spark, sf_dir):
    return profile.value_counts(_typed(spark, sf_dir, "geolocation"), "geolocation_zip_code_prefix")


@query
def ag14_distinct_rows(spark, sf_dir):
    return dedupe.distinct_rows(_doubled(_typed(spark, sf_dir, "order_items")))


@query
def ag15_one_per_key(spark, sf_dir):
    return dedupe.one_per_key(_typed(spark, sf_dir, "order_items"), ["order_id", "order_item_id"])


@query
def ag16_distinct_expressions(spark, sf_dir):
    bought = F.col("order_purchase_timestamp")
    return _typed(spark, sf_dir, "orders").select(
        F.year(bought).alias("year"), F.month(bought).alias("month"), F.date_format(bought, "MMMM").alias("month_name")
    ).distinct()


@query
def ag17_distinct_values(spark, sf_dir):
    return profile.distinct_values(raw(spark, sf_dir, "order_reviews"), "review_score")


# --- sorting --------------------------------------------------------------------------------------


@query
def st1_sort_ascending(spark, sf_dir):
    return _gold(spark, sf_dir, "dim_date").select("full_date", "date_key", "week").orderBy("full_date")


@query
def st2_sort_by_aggregate(spark, sf_dir):
    return profile.value_counts(_standardised(spark, sf_dir, "customers"), "customer_state")


@query
def st3_sort_by_hidden_column(spark, sf_dir):
    days = _gold(spark, sf_dir, "dim_date")
    per_month = days.groupBy("year", "month", "month_name").agg(F.count(F.lit(1)).alias("days"))
    return per_month.orderBy("year", "month").select("year", "month_name", "days")


@query
def st4_top_k(spark, sf_dir):
    priced = _typed(spark, sf_dir, "order_items").select("order_id", "order_item_id", "product_id", "price")
    return priced.orderBy(F.desc("price"), "order_id", "order_item_id", "product_id").limit(10)


@query
def st5_preview(spark, sf_dir):
    """A preview of ten rows; ordered, because an unordered one could not be compared."""
    return _valid(spark, sf_dir, "customers").orderBy("customer_id", "customer_unique_id").limit(10)


# --- scalar functions -----------------------------------------------------------------------------


def _function(name: str, table: str, key: str, make: Callable[[], dict]) -> None:
    """Register ``key`` plus computed columns over one raw table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return raw(spark, sf_dir, table).select(key, *[column.alias(alias) for alias, column in make().items()])

    QUERIES[name] = run


def _c(name: str):
    return F.col(name)


def _purchased():
    return F.col("order_purchase_timestamp").cast("timestamp")


def _price():
    return F.col("price").cast("double")


_function("fn_trim", "customers", "customer_id", lambda: {"result": F.trim(_c("customer_state"))})
_function("fn_lower", "order_payments", "order_id", lambda: {"result": F.lower(_c("payment_type"))})
_function("fn_upper", "orders", "order_id", lambda: {"result": F.upper(_c("order_status"))})
_function("fn_initcap", "customers", "customer_id", lambda: {"result": F.initcap(_c("customer_city"))})
_function("fn_length", "order_reviews", "order_id", lambda: {"result": F.length(_c("review_comment_message"))})
_function(
    "fn_concat_ws",
    "order_reviews",
    "order_id",
    lambda: {"result": F.concat_ws(" | ", "review_comment_title", "review_score", "review_creation_date")},
)
_function(
    "fn_regexp_replace_newline",
    "order_reviews",
    "order_id",
    lambda: {"result": text.single_line(_c("review_comment_message"))},
)
_function(
    "fn_regexp_replace_underscore",
    "products",
    "product_id",
    lambda: {"result": F.regexp_replace("product_category_name", "_", " ")},
)
_function(
    "fn_regexp_replace_spaces",
    "sellers",
    "seller_id",
    lambda: {"result": F.regexp_replace("seller_city", r"\s+", " ")},
)
_function("fn_translate", "sellers", "seller_id", lambda: {"result": text.fold_accents(_c("seller_city"))})
_function("fn_contains", "products", "product_id", lambda: {"result": _c("product_category_name").contains("med")})
_function(
    "fn_rlike",
    "customers",
    "customer_id",
    lambda: {"result": text.is_numeric_text(_c("customer_city")), "is_hex": _c("customer_id").rlike(text.HEX_32)},
)
_function(
    "fn_isin",
    "sellers",
    "seller_id",
    lambda: {"result": text.upper_code(_c("seller_state")).isin(*SELLER_STATES)},
)
_function("fn_lit", "sellers", "seller_id", lambda: {"result": F.lit("sellers")})
_function(
    "fn_when_otherwise",
    "order_payments",
    "order_id",
    lambda: {
        "result": F.when(_c("payment_type").isin("credit_card", "Credit_Card"), F.lit("card")).otherwise(
            _c("payment_type")
        )
    },
)
_function(
    "fn_when_null",
    "order_items",
    "order_id",
    lambda: {"order_item_id": _c("order_item_id"), "result": F.when(_price() < 0, F.lit("Negative Price"))},
)
_function(
    "fn_case_when",
    "orders",
    "order_id",
    lambda: {"result": F.expr("CASE WHEN order_status = 'shipped' THEN TRUE ELSE FALSE END")},
)
_function("fn_binary_to_string", "sellers", "seller_id", lambda: {
    "result": F.encode("seller_city", "UTF-8").cast("string")
})
_function("fn_cast", "order_items", "order_id", lambda: {
    "item": _c("order_item_id").cast("int"),
    "limit_date": _c("shipping_limit_date").cast("timestamp"),
    "price": _price(),
})
_function("fn_try_cast", "order_reviews", "order_id", lambda: {
    "score": _c("review_score").try_cast("double"),
    "created": _c("review_creation_date").try_cast("timestamp"),
})
_function("fn_date_key", "orders", "order_id", lambda: {"result": calendar.date_key(_purchased())})
_function("fn_date", "orders", "order_id", lambda: {"result": F.to_date(_purchased())})
_function("fn_year", "orders", "order_id", lambda: {"result": F.year(_purchased())})
_function("fn_quarter", "orders", "order_id", lambda: {"result": F.quarter(_purchased())})
_function("fn_month", "orders", "order_id", lambda: {"result": F.month(_purchased())})
_function("fn_month_name", "orders", "order_id", lambda: {"result": F.date_format(_purchased(), "MMMM")})
_function("fn_weekofyear", "orders", "order_id", lambda: {"result": F.weekofyear(_purchased())})
_function("fn_day", "orders", "order_id", lambda: {"result": F.dayofmonth(_purchased())})
_function("fn_day_name", "orders", "order_id", lambda: {"result": F.date_format(_purchased(), "EEEE")})
_function("fn_is_weekend", "orders", "order_id", lambda: {"result": calendar.is_weekend(_purchased())})
_function("fn_current_timestamp", "sellers", "seller_id", lambda: {
    "is_stamped": F.abs(F.unix_timestamp(F.current_timestamp()) - F.lit(int(time.time()))) < 3600,
})
_function("fn_round2", "order_items", "order_id", lambda: {
    "order_item_id": _c("order_item_id"),
    "result": F.round((_price() / 7).cast("decimal(18,6)"), 2).cast("double"),
})
_function("fn_round0", "order_items", "order_id", lambda: {
    "order_item_id": _c("order_item_id"),
    "result": F.round(_price().cast("decimal(18,6)")).cast("double"),
})


@query
def fn_mean(spark, sf_dir):
    return _typed(spark, sf_dir, "products").agg(
        F.mean("product_weight_g").alias("mean_weight"), F.avg("product_width_cm").alias("mean_width")
    )


@query
def fn_fillna_subset(spark, sf_dir):
    return raw(spark, sf_dir, "order_reviews").select("order_id", "review_comment_title", "review_comment_message").fillna(
        "No Title", subset=["review_comment_title"]
    )


@query
def fn_fillna_map(spark, sf_dir):
    terms = silver.contract("products")
    return nulls.null_policy(_typed(spark, sf_dir, "products"), fill=terms.fill)


@query
def fn_dropna_any(spark, sf_dir):
    return raw(spark, sf_dir, "customers").dropna()


@query
def fn_dropna_subset(spark, sf_dir):
    return raw(spark, sf_dir, "products").dropna(subset=["product_category_name", "product_weight_g"])


@query
def fn_try_to_timestamp(spark, sf_dir):
    parsed = cleaners.parse(bodies(spark, sf_dir, "orders"), EVENT_SCHEMAS["orders"])
    pattern = F.lit(cleaners.TIMESTAMP_PATTERN)
    return parsed.select("order_id", F.try_to_timestamp("order_purchase_timestamp", pattern).alias("result"))


@query
def fn_from_json(spark, sf_dir):
    return cleaners.parse(bodies(spark, sf_dir, "items"), EVENT_SCHEMAS["items"])


@query
def fn_to_json(spark, sf_dir):
    return events.to_events(raw(spark, sf_dir, "sellers"))


# --- data quality ---------------------------------------------------------------------------------


@query
def dq1_cast_contract(spark, sf_dir):
    terms = silver.contract("order_items")
    return casting.cast_columns(raw(spark, sf_dir, "order_items"), terms.casts)


@query
def dq1_try_cast_contract(spark, sf_dir):
    terms = silver.contract("order_reviews")
    return casting.cast_columns(raw(spark, sf_dir, "order_reviews"), terms.casts, try_=True)


@query
def dq1_unparsable(spark, sf_dir):
    """Rows whose text the casts would refuse, as they arrived."""
    return silver.split_unparsable(raw(spark, sf_dir, "order_reviews"), "order_reviews", _as_of()).rejected


@query
def dq2_error_reason(spark, sf_dir):
    return rules.tag(_refined(spark, sf_dir, "order_payments"), silver.contract("order_payments").rules)


@query
def dq3_split(spark, sf_dir):
    terms = silver.contract("customers")
    valid, rejected = rules.split(_refined(spark, sf_dir, "customers"), terms.rules, terms.keep)
    kept = valid.select("customer_id", F.lit("valid").alias("side"), F.lit("").alias("error_reason"))
    return kept.unionByName(rejected.select("customer_id", F.lit("rejected").alias("side"), "error_reason"))


@query
def dq3_strict_split(spark, sf_dir):
    """The gap of the products table closed: undecided rows are quarantined."""
    return silver.clean(raw(spark, sf_dir, "products"), "products", _as_of(), strict=True).rejected


@query
def dq3_strict_sellers(spark, sf_dir):
    """Unknown states leave with a reason instead of silently."""
    return silver.clean(raw(spark, sf_dir, "sellers"), "sellers", _as_of(), strict=True).rejected


@query
def dq4_quarantine_metadata(spark, sf_dir):
    rejected = _refined(spark, sf_dir, "geolocation").filter(F.col("geolocation_lat") > 90)
    return rules.quarantine(rejected, "geolocation", _as_of())


@query
def dq5_null_policy(spark, sf_dir):
    terms = silver.contract("order_reviews")
    return nulls.null_policy(_typed(spark, sf_dir, "order_reviews"), terms.fill, terms.require)


@query
def dq6_group_mean(spark, sf_dir):
    products = _standardised(spark, sf_dir, "products")
    return impute.group_mean(products, "product_category_name", {"product_weight_g": F.col("product_weight_g") > 0})


@query
def dq8_standardise(spark, sf_dir):
    return raw(spark, sf_dir, "sellers").select(
        "seller_id",
        text.city_title(F.col("seller_city")).alias("seller_city"),
        text.upper_code(F.col("seller_state")).alias("seller_state"),
    )


@query
def dq9_hard_drop(spark, sf_dir):
    return _refined(spark, sf_dir, "sellers")


# --- streaming ------------------------------------------------------------------------------------


def _stream_silver(spark: SparkSession, sf_dir: str, table: str, quarantine: bool = False) -> DataFrame:
    """Bodies landed as files, drained through the real stream, read back."""
    root = scratch_root(spark)
    stream = events.body_stream(spark, _land(bodies(spark, sf_dir, table), f"{root}/bronze"))
    rejected = f"{root}/quarantine" if quarantine else None
    stream_silver.start_silver(
        stream, table, f"{root}/silver", f"{root}/checkpoint", None, rejected
    ).awaitTermination()
    return tables.read_path(spark, rejected or f"{root}/silver").drop("writer", "batch_id")


@query
def bronze_stream(spark, sf_dir):
    root = scratch_root(spark)
    stream = events.body_stream(spark, _land(bodies(spark, sf_dir, "items"), f"{root}/topic"))
    start_bronze(stream, f"{root}/bronze", f"{root}/checkpoint", None).awaitTermination()
    return tables.read_path(spark, f"{root}/bronze")


@query
def str2_skip_empty(spark, sf_dir):
    """An empty batch writes nothing; the batch around it does."""
    path = f"{scratch_root(spark)}/silver"
    process = stream_silver.batch_sink("orders", path)
    full = bodies(spark, sf_dir, "orders")
    process(full, 0)
    process(full.filter(F.lit(False)), 1)
    return tables.read_path(spark, path).drop("writer")


@query
def str3_json_parse(spark, sf_dir):
    return cleaners.parse(bodies(spark, sf_dir, "orders"), EVENT_SCHEMAS["orders"])


@query
def stream_silver_orders(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "orders")


@query
def stream_silver_items(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "items")


@query
def stream_silver_payments(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "payments")


def _side_by_side(rows: dict[str, DataFrame]) -> DataFrame:
    first, *rest = [df.select(F.lit(table).alias("event_table"), "*") for table, df in rows.items()]
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


@query
def str7_dispatch(spark, sf_dir):
    """The table name picks the cleaner: all rows kept, with their table."""
    return _side_by_side({table: cleaners.clean_events(bodies(spark, sf_dir, table), table) for table in cleaners.CONTRACTS})


@query
def str8_start_silver(spark, sf_dir):
    """A running query on an interval, stopped after it has caught up."""
    root = scratch_root(spark)
    stream = events.body_stream(spark, _land(bodies(spark, sf_dir, "orders"), f"{root}/bronze"))
    running = stream_silver.start_silver(stream, "orders", f"{root}/silver", f"{root}/checkpoint", "1 second")
    running.processAllAvailable()
    running.stop()
    return tables.read_path(spark, f"{root}/silver").drop("writer", "batch_id")


@query
def str9_three_queries(spark, sf_dir):
    """Three independent queries side by side in one session."""
    lake = _lake(spark)
    for table in EVENT_SCHEMAS:
        _land(bodies(spark, sf_dir, table), lake.path("stream_bronze", table))
    for running in stream_silver.start_all(spark, lake, None).values():
        running.awaitTermination()
    kept = {table: tables.read_path(spark, lake.path("stream_silver", table)) for table in EVENT_SCHEMAS}
    return _side_by_side({table: rows.drop("writer", "batch_id") for table, rows in kept.items()})


# --- options beyond the base pipeline -------------------------------------------------------------


@query
def x1_stream_quarantine(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "orders", quarantine=True)


@query
def x1_stream_quarantine_items(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "items", quarantine=True)


@query
def x1_stream_quarantine_payments(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "payments", quarantine=True)


@query
def x2_newest_versions(spark, sf_dir):
    """Two batches of the same orders, the later one with a new status for those without an approval."""
    root = scratch_root(spark)
    first = _valid(spark, sf_dir, "orders")
    second = first.filter(F.col("order_approved_at").isNull()).withColumn("order_status", F.lit("CLOSED"))
    for batch_id, rows in enumerate((first, second)):
        stream_silver.write_batch(rows, f"{root}/history", batch_id)
        state.compact(spark, f"{root}/history", f"{root}/current", ["order_id"])
    return state.compacted(spark, f"{root}/current").drop("writer", state.COMMITTED)


@query
def x2_two_writers(spark, sf_dir):
    """A stream that starts over counts its batches from 0; its versions are the newer ones all the same."""
    root = scratch_root(spark)
    first = _valid(spark, sf_dir, "orders")
    second = first.filter(F.col("order_approved_at").isNull()).withColumn("order_status", F.lit("CLOSED"))
    for rows, batch_id, writer in ((first, 5, "old checkpoint"), (second, 0, "new checkpoint")):
        stream_silver.write_batch(rows, f"{root}/history", batch_id, writer=writer)
        state.compact(spark, f"{root}/history", f"{root}/current", ["order_id"], buckets=8)
    state.retire(spark, f"{root}/current")
    return state.compacted(spark, f"{root}/current").drop(state.COMMITTED)


@query
def x3_shared_gold(spark, sf_dir):
    """Batch orders plus those events whose order the batch does not hold."""
    streamed = cleaners.clean_events(bodies(spark, sf_dir, "orders"), "orders")
    return unify.unify(_valid(spark, sf_dir, "orders"), streamed, "orders")


@query
def x3_two_writers(spark, sf_dir):
    """Both pipelines after a stream has started over: the newer writer's rows count, whatever their batch's number."""
    lake = _lake(spark)
    orders = _valid(spark, sf_dir, "orders")
    tables.overwrite(orders.filter("order_id < '8'"), lake.silver("orders"))
    for status, batch_id, writer in (("old", 500, "a"), ("new", 0, "b")):
        rows = orders.withColumn("order_status", F.lit(status))
        stream_silver.write_batch(rows, lake.path("stream_silver", "orders"), batch_id, writer=writer)
    return batch.silver_rows(spark, lake, "orders", with_streams=True)


def _wide_events(spark: SparkSession, sf_dir: str, entity: str, table: str) -> DataFrame:
    """A batch table published as events and cleaned as a stream batch with the wide payload."""
    return cleaners.clean_events(events.to_events(_typed(spark, sf_dir, entity)), table, WIDE_EVENT_SCHEMAS[table])


def _shared(spark: SparkSession, sf_dir: str, entity: str, table: str) -> DataFrame:
    return unify.unify(_valid(spark, sf_dir, entity), _wide_events(spark, sf_dir, entity, table), table)


@query
def x3_shared_payments(spark, sf_dir):
    """Events with the wide payload fill in payments that the batch rejected or dropped."""
    return _shared(spark, sf_dir, "order_payments", "payments")


@query
def x3_shared_fact_payments(spark, sf_dir):
    """A gold fact over both pipelines."""
    shared = {
        "order_payments": _shared(spark, sf_dir, "order_payments", "payments"),
        "orders": _shared(spark, sf_dir, "orders", "orders"),
    }
    return gold.build("fact_payments", shared)


@query
def x4_geolocation_by_zip(spark, sf_dir):
    return silver.geolocation_by_zip(_valid(spark, sf_dir, "geolocation"))


@query
def x5_impute_dimensions(spark, sf_dir):
    return impute.group_mean(
        _standardised(spark, sf_dir, "products"),
        "product_category_name",
        {name: F.col(name) > 0 for name in PRODUCT_DIMENSIONS},
    )


@query
def x6_reprocess(spark, sf_dir):
    """Quarantined locations with the sign of the zip code repaired, cleaned again."""
    rejected = _clean(spark, sf_dir, "geolocation").rejected
    repaired = silver.reprocess(
        rejected,
        "geolocation",
        lambda df: df.withColumn("geolocation_zip_code_prefix", F.abs("geolocation_zip_code_prefix")),
    )
    return repaired.valid


@query
def x6_after_next_run(spark, sf_dir):
    """Corrected locations are in the trusted table of the next run, beside those that were right."""
    lake = _lake(spark)
    _land_csv(raw(spark, sf_dir, "geolocation"), lake.raw("geolocation"))
    batch.ingest(spark, lake, ["geolocation"])
    batch.refine(spark, lake, "geolocation", "r1")
    zip_code = "geolocation_zip_code_prefix"
    corrections.correct(spark, lake, "geolocation", "signs", lambda df: df.withColumn(zip_code, F.abs(zip_code)), "r1")
    batch.refine(spark, lake, "geolocation", "r2")
    return tables.read_path(spark, lake.silver("geolocation"))


@query
def x6_stream_bodies(spark, sf_dir):
    """Rejected events whose time was no time, sent through the contract again with one."""
    lake = _lake(spark)
    stream = events.body_stream(spark, _land(bodies(spark, sf_dir, "orders"), lake.path("stream_bronze", "orders")))
    paths = [lake.path(layer, "orders") for layer in ("stream_silver", "stream_quarantine")]
    stream_silver.start_silver(stream, "orders", paths[0], lake.checkpoint("stream_silver", "orders"), None, paths[1]).awaitTermination()
    fix = lambda df: df.withColumn("Body", F.replace("Body", F.lit('"NaT"'), F.lit('"2024-01-01 00:00:00"')))
    for _ in range(2):
        corrections.correct_bodies(spark, lake, "orders", "no time", fix)
    return tables.read_path(spark, paths[0]).drop("writer", "batch_id")


@query
def dq10_write_pass(spark, sf_dir):
    """What a run wrote, counted while it was written."""
    lake = _prepared_lake(spark, sf_dir)
    batch.ingest(spark, lake)
    batch.each(spark, CONTRACTS, lambda entity: batch.refine(spark, lake, entity, "r1"))
    lines = [tables.read_runs(spark, lake.path("ledger", entity)) for entity in CONTRACTS]
    every = lines[0]
    for more in lines[1:]:
        every = every.unionByName(more)
    null_count = F.aggregate(F.map_values("null_counts"), F.lit(0).cast("long"), lambda n, x: n + x)
    return every.filter("side = 'valid'").select("table_name", "row_count", null_count.alias("null_count"), "run_id").unionByName(
        every.filter("side = 'rejected'").select(F.concat("table_name", F.lit(" rejected")).alias("table_name"), "row_count", F.lit(None).cast("long").alias("null_count"), "run_id")
    )


@query
def str9_supervised(spark, sf_dir):
    """Three streams under supervision: what went in, what was kept and what was rejected, batch by batch."""
    lake = _lake(spark)
    for table in EVENT_SCHEMAS:
        _land(bodies(spark, sf_dir, table), lake.path("stream_bronze", table))
    log = supervise.Log(spark, lake.path("stream_log", "batches"))
    running = stream_silver.start_all(spark, lake, "1 second", with_quarantine=True)
    for one in running.values():
        one.processAllAvailable()
        one.stop()
    supervise.supervise(spark, running, log)
    found = tables.read_path(spark, lake.path("stream_log", "batches"))
    return found.groupBy("event_table").agg(*[F.sum(c).alias(c) for c in ("rows_in", "kept_rows", "rejected_rows")])


@query
def run_both_fact_orders(spark, sf_dir):
    """Both pipelines into one lake, through real streams, and the sales fact over them."""
    lake = _lake(spark)
    tables.overwrite(_valid(spark, sf_dir, "orders").filter("order_id < '8'"), lake.silver("orders"))
    tables.overwrite(_valid(spark, sf_dir, "order_items").filter("order_id < '8'"), lake.silver("order_items"))
    for table, entity in {"orders": "orders", "items": "order_items"}.items():
        _land(events.to_events(_typed(spark, sf_dir, entity)).select("Body"), lake.path("stream_bronze", table))
    for running in stream_silver.start_all(spark, lake, None, schemas=WIDE_EVENT_SCHEMAS, only=["orders", "items"]).values():
        running.awaitTermination()
    batch.publish_gold(spark, lake, "fact_orders", with_streams=True)
    return tables.read_path(spark, lake.gold("fact_orders"))


@query
def x7_cross_batch_dedupe(spark, sf_dir):
    """Orders deduplicated by a stateful stream over several micro-batches: one row per order id.

    Files arrive in no order of time, so the delay spans all of it.
    """
    root = scratch_root(spark)
    landed = _land(bodies(spark, sf_dir, "orders").repartition(4), f"{root}/bronze")
    stream = events.body_stream(spark, landed, maxFilesPerTrigger="1")
    parsed = cleaners.CONTRACTS["orders"].prepare(cleaners.parse(stream, EVENT_SCHEMAS["orders"]))
    timed = parsed.filter(F.col("order_purchase_timestamp").isNotNull())
    unique = state.dedupe_stream(timed, ["order_id"], "order_purchase_timestamp", "36500 days")
    files.drain(unique, f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    return tables.read_path(spark, f"{root}/silver").select("order_id")


@query
def x7_stream_restart(spark, sf_dir):
    """Copies within a week of a kept order go, also after the stream has lost its checkpoint; those of sixty days later stay."""
    lake = _lake(spark)
    sent = bodies(spark, sf_dir, "orders")
    unique = state.Unique(("order_id",), "order_purchase_timestamp", 7, lake.path("stream_digest", "orders"))
    later = cleaners.clean_events(sent, "orders").withColumn("order_purchase_timestamp", F.expr("order_purchase_timestamp + interval 60 days"))
    for n, rows in enumerate((sent, sent, events.to_events(later), sent)):
        stream = events.body_stream(spark, _land(rows, f"{lake.root}/sent/{n}"))
        silver_path, checkpoint = lake.path("stream_silver", "orders"), lake.checkpoint("stream_silver", f"orders-{n}")
        stream_silver.start_silver(stream, "orders", silver_path, checkpoint, None, unique=unique).awaitTermination()
    return tables.read_path(spark, lake.path("stream_silver", "orders")).drop("writer", "batch_id")


def _by_name(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """Items by name after two drains: each micro-batch has told the catalog of its own folder."""
    lake, prefix = _lake(spark), f"{_fresh_name('by')}_"
    for half in (0, 1):
        of_order = F.crc32(F.get_json_object("Body", "$.order_id"))
        rows = bodies(spark, sf_dir, "items").filter(F.pmod(of_order, F.lit(2)) == half)
        rows.write.mode("append").parquet(lake.path("stream_bronze", "items"))
        running = stream_silver.start_all(spark, lake, None, with_quarantine=True, prefix=prefix, only=["items"])
        running["items"].awaitTermination()
    return spark.table(f"{prefix}{layer}.items").drop("writer", "batch_id")


@query
def snk8_stream_by_name(spark, sf_dir):
    return _by_name(spark, sf_dir, "stream_silver")


@query
def snk8_stream_quarantine_by_name(spark, sf_dir):
    return _by_name(spark, sf_dir, "stream_quarantine")


def _prepared_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A raw landing area with all nine entities."""
    lake = _lake(spark)
    for entity in CONTRACTS:
        _land_csv(raw(spark, sf_dir, entity), lake.raw(entity), entity in batch.MULTILINE_ENTITIES)
    return lake


@query
def run_batch_revenue_by_month(spark, sf_dir):
    """The whole pipeline from CSV folders to a report, run twice to show that a repeat changes nothing."""
    lake = _prepared_lake(spark, sf_dir)
    for _ in range(2):
        batch.run_batch(spark, lake, "r1", retire_after=0)  # nobody reads meanwhile
    return batch.report(spark, lake, "kpi_revenue_by_month")


@query
def run_both_fact_payments(spark, sf_dir):
    """Both pipelines into one lake, through real streams, and one gold fact over them."""
    lake = _lake(spark)
    for entity in ("orders", "order_payments"):
        tables.overwrite(_valid(spark, sf_dir, entity), lake.silver(entity))
    sent = {"orders": "orders", "items": "order_items", "payments": "order_payments"}
    for table, entity in sent.items():
        _land(events.to_events(_typed(spark, sf_dir, entity)).select("Body"), lake.path("stream_bronze", table))
    for running in stream_silver.start_all(spark, lake, None, schemas=WIDE_EVENT_SCHEMAS).values():
        running.awaitTermination()
    batch.publish_gold(spark, lake, "fact_payments", with_streams=True)
    return tables.read_path(spark, lake.gold("fact_payments"))


@query
def run_batch_quarantine_counts(spark, sf_dir):
    """Rejected rows per table after a run."""
    lake = _prepared_lake(spark, sf_dir)
    batch.run_batch(spark, lake, "r1")
    counted = None
    for entity in CONTRACTS:
        rows = tables.read_path(spark, lake.quarantine(entity)).agg(
            F.lit(entity).alias("table_name"), F.count(F.lit(1)).alias("rejected_rows")
        )
        counted = rows if counted is None else counted.unionAll(rows)
    return counted


def _scaled(spark, sf_dir, factor, places):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select((F.col("l_extendedprice").cast("double") * factor).alias("x"))
    found = measures.summarise(rows, (), [measures.total("total", "x"), measures.average("mean", "x")])
    return found.select(*[F.round(c, places).alias(c) for c in ("total", "mean")])


@query
def measure_small_amounts(spark, sf_dir):
    """Amounts that lie beyond the sixth decimal for the most."""
    return _scaled(spark, sf_dir, 1e-9, 9)


@query
def measure_large_amounts(spark, sf_dir):
    """Amounts that no decimal(18,6) holds."""
    return _scaled(spark, sf_dir, 1e10, -6)

"""Raw-shaped test tables derived from the given parquet tables.

The texts run unchanged on Spark SQL and on DuckDB, so both sides of a comparison start from the same
rows. All columns are text, as in a raw layer. Each text contains deliberate dirt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SQL: dict[str, str] = {
    "fx_customers": r"""
with b as (select case when c_custkey % 97 = 5 then cast(c_custkey as string) else md5('c' || cast(c_custkey as string)) end as customer_id,
 md5('u' || cast(c_custkey % 1000 as string)) as customer_unique_id,
 cast(case when c_custkey % 89 = 5 then -1 else 1000 + c_custkey % 900 end as string) as customer_zip_code_prefix,
 case when c_custkey % 83 = 5 then '12345' when c_custkey % 79 = 5 then null else 'city ' || cast(c_nationkey as string) end as customer_city,
 case when c_custkey % 73 = 5 then '77' else ' ' || lower(substr('ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSRORRSCSPSETO', c_nationkey*2+1, 2)) end as customer_state, c_custkey as k from customer)
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state from b
union all select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state from b where k % 50 = 0
""",
    "fx_geolocation": r"""
select cast(case when c_custkey % 89 = 5 then -1 else 1000 + c_custkey % 900 end as string) as geolocation_zip_code_prefix,
 cast(c_custkey % 190 - 95 as string) as geolocation_lat, cast(c_custkey % 370 - 185 as string) as geolocation_lng,
 case when c_custkey % 83 = 5 then '12345' else ' city ' || cast(c_nationkey as string) end as geolocation_city,
 case when c_custkey % 73 = 5 then '77' else lower(substr('ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSRORRSCSPSETO', c_nationkey*2+1, 2)) end as geolocation_state from customer
""",
    "fx_order_items": r"""
select md5('o' || cast(l_orderkey as string)) as order_id, cast(l_linenumber - case when l_orderkey % 107 = 5 then 3 else 0 end as string) as order_item_id,
 md5('p' || cast(l_partkey as string)) as product_id, case when l_orderkey % 109 = 5 then '  ' else md5('s' || cast(l_suppkey as string)) end as seller_id,
 cast(l_shipdate as string) as shipping_limit_date,
 cast(cast(case when l_orderkey % 101 = 5 then -l_extendedprice else l_extendedprice end as decimal(12,2)) as string) as price,
 cast(cast(case when l_orderkey % 103 = 5 then -l_quantity else l_quantity end as decimal(12,2)) as string) as freight_value from lineitem
""",
    "fx_order_payments": r"""
select md5('o' || cast(o_orderkey as string)) as order_id, cast(case when o_orderkey % 113 = 5 then 0 else 1 end as string) as payment_sequential,
 case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then ' boleto' when '3-MEDIUM' then 'voucher ' when '4-NOT SPECIFIED' then (case when o_orderkey % 13 = 5 then 'not_defined' else 'debit_card' end) else (case when o_orderkey % 127 = 5 then ' ' else 'Credit_Card' end) end as payment_type,
 cast(o_orderkey % 11 - case when o_orderkey % 131 = 5 then 20 else 0 end as string) as payment_installments,
 cast(cast(case when o_orderkey % 103 = 5 then -o_totalprice else o_totalprice end as decimal(12,2)) as string) as payment_value from orders
""",
    "fx_order_reviews": r"""
select case when o_orderkey % 53 = 5 then ' ' else md5('r' || cast(o_orderkey as string)) end as review_id, md5('o' || cast(o_orderkey as string)) as order_id,
 case when o_orderkey % 61 = 5 then 'bad' when o_orderkey % 59 = 5 then '9' else cast(1 + o_orderkey % 5 as string) end as review_score,
 case when o_orderkey % 3 = 0 then null else 'title ' || cast(o_orderkey % 7 as string) end as review_comment_title, d.text as review_comment_message,
 case when o_orderkey % 71 = 5 then 'not a date' else cast(o_orderdate + interval 10 days as string) end as review_creation_date,
 cast(o_orderdate + interval 12 days as string) as review_answer_timestamp
 from orders left join documents d on d.doc_id = o_orderkey
""",
    "fx_orders": r"""
select case when o_orderkey % 139 = 5 then '  ' else md5('o' || cast(o_orderkey as string)) end as order_id, md5('c' || cast(o_custkey as string)) as customer_id,
 case when o_orderkey % 137 = 5 then ' ' when o_orderstatus = 'F' then ' delivered' when o_orderstatus = 'O' then 'shipped' else 'processing' end as order_status,
 case when o_orderkey % 149 = 5 then null else cast(o_orderdate as string) end as order_purchase_timestamp,
 case when o_orderkey % 67 = 5 then null else cast(o_orderdate + interval 1 day as string) end as order_approved_at,
 case when o_orderstatus = 'F' then cast(o_orderdate + interval 3 days as string) end as order_delivered_carrier_date,
 case when o_orderstatus = 'F' and o_orderkey % 73 <> 5 then (case when o_orderkey % 71 = 5 then cast(o_orderdate - interval 1 day as string) else cast(o_orderdate + interval 7 days as string) end) end as order_delivered_customer_date,
 cast(o_orderdate + interval 20 days as string) as order_estimated_delivery_date from orders
""",
    "fx_products": r"""
select case when p_partkey % 53 = 5 then cast(p_partkey as string) else md5('p' || cast(p_partkey as string)) end as product_id,
 case when p_partkey % 37 = 5 then null else lower(p_type) || '_casa' end as product_category_name,
 case when p_partkey % 37 = 5 then null else cast(length(p_name) as string) end as product_name_lenght, case when p_partkey % 37 = 5 then null else cast(p_size * 10 as string) end as product_description_lenght,
 cast(case when p_partkey % 59 = 5 then -1 else p_partkey % 6 end as string) as product_photos_qty,
 case when p_partkey % 43 = 5 then null when p_partkey % 41 = 5 then '0' else cast(p_size * 25 as string) end as product_weight_g,
 case when p_partkey % 47 = 5 then null else cast(p_size as string) end as product_length_cm, cast(p_partkey % 61 as string) as product_height_cm, cast(p_size + 1 as string) as product_width_cm from part
""",
    "fx_sellers": r"""
select case when s_suppkey % 29 = 5 then 'abc' else md5('s' || cast(s_suppkey as string)) end as seller_id,
 cast(case when s_suppkey % 23 = 5 then -5 else 2000 + s_suppkey end as string) as seller_zip_code_prefix,
 case when s_suppkey % 19 = 5 then '04482255' when s_suppkey % 3 = 0 then 'são  paulo' when s_suppkey % 3 = 1 then 'brasília' else 'rio de   janeiro' end as seller_city,
 case when s_suppkey % 17 = 5 then 'xx' else lower(substr('ACALAPAMBACEDFESGOMAMTMSMGPAPBPRPEPIRJRNRSRORRSCSPSETO', s_nationkey*2+1, 2)) || ' ' end as seller_state from supplier
""",
    "fx_category_name_translation": r"""
select distinct lower(p_type) || '_casa' as product_category_name, lower(p_type) || '_home' as product_category_name_english from part where p_type <> 'PROMO'
 union all select 'ab', 'cd' union all select '123', 'numbers'
""",
    "fx_stream_orders": r"""
select case when o_orderkey % 41 = 5 then 'not json' else '{"order_id":"' || md5('o' || cast(o_orderkey - o_orderkey % 2 * (case when o_orderkey % 10 = 1 then 1 else 0 end) as string)) || '",' || case when o_orderkey % 43 = 5 then '"customer_id":null' else '"customer_id":"' || md5('c' || cast(o_custkey as string)) || '"' end || ',"order_status":" Delivered ","order_purchase_timestamp":"' || case when o_orderkey % 47 = 5 then 'NaT' else cast(o_orderdate as string) end || '","extra":1}' end as Body from orders
""",
    "fx_stream_items": r"""
select '{"order_id":"' || md5('o' || cast(l_orderkey as string)) || '","order_item_id":' || cast(l_linenumber as string) || ',"price":' || cast(cast(case when l_orderkey % 41 = 5 then -l_extendedprice else l_extendedprice end as decimal(12,2)) as string) || ',"freight_value":' || case when l_orderkey % 43 = 5 then 'null' else cast(cast(l_quantity as decimal(12,2)) as string) end || '}' as Body from lineitem
""",
    "fx_stream_payments": r"""
select '{"order_id":"' || md5('o' || cast(o_orderkey as string)) || '","payment_type":"' || case o_orderpriority when '1-URGENT' then 'CC' when '2-HIGH' then ' Credit Card' when '3-MEDIUM' then 'creditcard' else 'boleto' end || '","payment_installments":' || cast(o_orderkey % 11 - case when o_orderkey % 41 = 5 then 20 else 0 end as string) || ',"payment_value":' || cast(cast(case when o_orderkey % 43 = 5 then -o_totalprice else o_totalprice end as decimal(12,2)) as string) || '}' as Body from orders
""",
}

# Given tables each text reads.
BASE: dict[str, tuple[str, ...]] = {
    "fx_customers": ("customer",),
    "fx_geolocation": ("customer",),
    "fx_order_items": ("lineitem",),
    "fx_order_payments": ("orders",),
    "fx_order_reviews": ("orders", "documents"),
    "fx_orders": ("orders",),
    "fx_products": ("part",),
    "fx_sellers": ("supplier",),
    "fx_category_name_translation": ("part",),
    "fx_stream_orders": ("orders",),
    "fx_stream_items": ("lineitem",),
    "fx_stream_payments": ("orders",),
}

# Raw entity -> text that plays it.
ENTITY = {
    "customers": "fx_customers",
    "geolocation": "fx_geolocation",
    "order_items": "fx_order_items",
    "order_payments": "fx_order_payments",
    "order_reviews": "fx_order_reviews",
    "orders": "fx_orders",
    "products": "fx_products",
    "sellers": "fx_sellers",
    "category_translation": "fx_category_name_translation",
}

EVENTS = {"orders": "fx_stream_orders", "items": "fx_stream_items", "payments": "fx_stream_payments"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table over the parquet files of ``sf_dir``."""
    for table in BASE[name]:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(SQL[name])


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return view(spark, sf_dir, ENTITY[entity])


def bodies(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return view(spark, sf_dir, EVENTS[table])

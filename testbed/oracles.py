"""The registered queries' results stated in DuckDB SQL, independently of the Spark code.

A statement is a final SELECT plus the common table expressions it names, found by name and put in
front in order of definition.
"""

from __future__ import annotations

import re

from orderloom.schemas import RAW_COLUMNS
from testbed.fixtures import ENTITY, EVENTS, SQL

AS_OF = "TIMESTAMP '2024-01-05 12:00:00'"
# Accepted states, letters and what they become without accents.
STATES = (
    "('AC','AL','AP','AM','BA','CE','DF','ES','GO','MA','MT','MS','MG','PA','PB','PR','PE','PI',"
    "'RJ','RN','RS','RO','RR','SC','SP','SE','TO')"
)
TITLE_CASE = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
NO_ACCENTS = "translate({0}, 'áàãâäéèêëíìîïóòõôöúùûüç', 'aaaaaeeeeiiiiooooouuuuc')"

CTES: dict[str, str] = dict(SQL)


def cte(name: str, body: str) -> None:
    CTES[name] = body


def statement(final: str) -> str:
    """``final`` with every common table expression it needs, directly or through another."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        for word in set(re.findall(r"\w+", pending.pop())):
            if word in CTES and word not in needed:
                needed.add(word)
                pending.append(CTES[word])
    # Tables of the same name as a common table expression do not occur: fx_, t_, s_, r_, j_ are prefixes.
    definitions = [f"{name} as (\n{body}\n)" for name, body in CTES.items() if name in needed]
    return f"with {', '.join(definitions)}\n{final}" if definitions else final


# --- typed tables: casts and text repair -----------------------------------------------------------

cte("t_customers", """select customer_id, customer_unique_id, cast(customer_zip_code_prefix as integer) as customer_zip_code_prefix,
 customer_city, customer_state from fx_customers""")
cte("t_geolocation", """select cast(geolocation_zip_code_prefix as integer) as geolocation_zip_code_prefix,
 cast(geolocation_lat as double) as geolocation_lat, cast(geolocation_lng as double) as geolocation_lng,
 geolocation_city, geolocation_state from fx_geolocation""")
cte("t_order_items", """select order_id, cast(order_item_id as integer) as order_item_id, product_id, seller_id,
 cast(shipping_limit_date as timestamp) as shipping_limit_date, cast(price as double) as price,
 cast(freight_value as double) as freight_value from fx_order_items""")
cte("t_order_payments", """select order_id, cast(payment_sequential as integer) as payment_sequential, payment_type,
 cast(payment_installments as integer) as payment_installments, cast(payment_value as double) as payment_value
 from fx_order_payments""")
cte("t_order_reviews", r"""select review_id, order_id, try_cast(review_score as double) as review_score,
 regexp_replace(review_comment_title, '[\r\n]', ' ', 'g') as review_comment_title,
 regexp_replace(review_comment_message, '[\r\n]', ' ', 'g') as review_comment_message,
 try_cast(review_creation_date as timestamp) as review_creation_date,
 try_cast(review_answer_timestamp as timestamp) as review_answer_timestamp from fx_order_reviews""")
cte("t_orders", """select order_id, customer_id, order_status,
 cast(order_purchase_timestamp as timestamp) as order_purchase_timestamp,
 cast(order_approved_at as timestamp) as order_approved_at,
 cast(order_delivered_carrier_date as timestamp) as order_delivered_carrier_date,
 cast(order_delivered_customer_date as timestamp) as order_delivered_customer_date,
 cast(order_estimated_delivery_date as timestamp) as order_estimated_delivery_date from fx_orders""")
cte("t_products", """select product_id, product_category_name, cast(product_name_lenght as integer) as product_name_lenght,
 cast(product_description_lenght as integer) as product_description_lenght,
 cast(product_photos_qty as integer) as product_photos_qty, cast(product_weight_g as integer) as product_weight_g,
 cast(product_length_cm as integer) as product_length_cm, cast(product_height_cm as integer) as product_height_cm,
 cast(product_width_cm as integer) as product_width_cm from fx_products""")
cte("t_sellers", """select seller_id, cast(seller_zip_code_prefix as integer) as seller_zip_code_prefix, seller_city,
 seller_state from fx_sellers""")
cte("t_category_translation", """select product_category_name, product_category_name_english
 from fx_category_name_translation""")

# --- deduplicated, NULL policy applied, standardised ------------------------------------------------

cte("s_customers", """select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
 upper(trim(customer_state)) as customer_state from (select distinct * from t_customers)
 where customer_id is not null and customer_unique_id is not null and customer_zip_code_prefix is not null
 and customer_city is not null and customer_state is not null""")
cte("s_geolocation", """select geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
 trim(geolocation_city) as geolocation_city, upper(trim(geolocation_state)) as geolocation_state
 from (select distinct * from t_geolocation) where geolocation_zip_code_prefix is not null
 and geolocation_lat is not null and geolocation_lng is not null and geolocation_city is not null
 and geolocation_state is not null""")
cte("s_order_items", """select distinct * from t_order_items where order_id is not null and order_item_id is not null
 and product_id is not null and seller_id is not null and shipping_limit_date is not null and price is not null
 and freight_value is not null""")
cte("s_order_payments", """select order_id, payment_sequential, upper(trim(payment_type)) as payment_type,
 payment_installments, payment_value from (select distinct * from t_order_payments)
 where order_id is not null and payment_sequential is not null and payment_type is not null
 and payment_installments is not null and payment_value is not null""")
cte("s_order_reviews", """select review_id, order_id, review_score,
 coalesce(review_comment_title, 'No Title') as review_comment_title,
 coalesce(review_comment_message, 'No Comment') as review_comment_message, review_creation_date,
 review_answer_timestamp from (select distinct * from t_order_reviews)
 where review_id is not null and order_id is not null and review_score is not null""")
cte("s_orders", """select order_id, customer_id, upper(trim(order_status)) as order_status, order_purchase_timestamp,
 order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
 from (select distinct * from t_orders)
 where order_id is not null and customer_id is not null and order_status is not null""")
cte("s_products", """select product_id,
 lower(replace(trim(coalesce(product_category_name, 'Unknown')), '_', ' ')) as product_category_name,
 coalesce(product_name_lenght, 0) as product_name_lenght,
 coalesce(product_description_lenght, 0) as product_description_lenght,
 coalesce(product_photos_qty, 0) as product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
 product_width_cm from (select distinct * from t_products)""")
cte("s_sellers", f"""select seller_id, seller_zip_code_prefix,
 {TITLE_CASE.format("regexp_replace(" + NO_ACCENTS.format("seller_city") + r", '\s+', ' ', 'g')")} as seller_city,
 upper(trim(seller_state)) as seller_state from (select distinct * from t_sellers)
 where seller_id is not null and seller_zip_code_prefix is not null and seller_city is not null
 and seller_state is not null""")
cte("s_category_translation", """select lower(replace(trim(product_category_name), '_', ' ')) as product_category_name,
 lower(replace(trim(product_category_name_english), '_', ' ')) as product_category_name_english
 from (select distinct * from t_category_translation)
 where product_category_name is not null and product_category_name_english is not null""")

# --- after discards and imputation -------------------------------------------------------------------

cte("mean_weights", """select product_category_name, round(avg(product_weight_g)) as mean_weight from s_products
 where product_weight_g > 0 group by product_category_name""")
for _table in ENTITY:
    cte(f"r_{_table}", f"select * from s_{_table}")
cte("r_order_payments", "select * from s_order_payments where payment_type <> 'NOT_DEFINED'")
cte("r_products", """select p.product_category_name, p.product_id, p.product_name_lenght, p.product_description_lenght,
 p.product_photos_qty,
 case when p.product_weight_g is null or p.product_weight_g <= 0 then m.mean_weight
 else cast(p.product_weight_g as double) end as product_weight_g,
 p.product_length_cm, p.product_height_cm, p.product_width_cm
 from s_products p left join mean_weights m on p.product_category_name = m.product_category_name""")
cte("r_sellers", f"select * from s_sellers where seller_state in {STATES}")


# --- rules -------------------------------------------------------------------------------------------


def missing(label: str, column: str) -> list[tuple[str, str]]:
    return [(f"{label} is NULL", f"{column} is null"), (f"{label} is Empty", f"trim({column}) = ''")]


def named(label: str, column: str) -> list[tuple[str, str]]:
    digits = f"regexp_matches({column}, '^[0-9]+$')"
    return [*missing(label, column), (f"{label} contains only numbers", digits)]


RULES: dict[str, list[tuple[str, str]]] = {
    "customers": [
        ("Negative ZIP Code", "customer_zip_code_prefix < 0"),
        *named("Customer ID", "customer_id"),
        *named("Customer Unique ID", "customer_unique_id"),
        *named("Customer City", "customer_city"),
        *named("Customer State", "customer_state"),
    ],
    "geolocation": [
        ("Negative ZIP Code", "geolocation_zip_code_prefix < 0"),
        *named("Geolocation City", "geolocation_city"),
        *named("Geolocation State", "geolocation_state"),
        ("Latitude is out of valid bounds [-90, 90]", "geolocation_lat < -90 or geolocation_lat > 90"),
        ("Longitude is out of valid bounds [-180, 180]", "geolocation_lng < -180 or geolocation_lng > 180"),
    ],
    "order_items": [
        ("Order Item ID is 0 or negative", "order_item_id <= 0"),
        ("Negative Price", "price < 0"),
        ("Negative Freight Value", "freight_value < 0"),
        *missing("Order ID", "order_id"),
        *missing("Product ID", "product_id"),
        *missing("Seller ID", "seller_id"),
    ],
    "order_payments": [
        ("Payment Sequential is less than 1", "payment_sequential < 1"),
        ("Negative Payment Installments", "payment_installments < 0"),
        ("Negative Payment Value", "payment_value < 0"),
        *missing("Order ID", "order_id"),
        *missing("Payment Type", "payment_type"),
        ("Payment Type is Empty", "trim(payment_type) = ''"),
        (
            "Illogical Payment: Credit Card with 0 Installments",
            "payment_type = 'CREDIT_CARD' and payment_installments = 0",
        ),
    ],
    "order_reviews": [
        ("Review Score out of bounds (must be 1-5)", "review_score < 1 or review_score > 5"),
        *missing("Review ID", "review_id"),
        *missing("Order ID", "order_id"),
    ],
    "orders": [
        *missing("Order ID", "order_id"),
        *missing("Customer ID", "customer_id"),
        *missing("Order Status", "order_status"),
        (
            "Temporal Anomaly: Delivered before Purchase Date",
            "order_delivered_customer_date < order_purchase_timestamp",
        ),
        (
            "Ghost Delivery: Status is Delivered but missing delivery date",
            "order_status = 'DELIVERED' and order_delivered_customer_date is null",
        ),
        (
            "Unapproved Delivery: Status is Delivered but missing payment approval date",
            "order_status = 'DELIVERED' and order_approved_at is null",
        ),
    ],
    "products": [
        *named("Product ID", "product_id"),
        ("Product Category is NULL or Empty", "product_category_name is null or trim(product_category_name) = ''"),
        ("Zero or Negative Product Weight", "product_weight_g <= 0"),
        ("Zero or Negative Product Length", "product_length_cm <= 0"),
        ("Zero or Negative Product Height", "product_height_cm <= 0"),
        ("Zero or Negative Product Width", "product_width_cm <= 0"),
        (
            "Negative Metadata lengths/qty",
            "product_name_lenght < 0 or product_description_lenght < 0 or product_photos_qty < 0",
        ),
    ],
    "sellers": [
        ("Negative ZIP Code", "seller_zip_code_prefix < 0"),
        *missing("Seller ID", "seller_id"),
        ("Seller ID is not a valid 32-char hex string", "not regexp_matches(seller_id, '^[a-fA-F0-9]{32}$')"),
        *named("Seller City", "seller_city"),
        *missing("Seller State", "seller_state"),
        ("Seller State is not exactly 2 uppercase letters", "not regexp_matches(seller_state, '^[A-Z]{2}$')"),
    ],
    "category_translation": [
        *named("PT Category Name", "product_category_name"),
        ("PT Category Name is too short (junk data)", "length(product_category_name) < 3"),
        *named("EN Category Name", "product_category_name_english"),
        ("EN Category Name is too short (junk data)", "length(product_category_name_english) < 3"),
    ],
}

KEEP: dict[str, str] = {
    "customers": """customer_zip_code_prefix >= 0 and trim(customer_state) <> ''
 and trim(customer_id) <> '' and not regexp_matches(customer_id, '^[0-9]+$')
 and trim(customer_unique_id) <> '' and not regexp_matches(customer_unique_id, '^[0-9]+$')
 and trim(customer_city) <> '' and not regexp_matches(customer_city, '^[0-9]+$')""",
    "geolocation": """geolocation_zip_code_prefix >= 0 and trim(geolocation_state) <> ''
 and trim(geolocation_city) <> '' and not regexp_matches(geolocation_city, '^[0-9]+$')
 and geolocation_lat >= -90 and geolocation_lat <= 90 and geolocation_lng >= -180 and geolocation_lng <= 180""",
    "order_items": """order_item_id > 0 and price >= 0 and freight_value >= 0 and trim(order_id) <> ''
 and trim(product_id) <> '' and trim(seller_id) <> ''""",
    "order_payments": """payment_sequential >= 1 and payment_installments >= 0 and payment_value >= 0
 and trim(order_id) <> '' and trim(payment_type) <> ''
 and not (payment_type = 'CREDIT_CARD' and payment_installments = 0)""",
    "order_reviews": "review_score >= 1 and review_score <= 5 and trim(review_id) <> '' and trim(order_id) <> ''",
    "orders": """trim(order_id) <> '' and trim(customer_id) <> '' and trim(order_status) <> ''
 and (order_delivered_customer_date is null or order_delivered_customer_date >= order_purchase_timestamp)
 and not (order_status = 'DELIVERED' and order_delivered_customer_date is null)
 and not (order_status = 'DELIVERED' and order_approved_at is null)""",
    "products": """trim(product_id) <> '' and not regexp_matches(product_id, '^[0-9]+$')
 and trim(product_category_name) <> '' and product_weight_g > 0 and product_length_cm > 0
 and product_height_cm > 0 and product_width_cm > 0 and product_name_lenght >= 0
 and product_description_lenght >= 0 and product_photos_qty >= 0""",
    "sellers": """seller_zip_code_prefix >= 0 and regexp_matches(seller_state, '^[A-Z]{2}$')
 and regexp_matches(seller_id, '^[a-fA-F0-9]{32}$')
 and trim(seller_city) <> '' and not regexp_matches(seller_city, '^[0-9]+$')""",
    "category_translation": """trim(product_category_name) <> ''
 and not regexp_matches(product_category_name, '^[0-9]+$') and length(product_category_name) >= 3
 and trim(product_category_name_english) <> ''
 and not regexp_matches(product_category_name_english, '^[0-9]+$')
 and length(product_category_name_english) >= 3""",
}

PROBES: dict[str, list[tuple[str, str]]] = {
    "customers": [
        ("customer_zip_code_prefix negative", "customer_zip_code_prefix < 0"),
        ("customer_state missing", "customer_state is null or trim(customer_state) = ''"),
        ("customer_id numeric", "regexp_matches(customer_id, '^[0-9]+$')"),
        ("customer_unique_id numeric", "regexp_matches(customer_unique_id, '^[0-9]+$')"),
        ("customer_city numeric", "regexp_matches(customer_city, '^[0-9]+$')"),
    ],
    "geolocation": [
        ("geolocation_zip_code_prefix zero or negative", "geolocation_zip_code_prefix <= 0"),
        ("geolocation_lat out of bounds", "abs(geolocation_lat) > 90"),
        ("geolocation_lng out of bounds", "abs(geolocation_lng) > 180"),
        ("geolocation_city or state empty", "geolocation_city = '' or geolocation_state = ''"),
    ],
    "order_items": [
        ("order_item_id zero or negative", "order_item_id <= 0"),
        ("price negative", "price < 0"),
        ("freight_value negative", "freight_value < 0"),
        ("order_id missing", "order_id is null or trim(order_id) = ''"),
        ("product_id missing", "product_id is null or trim(product_id) = ''"),
        ("seller_id missing", "seller_id is null or trim(seller_id) = ''"),
    ],
    "order_payments": [
        ("payment_sequential below 1", "payment_sequential < 1"),
        ("payment_installments negative", "payment_installments < 0"),
        ("payment_value negative", "payment_value < 0"),
        ("order_id missing", "order_id is null or trim(order_id) = ''"),
        ("payment_type missing", "payment_type is null or trim(payment_type) = ''"),
    ],
    "order_reviews": [
        ("review_score out of bounds", "review_score < 1 or review_score > 5"),
        ("review_id missing", "review_id is null or trim(review_id) = ''"),
        ("order_id missing", "order_id is null or trim(order_id) = ''"),
    ],
    "orders": [
        ("order_id missing", "order_id is null or trim(order_id) = ''"),
        ("customer_id missing", "customer_id is null or trim(customer_id) = ''"),
        ("delivered before purchase", "order_delivered_customer_date < order_purchase_timestamp"),
    ],
    "products": [
        ("product_weight_g zero or negative", "product_weight_g <= 0"),
        ("product_length_cm zero or negative", "product_length_cm <= 0"),
        ("product_height_cm zero or negative", "product_height_cm <= 0"),
        ("product_width_cm zero or negative", "product_width_cm <= 0"),
        ("product_id numeric", "regexp_matches(product_id, '^[0-9]+$')"),
        (
            "metadata negative",
            "product_name_lenght < 0 or product_description_lenght < 0 or product_photos_qty < 0",
        ),
    ],
    "sellers": [
        ("seller_zip_code_prefix negative", "seller_zip_code_prefix < 0"),
        ("seller_state not a code", "seller_state is null or not regexp_matches(seller_state, '^[A-Z]{2}$')"),
        ("seller_id not hex", "seller_id is null or not regexp_matches(seller_id, '^[a-fA-F0-9]{32}$')"),
        ("seller_city numeric", "regexp_matches(seller_city, '^[0-9]+$')"),
    ],
    "category_translation": [
        (
            f"{c} unusable",
            f"{c} is null or trim({c}) = '' or regexp_matches({c}, '^[0-9]+$') or length({c}) < 3",
        )
        for c in ("product_category_name", "product_category_name_english")
    ],
}


def reason_text(rules: list[tuple[str, str]]) -> str:
    cases = ",\n ".join(f"case when {predicate} then '{reason}' end" for reason, predicate in rules)
    return f"concat_ws(' | ', {cases})"


def counts_per_rule(rules: list[tuple[str, str]], source: str) -> str:
    return "\nunion all ".join(
        f"select '{reason}' as rule, count(*) filter (where {predicate}) as violating_rows from {source}"
        for reason, predicate in rules
    )


for _table in ENTITY:
    cte(
        f"j_{_table}",
        f"select *, {reason_text(RULES[_table])} as error_reason, coalesce({KEEP[_table]}, false) as kept"
        f" from r_{_table}",
    )
    cte(f"v_{_table}", f"select * exclude (error_reason, kept) from j_{_table} where kept")
    _stamp = "" if _table == "orders" else f", {AS_OF} as quarantine_timestamp, '{_table}' as source_table"
    cte(f"q_{_table}", f"select * exclude (kept){_stamp} from j_{_table} where error_reason <> ''")

# --- gold ----------------------------------------------------------------------------------------------

cte("g_dim_customers", "select customer_id, customer_unique_id, customer_city, customer_state from v_customers")
cte("g_dim_products", """select p.product_id, p.product_category_name, c.product_category_name_english,
 p.product_name_lenght, p.product_description_lenght, p.product_photos_qty, p.product_weight_g, p.product_length_cm,
 p.product_height_cm, p.product_width_cm
 from v_products p left join v_category_translation c on c.product_category_name = p.product_category_name""")
cte("g_dim_sellers", "select seller_id, seller_zip_code_prefix, seller_city, seller_state from v_sellers")
cte("g_dim_orders", "select * from v_orders")
cte("g_dim_date", """select distinct cast(strftime(order_purchase_timestamp, '%Y%m%d') as integer) as date_key,
 cast(order_purchase_timestamp as date) as full_date, cast(year(order_purchase_timestamp) as integer) as "year",
 cast(quarter(order_purchase_timestamp) as integer) as "quarter",
 cast(month(order_purchase_timestamp) as integer) as "month", monthname(order_purchase_timestamp) as month_name,
 cast(weekofyear(order_purchase_timestamp) as integer) as week, cast(day(order_purchase_timestamp) as integer) as "day",
 dayname(order_purchase_timestamp) as day_name, dayofweek(order_purchase_timestamp) in (0, 6) as is_weekend
 from v_orders where order_purchase_timestamp is not null""")
cte("g_fact_orders", """select i.order_item_id, i.order_id, o.customer_id, i.product_id, i.seller_id,
 cast(strftime(o.order_purchase_timestamp, '%Y%m%d') as integer) as date_key, i.price, i.freight_value
 from v_order_items i join v_orders o on i.order_id = o.order_id""")
cte("g_fact_payments", """select p.order_id, p.payment_sequential,
 cast(strftime(o.order_purchase_timestamp, '%Y%m%d') as integer) as date_key, p.payment_type, p.payment_installments,
 p.payment_value from v_order_payments p join v_orders o on p.order_id = o.order_id""")
cte("g_fact_reviews", """select review_id, order_id, cast(strftime(review_creation_date, '%Y%m%d') as integer) as date_key,
 review_score, review_creation_date, review_answer_timestamp from v_order_reviews""")

# --- events ----------------------------------------------------------------------------------------------


def _field(name: str, kind: str | None = None) -> str:
    value = f"case when json_valid(Body) then json_extract_string(Body, '$.{name}') end"
    return f"{f'cast({value} as {kind})' if kind else value} as {name}"


cte("p_orders", "select " + ", ".join(
    _field(c) for c in ("order_id", "customer_id", "order_status", "order_purchase_timestamp")
) + " from fx_stream_orders")
cte("p_items", "select " + ", ".join(
    [_field("order_id"), _field("order_item_id", "integer"), _field("price", "double"), _field("freight_value", "double")]
) + " from fx_stream_items")
cte("p_payments", "select " + ", ".join(
    [
        _field("order_id"),
        _field("payment_type"),
        _field("payment_installments", "integer"),
        _field("payment_value", "double"),
    ]
) + " from fx_stream_payments")

cte("d_orders", """select * exclude (n) from (select *, row_number() over (partition by order_id order by
 customer_id nulls last, order_status nulls last, order_purchase_timestamp nulls last) as n from
 (select * replace (try_strptime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') as order_purchase_timestamp)
 from p_orders)) where n = 1""")
cte("d_items", """select * exclude (n) from (select *, row_number() over (partition by order_id, order_item_id order by
 price nulls last, freight_value nulls last) as n from p_items) where n = 1""")
cte("e_orders", """select order_id, customer_id, trim(lower(order_status)) as order_status, order_purchase_timestamp
 from d_orders where order_id is not null and customer_id is not null and order_purchase_timestamp is not null""")
cte("e_items", "select * from d_items where order_id is not null and price >= 0 and freight_value >= 0")
cte("e_payments", """select order_id, case when trim(lower(payment_type)) in ('credit card', 'creditcard', 'cc')
 then 'credit_card' else trim(lower(payment_type)) end as payment_type, payment_installments, payment_value
 from (select distinct * from p_payments) where order_id is not null and payment_value >= 0
 and payment_installments >= 0""")

# --- statements ---------------------------------------------------------------------------------------------

ORACLES: dict[str, str] = {}


def oracle(name: str, final: str) -> None:
    ORACLES[name] = statement(final)


COLUMNS = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "review_id order_id review_score review_comment_title review_comment_message"
    " review_creation_date review_answer_timestamp",
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at"
    " order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "products": "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty"
    " product_weight_g product_length_cm product_height_cm product_width_cm",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "category_translation": "product_category_name product_category_name_english",
}
PADDED = {
    "customers": "customer_id customer_unique_id customer_city customer_state",
    "geolocation": "geolocation_city geolocation_state",
    "order_items": "order_id product_id seller_id",
    "order_payments": "order_id payment_type",
    "order_reviews": "review_id order_id",
    "orders": "order_id customer_id order_status",
    "products": "product_id product_category_name",
    "sellers": "seller_id seller_city seller_state",
    "category_translation": "product_category_name product_category_name_english",
}

for _table, _view in ENTITY.items():
    oracle(f"silver_{_table}", f"select * from v_{_table}")
    oracle(f"quarantine_{_table}", f"select * from q_{_table}")
    oracle(
        f"dq_reconcile_{_table}",
        "select count(*) filter (where kept) as kept_rows, count(*) filter (where error_reason <> '') as rejected_rows,"
        " count(*) filter (where kept and error_reason <> '') as both_rows,"
        f" count(*) filter (where not kept and error_reason = '') as neither_rows from j_{_table}",
    )
    _nulls = ", ".join(f"count(*) - count({c}) as {c}" for c in COLUMNS[_table].split())
    oracle(f"profile_nulls_{_table}", f"select {_nulls} from (select distinct * from t_{_table})")
    oracle(
        f"profile_duplicates_{_table}",
        f"select (select count(*) from t_{_table}) - (select count(*) from (select distinct * from t_{_table}))"
        " as duplicate_rows",
    )
    _padded = " or ".join(f"{c} <> trim({c})" for c in PADDED[_table].split())
    oracle(f"profile_untrimmed_{_table}", f"select * from {_view} where {_padded}")
    oracle(f"profile_violations_{_table}", counts_per_rule(RULES[_table], f"r_{_table}"))
    oracle(f"profile_probes_{_table}", counts_per_rule(PROBES[_table], f"s_{_table}"))

for _table in (
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "dim_orders",
    "dim_date",
    "fact_orders",
    "fact_payments",
    "fact_reviews",
):
    oracle(_table, f"select * from g_{_table}")

for _table, _column in (
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
):
    oracle(f"profile_distinct_{_table}_{_column}", f"select distinct {_column} from s_{_table}")


# --- reports ---------------------------------------------------------------------------------------------------


def amount(column: str) -> str:
    return f"cast(sum(cast(cast({column} as varchar) as decimal(38,15))) as double)"


def amount2(column: str) -> str:
    return f"cast(round(sum(cast(cast({column} as varchar) as decimal(38,15))), 2) as double)"


def mean2(column: str) -> str:
    exact = f"cast(sum(cast(cast({column} as varchar) as decimal(38,15))) as decimal(38,12)) / count({column})"
    return f"cast(round(cast({exact} as decimal(28,10)), 2) as double)"


ORDERS_BY_DAY = "from g_fact_orders f join g_dim_date d on f.date_key = d.date_key"
PAYMENTS_BY_DAY = "from g_fact_payments f join g_dim_date d on f.date_key = d.date_key"
REVIEWS_BY_DAY = "from g_fact_reviews f join g_dim_date d on f.date_key = d.date_key"
BY_MONTH = 'group by d."year", d."month", d.month_name order by d."year", d."month"'

oracle("kpi_total_revenue", f"select {amount('price')} as total_revenue from g_fact_orders")
oracle("kpi_total_freight", f"select {amount('freight_value')} as total_freight from g_fact_orders")
oracle("kpi_items_sold", "select count(*) as total_items_sold from g_fact_orders")
oracle("kpi_average_price", f"select {mean2('price')} as average_price from g_fact_orders")
oracle(
    "kpi_revenue_by_month",
    f'select d."year", d.month_name, {amount("f.price")} as revenue {ORDERS_BY_DAY} {BY_MONTH}',
)
oracle(
    "kpi_revenue_by_state",
    f"select c.customer_state, {amount('f.price')} as revenue from g_fact_orders f"
    " join g_dim_customers c on f.customer_id = c.customer_id group by c.customer_state order by revenue desc",
)
oracle(
    "kpi_top_categories",
    f"select p.product_category_name_english, {amount('f.price')} as revenue from g_fact_orders f"
    " join g_dim_products p on f.product_id = p.product_id group by p.product_category_name_english"
    " order by revenue desc, p.product_category_name_english limit 10",
)
oracle(
    "kpi_top_seller_cities",
    f"select s.seller_city, {amount('f.price')} as revenue from g_fact_orders f"
    " join g_dim_sellers s on f.seller_id = s.seller_id group by s.seller_city"
    " order by revenue desc, s.seller_city limit 10",
)
oracle(
    "kpi_revenue_by_weekday",
    f"select d.day_name, {amount('f.price')} as revenue {ORDERS_BY_DAY} group by d.day_name order by revenue desc",
)
oracle(
    "kpi_revenue_weekend",
    f"select d.is_weekend, {amount('f.price')} as revenue {ORDERS_BY_DAY} group by d.is_weekend",
)
oracle("kpi_payment_total", f"select {amount2('payment_value')} as total_payment_value from g_fact_payments")
oracle(
    "kpi_payment_by_type",
    f"select payment_type, {amount2('payment_value')} as total_revenue from g_fact_payments"
    " group by payment_type order by total_revenue desc",
)
oracle(
    "kpi_payment_by_month",
    f'select d."year", d."month", d.month_name, {amount2("f.payment_value")} as total_revenue'
    f" {PAYMENTS_BY_DAY} {BY_MONTH}",
)
oracle("kpi_payment_average", f"select {mean2('payment_value')} as average_payment from g_fact_payments")
oracle(
    "kpi_installments_average",
    f"select {mean2('payment_installments')} as average_installments from g_fact_payments",
)
oracle(
    "kpi_installment_distribution",
    "select payment_installments, count(*) as total_transactions from g_fact_payments"
    " group by payment_installments order by payment_installments",
)
oracle(
    "kpi_top_payment_methods",
    "select payment_type, count(*) as total_transactions from g_fact_payments"
    " group by payment_type order by total_transactions desc",
)
oracle(
    "kpi_highest_payments",
    "select order_id, payment_type, payment_value from g_fact_payments"
    " order by payment_value desc, order_id, payment_type limit 10",
)
oracle(
    "kpi_payment_share",
    f"select payment_type, {amount2('payment_value')} as revenue from g_fact_payments group by payment_type",
)
oracle(
    "kpi_payment_weekend",
    f"select d.is_weekend, {amount2('f.payment_value')} as total_revenue {PAYMENTS_BY_DAY} group by d.is_weekend",
)
oracle("kpi_review_average", f"select {mean2('review_score')} as average_review_score from g_fact_reviews")
for _name in ("kpi_review_distribution", "kpi_review_score_share"):
    oracle(
        _name,
        "select review_score, count(*) as total_reviews from g_fact_reviews group by review_score order by review_score",
    )
oracle(
    "kpi_reviews_by_month",
    f'select d."year", d."month", d.month_name, count(*) as total_reviews {REVIEWS_BY_DAY} {BY_MONTH}',
)
oracle(
    "kpi_review_average_by_month",
    f'select d."year", d."month", d.month_name, {mean2("f.review_score")} as average_review'
    f" {REVIEWS_BY_DAY} {BY_MONTH}",
)
oracle(
    "kpi_reviews_weekend",
    f"select d.is_weekend, count(*) as total_reviews {REVIEWS_BY_DAY} group by d.is_weekend",
)
oracle(
    "kpi_lowest_reviews",
    "select order_id, review_score from g_fact_reviews order by review_score, order_id limit 10",
)
oracle(
    "kpi_highest_reviews",
    "select order_id, review_score from g_fact_reviews order by review_score desc, order_id limit 10",
)
oracle(
    "kpi_reviews_by_weekday",
    f"select d.day_name, count(*) as total_reviews {REVIEWS_BY_DAY} group by d.day_name order by total_reviews desc",
)
oracle(
    "kpi_review_trend",
    f'select d."year", d.month_name, {mean2("f.review_score")} as average_score, count(*) as total_reviews'
    f" {REVIEWS_BY_DAY} {BY_MONTH}",
)

# --- sources and sinks --------------------------------------------------------------------------------------------

oracle("profile_distinct_orders_raw_status", "select distinct order_status from t_orders")
oracle("profile_distinct_payments_accepted_type", "select distinct payment_type from r_order_payments")
oracle("src1_csv_stream", "select *, cast(null as varchar) as _rescued_data from fx_customers")
oracle("src2_multiline_csv", "select *, cast(null as varchar) as _rescued_data from fx_order_reviews")
oracle(
    "src3_schema_drift",
    "select seller_id, seller_zip_code_prefix, seller_city, seller_state, cast(null as varchar) as seller_group"
    " from fx_sellers union all select customer_id, customer_zip_code_prefix, customer_city, customer_state,"
    " customer_unique_id from fx_customers",
)
oracle("src2_split_csv", "select *, cast(null as varchar) as _rescued_data from fx_order_reviews")
oracle(
    "src3_ingest_drift",
    "select v.*, case when ascii(right(v.seller_id, 1)) % 3 = 2 then 'group ' || f.seller_state end as seller_group"
    " from v_sellers v left join (select distinct seller_id, seller_state from fx_sellers) f on v.seller_id = f.seller_id",
)
oracle(
    "src4_rescued_fields",
    "select review_id, order_id, try_cast(review_score as double) as review_score, review_comment_title, review_comment_message,"
    " try_cast(review_creation_date as timestamp) as review_creation_date, try_cast(review_answer_timestamp as timestamp) as review_answer_timestamp,"
    + ", ".join(f"case when try_cast({c} as {t}) is null then {c} end as lost_{c}" for c, t in (("review_score", "double"), ("review_creation_date", "timestamp"), ("review_answer_timestamp", "timestamp")))
    + ", case when (review_score is not null and try_cast(review_score as double) is null)"
    " or (review_creation_date is not null and try_cast(review_creation_date as timestamp) is null)"
    " or (review_answer_timestamp is not null and try_cast(review_answer_timestamp as timestamp) is null) then true end as lost_in from fx_order_reviews",
)
oracle(
    "src4_rescued_data",
    "select review_id, order_id, try_cast(review_score as double) as review_score,"
    " case when try_cast(review_score as double) is null then review_id || ',' || order_id || ',' || review_score end"
    " as rescued_data from fx_order_reviews",
)
oracle("src5_csv_read", "select * from t_order_items")
oracle("src6_table_by_path", "select * from fx_sellers")
oracle("src7_table_by_name", "select * from fx_sellers")
oracle("src8_sql_over_path", "select * from fx_stream_orders")
oracle("src9_topic_bodies", "select * from fx_stream_orders")
oracle("src10_table_stream", "select * from fx_stream_items")
oracle("snk1_drain_append", "select *, cast(null as varchar) as _rescued_data from fx_geolocation")
oracle("snk2_interval_append", "select * from fx_stream_payments")
oracle("snk3_foreach_batch", "select * from e_items")
oracle(
    "snk4_batch_append",
    "select *, cast(0 as integer) as batch_id from e_payments union all select *, cast(1 as integer) from e_payments",
)
oracle("snk4_new_checkpoint", "select * from e_orders union all select * from e_orders")
oracle("snk5_overwrite", "select * from v_customers")
oracle(
    "snk6_quarantine_append",
    "select *, 'r1' as run_id from q_order_items union all select *, 'r2' from q_order_items",
)
oracle(
    "snk6_run_id_text",
    "select q.*, r.run_id from q_order_items q, (select unnest(['007', '2024-01-05', 'it''s']) as run_id) r",
)
oracle("snk8_quarantine_by_name", "select *, 'r1' as run_id from q_order_items union all select *, 'r2' from q_order_items")
oracle("snk8_gold_after_rerun", "select * from g_fact_orders")
oracle("snk7_replace_table", "select * from g_dim_sellers")
oracle("snk8_register_table", "select *, 'sellers' as table_name from v_sellers")


def json_text(column: str) -> str:
    return f"coalesce('\"' || {column} || '\"', 'null')"


def json_object(pairs: list[tuple[str, str]]) -> str:
    fields = " || ',' || ".join(f"'\"{name}\":' || {value}" for name, value in pairs)
    return f"'{{' || {fields} || '}}'"


PAYMENT_JSON = json_object(
    [
        ("order_id", json_text("order_id")),
        ("payment_sequential", "cast(payment_sequential as varchar)"),
        ("payment_type", json_text("payment_type")),
        ("payment_installments", "cast(payment_installments as varchar)"),
        ("payment_value", "cast(payment_value as varchar)"),
    ]
)
ORDER_JSON = json_object(
    [(c, json_text(c)) for c in ("order_id", "customer_id", "order_status")]
    + [
        (c, json_text(f"strftime({c}, '%Y-%m-%d %H:%M:%S')"))
        for c in (
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        )
    ]
)
ITEM_JSON = json_object([(c, json_text(f"i.{c}")) for c in COLUMNS["order_items"].split()])
SELLER_JSON = json_object([(c, json_text(c)) for c in COLUMNS["sellers"].split()])

oracle("snk9_event_json", f"select {PAYMENT_JSON} as Body from t_order_payments")
oracle(
    "snk10_order_events",
    f"""select 'orders' as topic, order_id as "key", {ORDER_JSON} as Body from t_orders
 union all select 'order_items', i.order_id, {ITEM_JSON} from fx_order_items i join t_orders o on i.order_id = o.order_id
 union all select 'payment', x.order_id, x.Body from (select order_id, {PAYMENT_JSON} as Body from t_order_payments) x
 join t_orders o on x.order_id = o.order_id""",
)

# --- projections and filters ------------------------------------------------------------------------------------------

oracle("prj1_subset", "select order_id, review_id from fx_order_reviews")
oracle("prj2_drop", "select order_id, payment_sequential, payment_installments from fx_order_payments")
oracle("prj3_replace", "select * replace (upper(trim(customer_state)) as customer_state) from t_customers")
oracle("prj4_struct_flatten", "select * from p_payments")
oracle("prj5_cast_rename", "select Body from fx_stream_payments")
oracle(
    "prj6_alias",
    "select p.product_id, c.product_category_name_english as english_name from fx_products p"
    " join fx_category_name_translation c on p.product_category_name = c.product_category_name",
)
oracle("prj7_constant", "select *, 'sellers' as source_table from fx_sellers")
oracle(
    "flt1_ranges",
    "select * from t_geolocation where (geolocation_lat >= -90 and geolocation_lat < 90 and geolocation_lng > -180"
    " and geolocation_lng <= 180 and geolocation_zip_code_prefix <> 1005) or geolocation_zip_code_prefix = -1",
)
oracle(
    "flt2_nulls",
    "select order_id, order_status, order_purchase_timestamp from t_orders"
    " where order_approved_at is null and order_purchase_timestamp is not null",
)
oracle("flt3_blank", "select * from fx_order_items where trim(seller_id) = ''")
oracle(
    "flt4_regex",
    "select * from fx_sellers where not regexp_matches(seller_id, '^[a-fA-F0-9]{32}$')"
    " or regexp_matches(seller_city, '^[0-9]+$') or not regexp_matches(upper(trim(seller_state)), '^[A-Z]{2}$')",
)
oracle(
    "flt5_membership",
    f"select *, upper(trim(seller_state)) in {STATES} as is_known from fx_sellers"
    " where upper(trim(seller_state)) not in ('SP', 'RJ')",
)
oracle(
    "flt6_column_compare",
    "select * from t_orders where order_delivered_customer_date < order_purchase_timestamp"
    " and order_status <> trim(order_status)",
)
oracle(
    "flt7_three_valued",
    "select product_id, product_weight_g > 600 and product_length_cm > 20 as heavy_and_long,"
    " product_weight_g > 600 or product_length_cm > 20 as heavy_or_long, not product_weight_g > 600 as not_heavy"
    " from t_products",
)
oracle(
    "flt8_contains",
    "select review_id, order_id, review_answer_timestamp from fx_order_reviews"
    " where contains(review_answer_timestamp, '1996-07')",
)
oracle("flt9_drop_value", "select * from r_order_payments")
oracle(
    "flt10_status_subset",
    "select order_status, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date from t_orders"
    " where order_status in ('processing', 'canceled', 'unavailable', 'created')",
)

# --- joins ----------------------------------------------------------------------------------------------------------------

oracle(
    "jn1_left_to_group_mean",
    "select p.product_category_name, p.product_id, m.mean_weight as category_mean_weight from s_products p"
    " left join mean_weights m on p.product_category_name = m.product_category_name",
)
oracle(
    "jn2_left_translation",
    "select product_id, product_category_name, product_category_name_english from g_dim_products",
)
oracle(
    "jn3_items_orders",
    "select i.order_id, i.order_item_id, o.customer_id, i.price from v_order_items i join v_orders o"
    " on i.order_id = o.order_id",
)
oracle(
    "jn4_payments_orders",
    "select p.order_id, p.payment_type, o.order_status from v_order_payments p join v_orders o"
    " on p.order_id = o.order_id",
)
oracle("jn5_fact_date", f"select f.order_id, f.date_key, d.day_name, f.payment_value {PAYMENTS_BY_DAY}")
oracle(
    "jn6_fact_dimensions",
    "select f.order_id, f.order_item_id, c.customer_state, p.product_category_name, s.seller_city, f.price"
    " from g_fact_orders f join g_dim_customers c on f.customer_id = c.customer_id"
    " join g_dim_products p on f.product_id = p.product_id join g_dim_sellers s on f.seller_id = s.seller_id",
)

# --- aggregates and sorting ---------------------------------------------------------------------------------------------------

oracle("ag1_row_count", "select count(*) as row_count from fx_order_items")
oracle(
    "ag2_global_sum",
    f"select {amount('price')} as revenue, {amount2('price')} as revenue_rounded from t_order_items",
)
oracle("ag3_global_count", "select count(*) as rows_total from t_order_payments")
oracle("ag4_global_mean", f"select {mean2('freight_value')} as mean_freight from t_order_items")
oracle("ag5_grouped_sum", f"select seller_id, {amount('price')} as revenue from t_order_items group by seller_id")
oracle(
    "ag6_grouped_rounded_sum",
    f"select payment_type, {amount2('payment_value')} as paid from s_order_payments group by payment_type",
)
oracle("ag7_grouped_count", "select order_status, count(*) as order_count from t_orders group by order_status")
oracle(
    "ag8_grouped_mean_count",
    f"select review_comment_title, {mean2('review_score')} as mean_score, count(*) as review_count"
    " from t_order_reviews group by review_comment_title",
)
oracle("ag9_filtered_group_mean", "select product_category_name, mean_weight from mean_weights")
oracle(
    "ag10_null_profile",
    "select " + ", ".join(f"count(*) - count({c}) as {c}" for c in COLUMNS["products"].split()) + " from fx_products",
)
oracle(
    "ag11_duplicate_count",
    "select 2 * (select count(*) from t_order_payments) - (select count(*) from (select distinct * from"
    " t_order_payments)) as duplicate_rows",
)
oracle(
    "ag12_duplicate_keys",
    'select order_id, order_item_id, count(*) as "count" from fx_order_items group by order_id, order_item_id'
    " having count(*) > 1",
)
oracle(
    "ag13_value_counts",
    'select geolocation_zip_code_prefix, count(*) as "count" from t_geolocation group by geolocation_zip_code_prefix',
)
oracle("ag14_distinct_rows", "select distinct * from t_order_items")
oracle(
    "ag15_one_per_key",
    "select * exclude (n) from (select *, row_number() over (partition by order_id, order_item_id order by"
    " product_id nulls last, seller_id nulls last, shipping_limit_date nulls last, price nulls last,"
    " freight_value nulls last) as n from t_order_items) where n = 1",
)
oracle(
    "ag16_distinct_expressions",
    'select distinct cast(year(order_purchase_timestamp) as integer) as "year",'
    ' cast(month(order_purchase_timestamp) as integer) as "month", monthname(order_purchase_timestamp) as month_name'
    " from t_orders",
)
oracle("ag17_distinct_values", "select distinct review_score from fx_order_reviews")
oracle("st1_sort_ascending", "select full_date, date_key, week from g_dim_date order by full_date")
oracle("st2_sort_by_aggregate", 'select customer_state, count(*) as "count" from s_customers group by customer_state')
oracle(
    "st3_sort_by_hidden_column",
    'select "year", month_name, count(*) as days from g_dim_date group by "year", "month", month_name'
    ' order by "year", "month"',
)
oracle(
    "st4_top_k",
    "select order_id, order_item_id, product_id, price from t_order_items"
    " order by price desc, order_id, order_item_id, product_id limit 10",
)
oracle("st5_preview", "select * from v_customers order by customer_id, customer_unique_id limit 10")

# --- scalar functions -------------------------------------------------------------------------------------------------------------


def function(name: str, table: str, key: str, columns: str) -> None:
    oracle(name, f"select {key}, {columns} from {ENTITY[table]}")


PURCHASED = "cast(order_purchase_timestamp as timestamp)"

function("fn_trim", "customers", "customer_id", "trim(customer_state) as result")
function("fn_lower", "order_payments", "order_id", "lower(payment_type) as result")
function("fn_upper", "orders", "order_id", "upper(order_status) as result")
function("fn_initcap", "customers", "customer_id", f"{TITLE_CASE.format('customer_city')} as result")
function("fn_length", "order_reviews", "order_id", "cast(length(review_comment_message) as integer) as result")
function(
    "fn_concat_ws",
    "order_reviews",
    "order_id",
    "concat_ws(' | ', review_comment_title, review_score, review_creation_date) as result",
)
function(
    "fn_regexp_replace_newline",
    "order_reviews",
    "order_id",
    r"regexp_replace(review_comment_message, '[\r\n]', ' ', 'g') as result",
)
function("fn_regexp_replace_underscore", "products", "product_id", "replace(product_category_name, '_', ' ') as result")
function("fn_regexp_replace_spaces", "sellers", "seller_id", r"regexp_replace(seller_city, '\s+', ' ', 'g') as result")
function("fn_translate", "sellers", "seller_id", f"{NO_ACCENTS.format('seller_city')} as result")
function("fn_contains", "products", "product_id", "contains(product_category_name, 'med') as result")
function(
    "fn_rlike",
    "customers",
    "customer_id",
    "regexp_matches(customer_city, '^[0-9]+$') as result, regexp_matches(customer_id, '^[a-fA-F0-9]{32}$') as is_hex",
)
function("fn_isin", "sellers", "seller_id", f"upper(trim(seller_state)) in {STATES} as result")
function("fn_lit", "sellers", "seller_id", "'sellers' as result")
function(
    "fn_when_otherwise",
    "order_payments",
    "order_id",
    "case when payment_type in ('credit_card', 'Credit_Card') then 'card' else payment_type end as result",
)
function(
    "fn_when_null",
    "order_items",
    "order_id",
    "order_item_id, case when cast(price as double) < 0 then 'Negative Price' end as result",
)
function("fn_case_when", "orders", "order_id", "coalesce(order_status = 'shipped', false) as result")
function("fn_binary_to_string", "sellers", "seller_id", "seller_city as result")
oracle(
    "fn_cast",
    "select order_id, order_item_id as item, shipping_limit_date as limit_date, price from t_order_items",
)
oracle("fn_try_cast", "select order_id, review_score as score, review_creation_date as created from t_order_reviews")
function("fn_date_key", "orders", "order_id", f"cast(strftime({PURCHASED}, '%Y%m%d') as integer) as result")
function("fn_date", "orders", "order_id", f"cast({PURCHASED} as date) as result")
for _name, _part in (("year", "year"), ("quarter", "quarter"), ("month", "month"), ("weekofyear", "week"), ("day", "day")):
    function(f"fn_{_name}", "orders", "order_id", f"cast(extract({_part} from {PURCHASED}) as integer) as result")
function("fn_month_name", "orders", "order_id", f"monthname({PURCHASED}) as result")
function("fn_day_name", "orders", "order_id", f"dayname({PURCHASED}) as result")
function("fn_is_weekend", "orders", "order_id", f"coalesce(dayofweek({PURCHASED}) in (0, 6), false) as result")
function("fn_current_timestamp", "sellers", "seller_id", "abs(epoch(current_timestamp) - epoch(get_current_timestamp())) < 3600 as is_stamped")
function(
    "fn_round2",
    "order_items",
    "order_id",
    "order_item_id, cast(round(cast(cast(price as double) / 7 as decimal(18,6)), 2) as double) as result",
)
function(
    "fn_round0",
    "order_items",
    "order_id",
    "order_item_id, cast(round(cast(cast(price as double) as decimal(18,6))) as double) as result",
)
oracle("fn_mean", "select avg(product_weight_g) as mean_weight, avg(product_width_cm) as mean_width from t_products")
oracle(
    "fn_fillna_subset",
    "select order_id, coalesce(review_comment_title, 'No Title') as review_comment_title, review_comment_message"
    " from fx_order_reviews",
)
oracle(
    "fn_fillna_map",
    "select * replace (coalesce(product_category_name, 'Unknown') as product_category_name,"
    " coalesce(product_name_lenght, 0) as product_name_lenght,"
    " coalesce(product_description_lenght, 0) as product_description_lenght,"
    " coalesce(product_photos_qty, 0) as product_photos_qty) from t_products",
)
oracle(
    "fn_dropna_any",
    "select * from fx_customers where customer_id is not null and customer_unique_id is not null"
    " and customer_zip_code_prefix is not null and customer_city is not null and customer_state is not null",
)
oracle(
    "fn_dropna_subset",
    "select * from fx_products where product_category_name is not null and product_weight_g is not null",
)
oracle(
    "fn_try_to_timestamp",
    "select order_id, try_strptime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') as result from p_orders",
)
oracle("fn_from_json", "select * from p_items")
oracle("fn_to_json", f"select {SELLER_JSON} as Body from fx_sellers")

# --- data quality --------------------------------------------------------------------------------------------------------------------

oracle("dq1_cast_contract", "select * from t_order_items")
oracle(
    "dq1_try_cast_contract",
    "select review_id, order_id, try_cast(review_score as double) as review_score, review_comment_title, review_comment_message,"
    " try_cast(review_creation_date as timestamp) as review_creation_date,"
    " try_cast(review_answer_timestamp as timestamp) as review_answer_timestamp from fx_order_reviews",
)
oracle(
    "dq1_unparsable",
    f"select *, {AS_OF} as quarantine_timestamp, 'order_reviews' as source_table from (select *, "
    + reason_text(
        [
            (f"{c} is not a valid {kind}", f"{c} is not null and try_cast({c} as {kind}) is null")
            for c, kind in (
                ("review_score", "double"),
                ("review_creation_date", "timestamp"),
                ("review_answer_timestamp", "timestamp"),
            )
        ]
    )
    + " as error_reason from fx_order_reviews) where error_reason <> ''",
)
oracle("dq2_error_reason", "select * exclude (kept) from j_order_payments")
oracle(
    "dq3_split",
    "select customer_id, 'valid' as side, '' as error_reason from j_customers where kept"
    " union all select customer_id, 'rejected', error_reason from j_customers where error_reason <> ''",
)
oracle(
    "dq3_strict_split",
    "select * exclude (kept) replace (case when error_reason = '' then 'Undecided: a rule could not be evaluated'"
    f" else error_reason end as error_reason), {AS_OF} as quarantine_timestamp, 'products' as source_table"
    " from j_products where not kept",
)
_strict_sellers = RULES["sellers"] + [("Discarded: value outside the accepted list", f"seller_state not in {STATES}")]
oracle(
    "dq3_strict_sellers",
    f"select *, {AS_OF} as quarantine_timestamp, 'sellers' as source_table from"
    f" (select *, {reason_text(_strict_sellers)} as error_reason from s_sellers) where error_reason <> ''",
)
oracle(
    "dq4_quarantine_metadata",
    f"select *, {AS_OF} as quarantine_timestamp, 'geolocation' as source_table from r_geolocation"
    " where geolocation_lat > 90",
)
oracle(
    "dq5_null_policy",
    "select * replace (coalesce(review_comment_title, 'No Title') as review_comment_title,"
    " coalesce(review_comment_message, 'No Comment') as review_comment_message) from t_order_reviews"
    " where review_id is not null and order_id is not null and review_score is not null",
)
oracle("dq6_group_mean", "select * from r_products")
oracle(
    "dq8_standardise",
    "select seller_id, "
    + TITLE_CASE.format("regexp_replace(" + NO_ACCENTS.format("seller_city") + r", '\s+', ' ', 'g')")
    + " as seller_city, upper(trim(seller_state)) as seller_state from fx_sellers",
)
oracle("dq9_hard_drop", "select * from r_sellers")

# --- streaming --------------------------------------------------------------------------------------------------------------------------

oracle("bronze_stream", "select * from fx_stream_items")
oracle("str2_skip_empty", "select *, cast(0 as integer) as batch_id from e_orders")
oracle("str3_json_parse", "select * from p_orders")
for _table in EVENTS:
    oracle(f"stream_silver_{_table}", f"select * from e_{_table}")
_SIDE_BY_SIDE = (
    "select 'orders' as event_table, * from e_orders union all by name select 'items' as event_table, * from e_items"
    " union all by name select 'payments' as event_table, * from e_payments"
)
oracle("str7_dispatch", _SIDE_BY_SIDE)
oracle("str8_start_silver", "select * from e_orders")
oracle("str9_three_queries", _SIDE_BY_SIDE)

# --- options beyond the base pipeline ------------------------------------------------------------------------------------------------------

def quarantined(table: str, order: str, reasons: list[str]) -> str:
    """Rejected rows of a batch with their text: one row a key, and each row without an order id."""
    fields = CTES[f"p_{table}"].split(" from ")[0]
    rows = f"({fields}, Body from fx_stream_{table})"
    if table == "orders":
        rows = f"(select * replace (try_strptime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') as order_purchase_timestamp) from {rows})"
    first = f"select * exclude (n) from (select *, row_number() over ({order}, Body) as n from {rows} where order_id is not null) where n = 1"
    found = ["case when order_id is null and not json_valid(Body) then 'Body is not valid JSON' end", *reasons]
    return f"select * from (select *, concat_ws(' | ', {', '.join(found)}) as error_reason from ({first} union all select * from {rows} where order_id is null)) where error_reason <> ''"


def _absent(column: str) -> str:
    return f"case when {column} is null then '{column} is NULL' end"


def _below(column: str) -> str:
    return f"case when {column} is null or {column} < 0 then '{column} is NULL or negative' end"


_KIND = "case when trim(lower(payment_type)) in ('credit card', 'creditcard', 'cc') then 'credit_card' else trim(lower(payment_type)) end"
_orders = quarantined(
    "orders",
    "partition by order_id order by customer_id nulls last, order_status nulls last, order_purchase_timestamp nulls last",
    [_absent("order_id"), _absent("customer_id"), _absent("order_purchase_timestamp")],
)
X1_ORDERS = f"select * replace (trim(lower(order_status)) as order_status) from ({_orders})"
X1_ITEMS = quarantined(
    "items",
    "partition by order_id, order_item_id order by price nulls last, freight_value nulls last",
    [_absent("order_id"), _below("price"), _below("freight_value")],
)
oracle("x1_stream_quarantine", X1_ORDERS)
oracle("x1_stream_quarantine_items", X1_ITEMS)
_payments = quarantined(
    "payments",
    "partition by order_id, payment_type, payment_installments, payment_value order by order_id",
    [_absent("order_id"), _below("payment_value"), _below("payment_installments")],
)
oracle("x1_stream_quarantine_payments", f"select * replace ({_KIND} as payment_type) from ({_payments})")
oracle(
    "x2_newest_versions",
    "select * replace (case when order_approved_at is null then 'CLOSED' else order_status end as order_status),"
    " cast(case when order_approved_at is null then 1 else 0 end as integer) as batch_id from v_orders",
)
oracle(
    "x2_two_writers",
    "select * replace (case when order_approved_at is null then 'CLOSED' else order_status end as order_status),"
    " case when order_approved_at is null then 'new checkpoint' else 'old checkpoint' end as writer,"
    " cast(case when order_approved_at is null then 0 else 5 end as integer) as batch_id from v_orders",
)
oracle(
    "x3_two_writers",
    "select * from v_orders where order_id < '8'"
    " union all select * replace ('NEW' as order_status) from v_orders where order_id >= '8'",
)
oracle(
    "x7_stream_restart",
    "select * from e_orders union all"
    " select * replace (order_purchase_timestamp + interval 60 days as order_purchase_timestamp) from e_orders",
)
oracle("snk8_stream_by_name", "select * from e_items")
ORACLES["snk8_stream_quarantine_by_name"] = ORACLES["x1_stream_quarantine_items"]
oracle(
    "x3_shared_gold",
    "select * from v_orders union all select order_id, customer_id, upper(trim(order_status)),"
    " order_purchase_timestamp, null, null, null, null from e_orders"
    " where order_id not in (select order_id from v_orders)",
)
oracle(
    "x4_geolocation_by_zip",
    "select geolocation_zip_code_prefix,"
    " cast(cast(avg(geolocation_lat) as decimal(18,10)) as double) as geolocation_lat,"
    " cast(cast(avg(geolocation_lng) as decimal(18,10)) as double) as geolocation_lng,"
    " min(geolocation_city) as geolocation_city, min(geolocation_state) as geolocation_state"
    " from v_geolocation group by geolocation_zip_code_prefix",
)
cte("w_payments", """select distinct order_id, payment_sequential, lower(upper(trim(payment_type))) as payment_type,
 payment_installments, payment_value from t_order_payments where order_id is not null and payment_value >= 0
 and payment_installments >= 0""")
cte("w_shared_payments", """select * from v_order_payments union all
 select order_id, payment_sequential, upper(trim(case when payment_type in ('credit card', 'creditcard', 'cc')
 then 'credit_card' else payment_type end)), payment_installments, payment_value from w_payments w
 where not exists (select 1 from v_order_payments v where v.order_id = w.order_id
 and v.payment_sequential = w.payment_sequential)""")
cte("w_orders", """select * exclude (n) from (select *, row_number() over (partition by order_id order by
 customer_id nulls last, order_status nulls last, order_purchase_timestamp nulls last, order_approved_at nulls last,
 order_delivered_carrier_date nulls last, order_delivered_customer_date nulls last,
 order_estimated_delivery_date nulls last) as n from t_orders) where n = 1 and order_id is not null
 and customer_id is not null and order_purchase_timestamp is not null""")
cte("w_shared_orders", """select order_id, order_purchase_timestamp from v_orders union all
 select order_id, order_purchase_timestamp from w_orders w
 where not exists (select 1 from v_orders v where v.order_id = w.order_id)""")
oracle("x3_shared_payments", "select * from w_shared_payments")
oracle(
    "x3_shared_fact_payments",
    "select p.order_id, p.payment_sequential, cast(strftime(o.order_purchase_timestamp, '%Y%m%d') as integer) as date_key,"
    " p.payment_type, p.payment_installments, p.payment_value from w_shared_payments p join w_shared_orders o"
    " on p.order_id = o.order_id",
)
ORACLES["run_both_fact_payments"] = ORACLES["x3_shared_fact_payments"]
cte("w_items", """select * exclude (n) from (select *, row_number() over (partition by order_id, order_item_id order by
 price nulls last, freight_value nulls last, product_id nulls last, seller_id nulls last, shipping_limit_date nulls last) as n
 from t_order_items) where n = 1 and order_id is not null and price >= 0 and freight_value >= 0""")
cte("w_both_items", """select order_id, order_item_id, product_id, seller_id, price, freight_value from v_order_items where order_id < '8' union all
 select order_id, order_item_id, product_id, seller_id, price, freight_value from w_items w where not exists (select 1 from v_order_items v
 where v.order_id < '8' and v.order_id = w.order_id and v.order_item_id = w.order_item_id)""")
cte("w_both_orders", """select order_id, customer_id, order_purchase_timestamp from v_orders where order_id < '8' union all
 select order_id, customer_id, order_purchase_timestamp from w_orders w where not exists (select 1 from v_orders v
 where v.order_id < '8' and v.order_id = w.order_id)""")
ORACLES["run_both_fact_orders"] = statement(CTES["g_fact_orders"].replace("v_order_items", "w_both_items").replace("v_orders", "w_both_orders"))
_dims = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
oracle(
    "x5_impute_dimensions",
    "select p.product_category_name, p.product_id, p.product_name_lenght, p.product_description_lenght,"
    " p.product_photos_qty, "
    + ", ".join(f"case when p.{c} > 0 then cast(p.{c} as double) else m.{c} end as {c}" for c in _dims)
    + " from s_products p left join (select product_category_name, "
    + ", ".join(f"round(avg({c}) filter (where {c} > 0)) as {c}" for c in _dims)
    + " from s_products group by product_category_name) m on p.product_category_name = m.product_category_name",
)
oracle(
    "x6_reprocess",
    "select distinct abs(geolocation_zip_code_prefix) as geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,"
    " geolocation_city, geolocation_state from q_geolocation where geolocation_lat between -90 and 90"
    " and geolocation_lng between -180 and 180 and not regexp_matches(geolocation_city, '^[0-9]+$')"
    " and trim(geolocation_city) <> '' and trim(geolocation_state) <> ''",
)
oracle(
    "x6_after_next_run",
    "select geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state from v_geolocation union all "
    "select distinct abs(geolocation_zip_code_prefix), geolocation_lat, geolocation_lng,"
    " geolocation_city, geolocation_state from q_geolocation where geolocation_lat between -90 and 90"
    " and geolocation_lng between -180 and 180 and not regexp_matches(geolocation_city, '^[0-9]+$')"
    " and trim(geolocation_city) <> '' and trim(geolocation_state) <> ''",
)
oracle(
    "x6_stream_bodies",
    "select * from e_orders union all select order_id, customer_id, order_status, timestamp '2024-01-01 00:00:00' from"
    f" ({X1_ORDERS}) where order_purchase_timestamp is null and order_id is not null and customer_id is not null",
)
oracle(
    "dq10_write_pass",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count, count(*) * {len(RAW_COLUMNS[t])} - ({' + '.join(f'count({c})' for c in RAW_COLUMNS[t])}) as null_count, 'r1' as run_id from v_{t}"
        f" union all select '{t} rejected', count(*), null, 'r1' from q_{t}"
        for t in ENTITY
    ),
)
oracle(
    "str9_supervised",
    " union all ".join(
        f"select '{t}' as event_table, cast((select count(*) from fx_stream_{t}) as bigint) as rows_in, cast((select count(*) from e_{t}) as bigint) as kept_rows,"
        f" cast((select count(*) from ({x})) as bigint) as rejected_rows"
        for t, x in (("orders", X1_ORDERS), ("items", X1_ITEMS), ("payments", _payments))
    ),
)
oracle(
    "x7_cross_batch_dedupe",
    "select distinct order_id from p_orders where try_strptime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S')"
    " is not null",
)
ORACLES["run_batch_revenue_by_month"] = ORACLES["kpi_revenue_by_month"]
oracle(
    "run_batch_quarantine_counts",
    " union all ".join(f"select '{t}' as table_name, count(*) as rejected_rows from q_{t}" for t in ENTITY),
)

# --- amounts that are small or large beside money: each digit counts, so plain doubles are summed -----------------

for _name, _factor, _places in (("measure_small_amounts", "* 1e-9", 9), ("measure_large_amounts", "* 1e10", -6)):
    oracle(
        _name,
        f"select round(fsum(l_extendedprice {_factor}), {_places}) as total, round(fsum(l_extendedprice {_factor}) / count(l_extendedprice), {_places}) as mean"
        " from lineitem",
    )

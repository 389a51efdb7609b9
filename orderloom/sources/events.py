"""Event topics: reading bodies from a broker or from files, and publishing rows as events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from orderloom.schemas import TOPICS


def kafka_options(servers: str, topic: str, jaas_config: str | None = None, **options: str) -> dict[str, str]:
    """Reader options of one topic; with ``jaas_config`` the connection is SASL/PLAIN over TLS.

    ``maxOffsetsPerTrigger`` and ``minPartitions`` are the usual extras on a large topic.
    """
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if jaas_config:
        chosen |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas_config,
        }
    return chosen | options


def kafka_source(
    spark: SparkSession, servers: str, topic: str, jaas_config: str | None = None, **options: str
) -> DataFrame:
    """Stream a topic as one text column ``Body``. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, jaas_config, **options))
    return body_text(reader.load())


def body_text(messages: DataFrame) -> DataFrame:
    """The binary ``value`` of broker messages as text ``Body``."""
    return messages.selectExpr("CAST(value AS STRING) AS Body")


def body_stream(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Stream a table of event bodies, such as the raw layer of a topic."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if fmt == "delta" else reader.schema("Body string")).load(path)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column, so that it is valid JSON."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def json_body(df: DataFrame, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """All columns of a row as one JSON object; NULL fields are written, not left out."""
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": timestamp_format,
        "timestampNTZFormat": timestamp_format,
    }
    return F.to_json(F.struct(*df.columns), options)


def to_events(df: DataFrame) -> DataFrame:
    """One JSON message per row, in ``Body``."""
    rows = without_nan(df)
    return rows.select(json_body(rows).alias("Body"))


def order_events(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """All messages of the three topics: ``(topic, key, Body)``.

    Items and payments are published with their order, so rows without an order are left out and an
    order that occurs twice publishes its children twice. The order id is the message key: a broker
    keeps the messages of one order together and in sequence, without collecting them into one value
    here, which for an order with very many lines would not fit a task.
    """
    keys = orders.select("order_id")

    def messages(table: str, rows: DataFrame) -> DataFrame:
        finite = without_nan(rows)
        return finite.select(
            F.lit(TOPICS[table]).alias("topic"), F.col("order_id").alias("key"), json_body(finite).alias("Body")
        )

    return (
        messages("orders", orders)
        .unionByName(messages("items", items.join(keys, "order_id").select(*items.columns)))
        .unionByName(messages("payments", payments.join(keys, "order_id").select(*payments.columns)))
    )


def publish(events: DataFrame, servers: str, **options: str) -> None:
    """Send :func:`order_events` to a broker. Needs Spark's Kafka connector on the class path."""
    messages = events.select("topic", "key", F.col("Body").alias("value"))
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save()

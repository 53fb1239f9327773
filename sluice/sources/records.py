"""Record envelopes: the rows every sink operator takes.

``topic, partition, offset, timestamp_ms, key, value, headers,
key_schema_id, value_schema_id`` and, where flushes matter, ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.timestamps import millis_from_ntz

ENVELOPE = (
    "topic",
    "partition",
    "offset",
    "timestamp_ms",
    "key",
    "value",
    "headers",
    "key_schema_id",
    "value_schema_id",
)

# Fixed values of the adapters below: records per flush, days per schema version.
EVENTS_PER_FLUSH = 1000
TURNS_PER_FLUSH = 4
DAYS_PER_SCHEMA = 10


def event_records(events: DataFrame) -> DataFrame:
    """``events`` as records: one topic per event type, four partitions each.

    The event id rises with time and is unique, so it serves as the offset: a
    log whose offsets have gaps. That keeps the adapter a projection.
    """
    user = F.col("user_id")
    return events.select(
        F.col("event_type").alias("topic"),
        F.pmod(user, F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        millis_from_ntz(F.col("ts")).alias("timestamp_ms"),
        F.when(F.pmod(user, F.lit(10)) != 0, user.cast("string")).alias("key"),
        F.col("props").alias("value"),
        F.array(
            F.struct(F.lit("source").alias("key"), F.lit("events").alias("value")),
            F.struct(F.lit("type").alias("key"), F.col("event_type").alias("value")),
        ).alias("headers"),
        F.lit(1).alias("key_schema_id"),
        F.call_function("div", F.dayofmonth("ts"), F.lit(DAYS_PER_SCHEMA))
        .cast("int")
        .alias("value_schema_id"),
        F.call_function("div", F.col("event_id"), F.lit(EVENTS_PER_FLUSH)).alias("batch_id"),
    )


def conversation_records(conversations: DataFrame) -> DataFrame:
    """``conversations`` as keyed records; turns come before conversations."""
    return conversations.select(
        F.col("role").alias("topic"),
        F.pmod("conv_id", F.lit(4)).cast("int").alias("partition"),
        (F.shiftleft(F.col("turn"), 40) + F.col("conv_id")).alias("offset"),
        F.lit(None).cast("bigint").alias("timestamp_ms"),
        F.col("conv_id").cast("string").alias("key"),
        F.col("text").alias("value"),
        F.array().cast("array<struct<key:string,value:string>>").alias("headers"),
        F.lit(1).alias("key_schema_id"),
        F.lit(1).alias("value_schema_id"),
        F.call_function("div", F.col("turn"), F.lit(TURNS_PER_FLUSH)).alias("batch_id"),
    )


def log_records(log: DataFrame) -> DataFrame:
    """Rows of Spark's Kafka source as records.

    Expects the source's columns; read with ``includeHeaders`` for headers.
    Keys and values are bytes throughout, which is one schema: columnar files
    are not cut by it.
    """
    headers = (
        F.transform(
            F.coalesce(F.col("headers"), F.array()),
            lambda h: F.struct(h["key"].alias("key"), h["value"].alias("value")),
        )
        if "headers" in log.columns
        else F.array().cast("array<struct<key:string,value:binary>>")
    )
    return log.select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.unix_millis("timestamp").alias("timestamp_ms"),
        "key",
        "value",
        headers.alias("headers"),
        F.lit(0).alias("key_schema_id"),
        F.lit(0).alias("value_schema_id"),
    )


def read_log(
    spark: SparkSession, servers: str, topics: str, *, stream: bool = True, **options: str
) -> DataFrame:
    """Records straight from a log; needs Spark's Kafka connector on the classpath."""
    reader = spark.readStream if stream else spark.read
    return log_records(
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("includeHeaders", "true")
        .options(**options)
        .load()
    )

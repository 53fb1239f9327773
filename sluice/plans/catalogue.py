"""Named queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, "Query"] = {}


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def query(sql: str | None = None, name: str | None = None):
    """Registers a function under its own or the given name."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name or run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The records of sluice.sources.records, said in SQL.
RECORDS = """
records AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
         event_id AS "offset",
         CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS timestamp_ms,
         CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS key,
         props AS value, 1 AS key_schema_id,
         CAST(day(ts) // 10 AS INTEGER) AS value_schema_id,
         event_id // 1000 AS batch_id
  FROM events)
"""
DIALOGUE = """
dialogue AS (
  SELECT role AS topic, CAST(conv_id % 4 AS INTEGER) AS "partition",
         turn * 1099511627776 + conv_id AS "offset",
         CAST(conv_id AS VARCHAR) AS key, text AS value, turn // 4 AS batch_id
  FROM conversations)
"""
EVENT_TIME = "make_timestamp(timestamp_ms * 1000)"

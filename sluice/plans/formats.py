"""Queries that format records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import formats as fmt
from sluice.functions.timestamps import iso_instant
from sluice.operators.grouping import group_records
from sluice.plans.catalogue import EVENT_TIME, RECORDS, query, table
from sluice.plans.grouping import CHANGELOG, _starts, _TP
from sluice.sources.records import event_records

_B64_KEY = "coalesce(to_base64(encode(key)), '')"
_B64_VALUE = "coalesce(to_base64(encode(value)), '')"
_ISO = f"""strftime({EVENT_TIME}, '%Y-%m-%dT%H:%M:%S')
           || CASE WHEN timestamp_ms % 1000 = 0 THEN ''
              ELSE '.' || lpad(CAST(timestamp_ms % 1000 AS VARCHAR), 3, '0') END || 'Z'"""
_K = "CAST(json_extract_string(value, '$.k') AS INTEGER)"
_HEADERS_JSON = """('[{"key":"source","value":"events"},{"key":"type","value":"' || topic || '"}]')"""


def _records(spark, sf_dir) -> DataFrame:
    return event_records(table(spark, sf_dir, "events"))


def _struct_value(records: DataFrame) -> DataFrame:
    return records.withColumn("value", F.from_json("value", "k int"))


def _map_value(records: DataFrame) -> DataFrame:
    return records.withColumn("value", F.from_json("value", "map<string,int>"))


def _sql(columns: str) -> str:
    return f'WITH {RECORDS} SELECT "offset", {columns} FROM records'


@query(_sql(f"{_B64_KEY} || ',' || {_B64_VALUE} || ',' || timestamp_ms || ',' || \"offset\" AS line"))
def format_csv(spark, sf_dir):
    records = _records(spark, sf_dir)
    line = fmt.csv_line(records, ["key", "value", "timestamp", "offset"])
    return records.select("offset", line.alias("line"))


@query(_sql(f"{_B64_KEY} || ',' || value AS line"))
def format_csv_raw_value(spark, sf_dir):
    records = _records(spark, sf_dir)
    line = fmt.csv_line(records, ["key", "value"], value_encoding="none")
    return records.select("offset", line.alias("line"))


@query(
    _sql(
        f"""{_B64_KEY} || ',' || to_base64(encode('source')) || ':' || to_base64(encode('events'))
            || ';' || to_base64(encode('type')) || ':' || to_base64(encode(topic)) || ';' AS line"""
    )
)
def format_csv_headers(spark, sf_dir):
    records = _records(spark, sf_dir)
    return records.select("offset", fmt.csv_line(records, ["key", "headers"]).alias("line"))


_JSON_KEY = """coalesce('"' || key || '"', 'null')"""


@query(
    _sql(
        f"""'{{"key":' || {_JSON_KEY} || ',"value":{{"k":' || {_K} || '}},"timestamp":"' || {_ISO}
            || '","offset":' || "offset" || '}}' AS line"""
    )
)
def format_jsonl(spark, sf_dir):
    records = _struct_value(_records(spark, sf_dir))
    line = fmt.json_line(["key", "value", "timestamp", "offset"])
    return records.select("offset", line.alias("line"))


@query(_sql(f"{_ISO} AS instant"))
def json_timestamp(spark, sf_dir):
    instant = iso_instant(F.col("timestamp_ms"))
    return _records(spark, sf_dir).select("offset", instant.alias("instant"))


@query(
    _sql(f"""'{{"offset":' || "offset" || ',"headers":' || {_HEADERS_JSON} || '}}' AS line""")
)
def format_jsonl_headers(spark, sf_dir):
    records = _records(spark, sf_dir)
    return records.select("offset", fmt.json_line(["offset", "headers"]).alias("line"))


@query(
    _starts(_TP, limit=20)
    + f""" SELECT batch_id, topic || '-' || "partition" || '-' || start_offset AS file_name,
          '[' || chr(10) || string_agg('{{"key":' || {_JSON_KEY} || ',"offset":' || "offset" || '}}',
             ',' || chr(10) ORDER BY "offset") || chr(10) || ']' AS content
        FROM files GROUP BY ALL"""
)
def format_json_array(spark, sf_dir):
    """Whole JSON files as text; the record limit bounds what one row collects."""
    grouped = group_records(_records(spark, sf_dir), CHANGELOG, max_records=20)
    lines = grouped.select(
        "batch_id", "file_name", "offset", fmt.json_line(["key", "offset"]).alias("line")
    )
    ordered = F.array_sort(F.collect_list(F.struct("offset", "line")))
    return (
        lines.groupBy("batch_id", "file_name")
        .agg(ordered.alias("lines"))
        .select("batch_id", "file_name", fmt.json_array(F.col("lines.line")).alias("content"))
    )


@query(_sql(f"""'{{"k":' || {_K} || '}}' AS line"""))
def format_unwrapped_json(spark, sf_dir):
    records = _struct_value(_records(spark, sf_dir))
    return records.select("offset", fmt.json_line(["value"], envelope=False).alias("line"))


@query(
    f"""WITH {RECORDS} SELECT key, value, "offset", timestamp_ms AS "timestamp" FROM records"""
)
def envelope_columns(spark, sf_dir):
    return fmt.envelope_columns(_records(spark, sf_dir), ["key", "value", "offset", "timestamp"])


@query(_sql(f"{_K} AS k"))
def unwrap_struct(spark, sf_dir):
    return fmt.unwrap(_struct_value(_records(spark, sf_dir)), "value", "offset")


@query(_sql(f"{_K} AS k"))
def unwrap_map(spark, sf_dir):
    records = _map_value(_records(spark, sf_dir))
    keys = fmt.first_record_keys(records, "offset")
    return fmt.unwrap(records, "value", "offset", map_keys=keys)


@query(_sql("'events' AS source, topic AS type"))
def unwrap_map_all_keys(spark, sf_dir):
    """A column for every key of the first record's map."""
    headers = fmt.header_map(F.col("headers"))
    records = _records(spark, sf_dir).withColumn("value", headers)
    return fmt.unwrap(records, "value", "offset", map_keys=sorted(fmt.first_record_keys(records, "offset")))


@query(_sql("value"))
def unwrap_primitive(spark, sf_dir):
    return fmt.unwrap(_records(spark, sf_dir), "value", "offset")


@query(
    f"""WITH {RECORDS} SELECT "offset", 'source' AS name, 'events' AS header FROM records
        UNION ALL SELECT "offset", 'type', topic FROM records
        UNION ALL SELECT "offset", 'again', CAST("partition" AS VARCHAR) FROM records"""
)
def headers_map(spark, sf_dir):
    """A header set twice: the later value stands."""
    twice = F.concat(
        F.array(F.struct(F.lit("again").alias("key"), F.lit("first").alias("value"))),
        F.col("headers"),
        F.array(
            F.struct(F.lit("again").alias("key"), F.col("partition").cast("string").alias("value"))
        ),
    )
    mapped = _records(spark, sf_dir).select("offset", fmt.header_map(twice).alias("headers"))
    return mapped.select("offset", F.explode("headers").alias("name", "header"))


@query(_sql("\"partition\" % 2 = 1 AS same_type"))
def header_type_check(spark, sf_dir):
    """Types are those of the headers' values read as JSON where they are JSON, else text.

    A third header is a number in even partitions, and a text like the others
    in odd ones.
    """
    even = F.pmod("partition", F.lit(2)) == 0
    value = F.when(even, F.col("partition").cast("string")).otherwise(F.col("topic"))
    headers = F.concat(F.col("headers"), F.array(F.struct(F.lit("third").alias("key"), value.alias("value"))))
    types = F.transform(
        headers, lambda h: F.coalesce(F.schema_of_variant(F.try_parse_json(h["value"])), F.lit("STRING"))
    )
    return _records(spark, sf_dir).select("offset", fmt.check_header_types(types).alias("same_type"))

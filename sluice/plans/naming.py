"""Queries that render object names and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.naming import (
    default_template,
    extract_variables,
    key_string,
    legacy_name,
    record_bindings,
    record_time,
    render,
)
from sluice.plans.catalogue import EVENT_TIME, RECORDS, query, table
from sluice.sources.records import event_records


def _records(spark, sf_dir) -> DataFrame:
    return event_records(table(spark, sf_dir, "events"))


def _named(records: DataFrame, template: str, tz: str = "UTC") -> DataFrame:
    bindings = record_bindings(
        topic=F.col("topic"),
        partition=F.col("partition"),
        start_offset=F.col("offset"),
        key=F.col("key"),
        local=record_time("event", tz),
    )
    return records.select("offset", render(template, bindings).alias("object_name"))


def _sql(name: str) -> str:
    return f'WITH {RECORDS} SELECT "offset", {name} AS object_name FROM records'


_P10 = "lpad(CAST(\"partition\" AS VARCHAR), 10, '0')"
_O20 = "lpad(CAST(\"offset\" AS VARCHAR), 20, '0')"


@query(
    _sql("topic || '/' || \"partition\" || '/' || coalesce(key, 'null') || '/{{ other:a=b }}-' || \"offset\"")
)
def object_name_render(spark, sf_dir):
    template = "{{topic}}/{{ partition }}/{{key}}/{{ other:a=b }}-{{start_offset}}"
    return _named(_records(spark, sf_dir), template)


@query(_sql(f"'data/' || topic || '-' || {_P10} || '-' || {_O20}"))
def object_name_padded(spark, sf_dir):
    template = "data/{{topic}}-{{partition:padding=true}}-{{start_offset:padding=true}}"
    return _named(_records(spark, sf_dir), template)


_TIMED = (
    "{{topic}}/y={{timestamp:unit=yyyy}}/m={{timestamp:unit=MM}}/d={{timestamp:unit=dd}}"
    "/h={{timestamp:unit=HH}}/{{partition}}-{{start_offset}}"
)


def _timed_sql(time: str) -> str:
    return _sql(
        f"topic || '/' || strftime({time}, 'y=%Y/m=%m/d=%d/h=%H') || '/'"
        ' || "partition" || \'-\' || "offset"'
    )


@query(_timed_sql(EVENT_TIME))
def object_name_event_time(spark, sf_dir):
    return _named(_records(spark, sf_dir), _TIMED)


@query(_timed_sql(f"({EVENT_TIME} + INTERVAL 330 MINUTE)"))
def object_name_event_time_tz(spark, sf_dir):
    return _named(_records(spark, sf_dir), _TIMED, tz="Asia/Kolkata")


@query(
    f"""WITH {RECORDS}, named AS (
          SELECT *, topic || '-' || "partition" || '-' || "offset" AS n FROM records)
        SELECT "offset", n AS csv_plain, n || '.gz' AS csv_gzip, n || '.zst' AS jsonl_zstd,
               n || '.avro' AS avro_plain, n || '.avro.snappy' AS avro_snappy FROM named"""
)
def default_object_name(spark, sf_dir):
    names = {
        "csv_plain": ("csv", "none"),
        "csv_gzip": ("csv", "gzip"),
        "jsonl_zstd": ("jsonl", "zstd"),
        "avro_plain": ("avro", "none"),
        "avro_snappy": ("avro", "snappy"),
    }
    bindings = record_bindings(
        topic=F.col("topic"), partition=F.col("partition"), start_offset=F.col("offset")
    )
    return _records(spark, sf_dir).select(
        "offset", *[render(default_template(*how), bindings).alias(n) for n, how in names.items()]
    )


@query(
    _sql(
        f"'old/' || strftime({EVENT_TIME}, '%Y%m') || '/' || \"partition\" || '/' || {_O20}"
        f" || '/' || topic || '-' || \"partition\" || '-' || {_O20} || '.gz'"
    )
)
def legacy_prefix_name(spark, sf_dir):
    prefix = (
        "old/{{timestamp:unit=yyyy}}{{timestamp:unit=MM}}/{{partition:padding=true}}"
        "/{{start_offset:padding=true}}/"
    )
    name = legacy_name(
        prefix,
        topic=F.col("topic"),
        partition=F.col("partition"),
        start_offset=F.col("offset"),
        local=record_time("event", "UTC"),
        compression="gzip",
    )
    return _records(spark, sf_dir).select("offset", name.alias("object_name"))


@query(
    f"""WITH {RECORDS} SELECT "offset", topic, CAST("partition" AS VARCHAR) AS "partition",
          {_O20} AS start_offset FROM records"""
)
def name_extract(spark, sf_dir):
    template = "a.b/{{topic}}/({{partition}})-{{start_offset:padding=true}}.txt"
    named = _named(_records(spark, sf_dir), template)
    found = extract_variables(F.col("object_name"), template)
    return named.select("offset", *[c.alias(v) for v, c in found.items()])


@query(f"""WITH {RECORDS} SELECT "offset", coalesce(key, 'null') AS key_text FROM records""", name="key_string")
def key_text(spark, sf_dir):
    return _records(spark, sf_dir).select("offset", key_string(F.col("key")).alias("key_text"))

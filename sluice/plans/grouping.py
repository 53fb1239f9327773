"""Queries that group records into files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.audit import file_audit, file_manifest, schema_guard
from sluice.operators.compaction import compact_records
from sluice.operators.grouping import group_records
from sluice.operators.sizing import group_with_flags, record_size
from sluice.plans.catalogue import DIALOGUE, EVENT_TIME, RECORDS, query, table
from sluice.sources.records import conversation_records, event_records

CHANGELOG = "{{topic}}-{{partition}}-{{start_offset}}"
PADDED = "{{topic}}-{{partition:padding=true}}-{{start_offset:padding=true}}"
HOURLY = (
    "{{topic}}/{{timestamp:unit=yyyy}}-{{timestamp:unit=MM}}-{{timestamp:unit=dd}}"
    "T{{timestamp:unit=HH}}/{{partition}}-{{start_offset}}"
)
DAILY = "{{topic}}/{{timestamp:unit=MM}}{{timestamp:unit=dd}}/{{partition}}-{{start_offset}}"
KEYED = "{{topic}}-{{partition}}-{{key}}-{{start_offset}}"
KEYED_DAILY = "{{topic}}/{{timestamp:unit=dd}}/{{partition}}-{{key}}-{{start_offset}}"

_TP = 'batch_id, topic, "partition"'
_TPK = _TP + ", coalesce(key, 'null')"
_HOUR = f"strftime({EVENT_TIME}, '%Y-%m-%dT%H')"
_DAY = f"strftime({EVENT_TIME}, '%m%d')"
_DOM = f"strftime({EVENT_TIME}, '%d')"
_SCHEMAS = "key_schema_id || '/' || value_schema_id"
_ROWS = ["batch_id", "topic", "partition", "offset", "file_name"]
_CHANGELOG_SQL = "topic || '-' || \"partition\" || '-' || start_offset"
_KEYED_SQL = "topic || '-' || \"partition\" || '-' || coalesce(key, 'null') || '-' || start_offset"


def _starts(by: str, state: str | None = None, limit: int | None = None) -> str:
    """Records with the first offset of their file, from the closed forms."""
    run = f"""
    runs AS (
      SELECT *, sum(chg) OVER (PARTITION BY {by} ORDER BY "offset") AS run FROM (
        SELECT *, CASE WHEN lag({state or "1"}) OVER (PARTITION BY {by} ORDER BY "offset")
                       IS DISTINCT FROM ({state or "1"}) THEN 1 ELSE 0 END AS chg
        FROM records))"""
    chunk = (
        f'(row_number() OVER (PARTITION BY {by}, run ORDER BY "offset") - 1) // {limit}'
        if limit
        else "0"
    )
    return f"""WITH {RECORDS}, {run},
    chunks AS (SELECT *, {chunk} AS chunk FROM runs),
    files AS (SELECT *, min("offset") OVER (PARTITION BY {by}, run, chunk) AS start_offset
              FROM chunks)"""


def _rows_sql(name: str, by: str, state: str | None = None, limit: int | None = None) -> str:
    return _starts(by, state, limit) + (
        f' SELECT batch_id, topic, "partition", "offset", {name} AS file_name FROM files'
    )


def _records(spark, sf_dir) -> DataFrame:
    return event_records(table(spark, sf_dir, "events"))


def _dialogue(spark, sf_dir) -> DataFrame:
    return conversation_records(table(spark, sf_dir, "conversations"))


@query(
    _starts(_TP, limit=5)
    + """ SELECT batch_id, topic || '-' || lpad(CAST("partition" AS VARCHAR), 10, '0') || '-'
           || lpad(CAST(start_offset AS VARCHAR), 20, '0') AS file_name,
         count(*) AS n_records, min("offset") AS min_offset, max("offset") AS max_offset,
         CAST(sum(20 + coalesce(octet_length(encode(key)), 0)
                  + coalesce(octet_length(encode(value)), 0)) AS BIGINT) AS n_bytes
       FROM files GROUP BY ALL"""
)
def group_topic_partition_limited(spark, sf_dir):
    return file_manifest(group_records(_records(spark, sf_dir), PADDED, max_records=5))


@query(_rows_sql(_CHANGELOG_SQL, _TP))
def group_topic_partition(spark, sf_dir):
    return group_records(_records(spark, sf_dir), CHANGELOG).select(_ROWS)


_HOURLY_SQL = f"topic || '/' || {_HOUR} || '/' || \"partition\" || '-' || start_offset"


@query(_rows_sql(_HOURLY_SQL, _TP))
def group_time_unlimited(spark, sf_dir):
    return group_records(_records(spark, sf_dir), HOURLY, ts_source="event").select(_ROWS)


@query(_rows_sql(_HOURLY_SQL, _TP, state=_HOUR, limit=3))
def group_time_limited(spark, sf_dir):
    grouped = group_records(_records(spark, sf_dir), HOURLY, ts_source="event", max_records=3)
    return grouped.select(_ROWS)


@query(_rows_sql(_CHANGELOG_SQL, _TP, state=_SCHEMAS))
def group_schema_rotation(spark, sf_dir):
    return group_records(_records(spark, sf_dir), CHANGELOG, schema_rotation=True).select(_ROWS)


@query(_rows_sql(_CHANGELOG_SQL, _TP, state=_SCHEMAS, limit=4))
def group_schema_rotation_limited(spark, sf_dir):
    grouped = group_records(
        _records(spark, sf_dir), CHANGELOG, schema_rotation=True, max_records=4
    )
    return grouped.select(_ROWS)


@query(
    _rows_sql(
        f"topic || '/' || {_DAY} || '/' || \"partition\" || '-' || start_offset",
        _TP,
        state=f"{_SCHEMAS} || '/' || {_DAY}",
        limit=7,
    )
)
def group_schema_and_time_limited(spark, sf_dir):
    grouped = group_records(
        _records(spark, sf_dir), DAILY, ts_source="event", schema_rotation=True, max_records=7
    )
    return grouped.select(_ROWS)


@query(_rows_sql(_KEYED_SQL, _TPK))
def group_topic_partition_key(spark, sf_dir):
    return group_records(_records(spark, sf_dir), KEYED).select(_ROWS)


@query(
    _rows_sql(
        f"topic || '/' || {_DOM} || '/' || \"partition\" || '-' || coalesce(key, 'null')"
        " || '-' || start_offset",
        _TPK,
        state=_DOM,
        limit=2,
    )
)
def group_topic_partition_key_limited(spark, sf_dir):
    grouped = group_records(
        _records(spark, sf_dir), KEYED_DAILY, ts_source="event", max_records=2
    )
    return grouped.select(_ROWS)


@query(_rows_sql(_KEYED_SQL, _TPK, state=_SCHEMAS))
def group_tpk_schema_rotation(spark, sf_dir):
    return group_records(_records(spark, sf_dir), KEYED, schema_rotation=True).select(_ROWS)


_LAST = ["batch_id", "topic", "partition", "offset", "value", "file_name"]


def _last_sql(name: str, by: str, flush_first: bool = False) -> str:
    order = ("batch_id DESC, " if flush_first else "") + 'topic DESC, "partition" DESC, "offset" DESC'
    return f"""WITH {DIALOGUE}, named AS (SELECT *, {name} AS file_name FROM dialogue)
      SELECT batch_id, topic, "partition", "offset", value, file_name FROM (
        SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS rn FROM named)
      WHERE rn = 1"""


@query(_last_sql("key", "batch_id, file_name"))
def compact_by_key(spark, sf_dir):
    return group_records(_dialogue(spark, sf_dir), "{{key}}").select(_LAST)


@query(
    _last_sql(
        "topic || '/' || lpad(CAST(\"partition\" AS VARCHAR), 10, '0') || '/' || key",
        "batch_id, file_name",
    )
)
def compact_by_key_topic_partition(spark, sf_dir):
    template = "{{topic}}/{{partition:padding=true}}/{{key}}"
    return group_records(_dialogue(spark, sf_dir), template).select(_LAST)


@query(_last_sql("'k' || key", "file_name", flush_first=True))
def compact_across_flushes(spark, sf_dir):
    return compact_records(_dialogue(spark, sf_dir), "k{{key}}", across_flushes=True).select(_LAST)


@query(
    f"""WITH {RECORDS} SELECT "offset", CAST(20 + coalesce(octet_length(encode(key)), 0)
          + coalesce(octet_length(encode(value)), 0) AS BIGINT) AS record_bytes FROM records"""
)
def record_size_estimate(spark, sf_dir):
    size = record_size(F.col("key"), F.col("value"))
    return _records(spark, sf_dir).select("offset", size.alias("record_bytes"))


@query(
    _starts(_TP)
    + """ SELECT batch_id, topic, "partition", "offset", file_bytes, file_records,
         file_bytes >= 600 OR file_records >= 25 AS threshold_reached
       FROM (SELECT *, CAST(sum(20 + coalesce(octet_length(encode(key)), 0)
                 + coalesce(octet_length(encode(value)), 0)) OVER w AS BIGINT) AS file_bytes,
               CAST(count(*) OVER w AS BIGINT) AS file_records
             FROM files
             WINDOW w AS (PARTITION BY batch_id, topic, "partition", start_offset
                          ORDER BY "offset"))"""
)
def file_threshold_flags(spark, sf_dir):
    return group_with_flags(_records(spark, sf_dir), CHANGELOG, max_bytes=600, max_records=25).select(
        "batch_id",
        "topic",
        "partition",
        "offset",
        "file_bytes",
        "file_records",
        "threshold_reached",
    )


@query(
    _starts(_TP)
    + f""" SELECT batch_id, {_CHANGELOG_SQL} AS file_name, count(*) AS n_records,
         min("offset") AS min_offset, max("offset") AS max_offset,
         CAST(sum(20 + coalesce(octet_length(encode(key)), 0)
                  + coalesce(octet_length(encode(value)), 0)) AS BIGINT) AS n_bytes
       FROM files GROUP BY ALL""",
    name="file_manifest",
)
def file_manifest_unlimited(spark, sf_dir):
    return file_manifest(group_records(_records(spark, sf_dir), CHANGELOG))


@query(
    _starts(_TP, state=_HOUR, limit=3)
    + f""" , steps AS (SELECT *, {_HOURLY_SQL} AS file_name,
             lag("offset") OVER (PARTITION BY batch_id, {_HOURLY_SQL} ORDER BY "offset") AS prev
           FROM files)
       SELECT batch_id, file_name, count(*) AS n_records,
         min("offset") = min(start_offset) AS starts_at_first,
         count(*) FILTER (WHERE prev >= "offset") = 0 AS rising,
         count(*) <= 3 AS within_limit
       FROM steps GROUP BY ALL""",
    name="file_audit",
)
def file_audit_limited(spark, sf_dir):
    grouped = group_records(_records(spark, sf_dir), HOURLY, ts_source="event", max_records=3)
    return file_audit(grouped, max_records=3)


@query(
    _starts(_TP)
    + f""" SELECT batch_id, {_CHANGELOG_SQL} AS file_name,
         min({_SCHEMAS}) = max({_SCHEMAS}) AS one_schema FROM files GROUP BY ALL"""
)
def file_schema_guard(spark, sf_dir):
    return schema_guard(group_records(_records(spark, sf_dir), CHANGELOG))

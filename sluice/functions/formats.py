"""Records as text, JSON or columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.timestamps import iso_instant

FIELDS = ("key", "value", "offset", "timestamp", "headers")


def check_fields(fields: Sequence[str], envelope: bool = True) -> list[str]:
    unknown = [f for f in fields if f not in FIELDS]
    if unknown or not fields:
        raise ValueError(f"output fields must be some of {FIELDS}, got {list(fields)}")
    if not envelope and len(fields) != 1:
        raise ValueError("the envelope can be left out for a single output field only")
    return list(fields)


def _type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def base64_line(data: Column) -> Column:
    """Base64 without the line breaks Spark may put into long values."""
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def _plain_bytes(df: DataFrame, column: str) -> Column:
    if not isinstance(_type_of(df, column), (T.StringType, T.BinaryType)):
        raise TypeError(f"csv takes string or binary in {column!r}, got {_type_of(df, column)}")
    return F.col(column).cast("binary")


def csv_headers(headers: Column) -> Column:
    """``base64(key):base64(value);`` for each header, the last ``;`` included."""

    def one(h: Column) -> Column:
        return F.concat(
            base64_line(F.encode(h["key"], "UTF-8")),
            F.lit(":"),
            F.coalesce(base64_line(h["value"].cast("binary")), F.lit("")),
            F.lit(";"),
        )

    return F.array_join(F.transform(headers, one), "")


def csv_line(df: DataFrame, fields: Sequence[str], *, value_encoding: str = "base64") -> Column:
    """Fields in the given order, joined by commas without quoting; null is empty."""
    if value_encoding not in ("base64", "none"):
        raise ValueError(f"value encoding must be base64 or none, got {value_encoding!r}")

    def field(name: str) -> Column:
        if name == "key":
            text = base64_line(_plain_bytes(df, "key"))
        elif name == "value":
            raw = _plain_bytes(df, "value")
            text = base64_line(raw) if value_encoding == "base64" else raw.cast("string")
        elif name == "offset":
            text = F.col("offset").cast("string")
        elif name == "timestamp":
            text = F.col("timestamp_ms").cast("string")
        else:
            text = csv_headers(F.col("headers"))
        return F.coalesce(text, F.lit(""))

    return F.concat_ws(",", *[field(f) for f in check_fields(fields)])


def json_field(name: str) -> Column:
    if name == "timestamp":
        return iso_instant(F.col("timestamp_ms"))
    return F.col(name)


def json_line(fields: Sequence[str], *, envelope: bool = True) -> Column:
    """One JSON object per record; null fields are kept as JSON null.

    Without the envelope the text is the bare field.
    """
    fields = check_fields(fields, envelope)
    options = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct(*[json_field(f).alias(f) for f in fields]), options)
    if envelope:
        return whole
    # {"field":<bare>}
    skip = len(fields[0]) + 4
    return F.substring(whole, F.lit(skip + 1), F.length(whole) - F.lit(skip + 1))


def json_array(lines: Column) -> Column:
    """A whole JSON file from its lines, already in order."""
    return F.concat(F.lit("[\n"), F.array_join(lines, ",\n"), F.lit("\n]"))


def header_map(headers: Column) -> Column:
    """Headers by name; of a repeated name the last one counts."""

    def with_names(backwards: Column) -> Column:
        last_only = F.filter(
            headers, lambda h, i: F.array_position(backwards, h["key"]) == F.size(backwards) - i
        )
        repeats = F.size(F.array_distinct(backwards)) < F.size(backwards)
        return F.map_from_entries(F.when(repeats, last_only).otherwise(headers))

    # The one-element array works the names out once, not per header.
    names = F.reverse(F.transform(headers, lambda h: h["key"]))
    return F.transform(F.array(names), with_names)[0]


def check_header_types(types: Column) -> Column:
    """Whether all header values of a record are of one type (an array of type names)."""
    return F.size(F.array_distinct(types)) <= 1


def require_header_types(df: DataFrame, types: str) -> DataFrame:
    """Fails on a record whose headers differ in type."""
    error = F.raise_error(F.lit("header values of a record must share one type"))
    checked = F.when(check_header_types(F.col(types)), F.col(types)).otherwise(
        error.cast(_type_of(df, types))
    )
    return df.withColumn(types, checked)


def envelope_columns(df: DataFrame, fields: Sequence[str], *keep: str) -> DataFrame:
    """The chosen fields as columns; headers as a map."""

    def column(name: str) -> Column:
        if name == "timestamp":
            return F.col("timestamp_ms").alias("timestamp")
        if name == "headers":
            return header_map(F.col("headers")).alias("headers")
        return F.col(name)

    return df.select(*keep, *[column(f) for f in check_fields(fields)])


def unwrap(
    df: DataFrame, field: str, *keep: str, map_keys: Sequence[str] = (), strict: bool = True
) -> DataFrame:
    """One field without its envelope.

    A struct becomes its own columns, a map one column per key in
    ``map_keys``, anything else one column named after the field. A record
    with a key that has no column fails, unless ``strict`` is off.
    """
    check_fields([field], envelope=False)
    source = "timestamp_ms" if field == "timestamp" else field
    kind = _type_of(df, source)
    if isinstance(kind, T.StructType):
        return df.select(*keep, f"{source}.*")
    if isinstance(kind, T.MapType) and field == "value":
        unknown = unknown_keys(df, map_keys)
        error = F.raise_error(F.concat(F.lit("no column for "), F.array_join(unknown, ", ")))

        def column(key: str) -> Column:
            found = F.col(source)[key]
            if strict:
                found = F.when(F.size(unknown) > 0, error.cast(kind.valueType)).otherwise(found)
            return found.alias(key)

        return df.select(*keep, *[column(k) for k in map_keys])
    return df.select(*keep, F.col(source).alias(field))


def first_record_keys(df: DataFrame, *order: str) -> list[str]:
    """Map keys of the first record: what a file's columns are taken from."""
    row = df.select(*order, F.map_keys("value").alias("keys")).orderBy(*order).first()
    return list(row["keys"]) if row and row["keys"] else []


def unknown_keys(df: DataFrame, known: Sequence[str]) -> Column:
    """Keys of a record's map that the file's columns do not have."""
    keys = F.coalesce(F.map_keys("value"), F.array())
    return F.array_except(keys, F.array(*[F.lit(k) for k in known]))

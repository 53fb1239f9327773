"""Connector properties as arguments of the readers and writers here.

Only properties that shape the data are known; those of brokers, accounts and
uploads belong to Spark's and Hadoop's own configuration.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from sluice.functions.formats import check_fields
from sluice.functions.naming import check_grouping, default_template, upgrade_template


def _flag(text: str) -> bool:
    if text.strip().lower() not in ("true", "false"):
        raise ValueError(f"expected true or false, got {text!r}")
    return text.strip().lower() == "true"


def _names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


# Property names, the arguments they set, and their defaults.
_SINK: dict[str, tuple[str, Callable, str | None]] = {
    "file.name.template": ("template", str, None),
    "file.name.prefix": ("prefix", str, ""),
    "file.max.records": ("max_records", int, "0"),
    "file.compression.type": ("compression", str.lower, "none"),
    "file.name.timestamp.timezone": ("tz", str, "UTC"),
    "file.name.timestamp.source": ("ts_source", str.lower, "wallclock"),
    "format.output.type": ("fmt", str.lower, "csv"),
    "format.output.fields": ("fields", _names, "value"),
    "format.output.fields.value.encoding": ("value_encoding", str.lower, "base64"),
    "format.output.envelope": ("envelope", _flag, "true"),
}
# Parquet properties, behind ``connect.``, and the writer's options.
_PARQUET: dict[str, tuple[str, Callable]] = {
    "parquet.block.size": ("row_group_bytes", int),
    "parquet.page.size": ("data_page_size", int),
    "parquet.dictionary.page.size": ("dictionary_pagesize_limit", int),
    "parquet.enable.dictionary": ("use_dictionary", _flag),
    "parquet.writer.version": ("data_page_version", {"v1": "1.0", "v2": "2.0"}.__getitem__),
}
_SOURCE: dict[str, tuple[str, Callable, str | None]] = {
    "file.name.template": ("pattern", str, None),
    "input.format": ("fmt", str.lower, "bytes"),
    "topic": ("target_topic", str, None),
    "file.compression.type": ("compression", str.lower, "none"),
    "transformer.max.buffer.size": ("chunk_size", int, "4096"),
    "distribution.type": ("distribution", str.lower, "object_hash"),
    "tasks.max": ("tasks", int, "1"),
    "native.start.key": ("after", str, None),
    "aws.s3.prefix": ("prefix", str, ""),
    "azure.blob.prefix": ("prefix", str, ""),
    "errors.tolerance": ("tolerance", str.lower, None),
}


def _arguments(properties: Mapping[str, str], known) -> dict:
    found: dict = {}
    for name, (argument, convert, default) in known.items():
        text = properties.get(name, default)
        if text is None:
            found.setdefault(argument, None)
        elif argument not in found or name in properties:
            found[argument] = convert(text)
    return found


def sink_arguments(properties: Mapping[str, str]) -> dict:
    """Arguments of ``streaming.sink.write_stream`` for a sink's properties."""
    found = _arguments(properties, _SINK)
    if found["template"] is None:
        found["template"] = default_template(found["fmt"], found["compression"])
    found["template"] = upgrade_template(found["template"])
    check_grouping(found["template"], found["max_records"])
    check_fields(found["fields"], found["envelope"])
    if found["fmt"] == "parquet":
        found["options"] = {
            option: convert(properties[f"connect.{name}"].strip().lower())
            for name, (option, convert) in _PARQUET.items()
            if f"connect.{name}" in properties
        }
    return found


def source_arguments(properties: Mapping[str, str]) -> dict:
    """Arguments of ``sources.connector.read_records`` for a source's properties."""
    found = _arguments(properties, _SOURCE)
    if found["pattern"] is None:
        raise ValueError("a source needs file.name.template")
    return found

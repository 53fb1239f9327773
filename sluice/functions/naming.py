"""Object names: rendering a template, reading one back, matching a pattern.

A template is split once on the driver; what runs on the data is a plain
``concat`` or ``regexp_extract`` expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.timestamps import UNITS, local_time, time_unit

# The default name, the suffix of each codec, the padded widths.
DEFAULT_TEMPLATE = "{{topic}}-{{partition}}-{{start_offset}}"
CODEC_SUFFIX = {"none": "", "gzip": ".gz", "snappy": ".snappy", "zstd": ".zst"}
PARTITION_WIDTH = 10
OFFSET_WIDTH = 20

@dataclass(frozen=True)
class Part:
    """Literal text, or a variable with an optional ``param=value``."""

    text: str
    variable: str | None = None
    param: str | None = None
    value: str | None = None

    @property
    def flag(self) -> bool:
        return (self.value or "").lower() == "true"


def _word(text: str) -> bool:
    return text.isascii() and text.replace("_", "a").isalnum()


def _placeholder(text: str) -> Part | None:
    """The variable between a pair of double braces; None if it is plain text.

    A variable is a word, with blanks around it at most, and may carry one
    ``:name=value`` of words (more ``=`` end the value). What is spelled like
    one but lacks a part is an error.
    """
    variable, colon, setting = text[2:-2].strip().partition(":")
    if (variable and not _word(variable)) or (setting and not _word(setting.replace("=", "a"))):
        return None
    pieces = setting.split("=")
    lacking = [
        what
        for what, there in (
            ("variable", variable),
            ("parameter", pieces[0] or not colon),
            ("value", "".join(pieces[1:2]) or not colon),
        )
        if not there
    ]
    if lacking:
        raise ValueError(f"{text!r} has no {lacking[0]}")
    return Part(text, variable, *pieces[:2]) if colon else Part(text, variable)


def parse_template(template: str) -> list[Part]:
    """Literal texts and variables in turn.

    Each closing pair of braces is taken together with the nearest pair
    before it that opens.
    """
    parts: list[Part] = []
    literal, rest = "", template
    while rest:
        inside, closed, after = rest.partition("}}")
        at = inside.rfind("{{") if closed else -1
        part = _placeholder(inside[at:] + closed) if at >= 0 else None
        if part is None:
            literal, rest = literal + inside + closed, after
            continue
        literal += inside[:at]
        parts += [Part(literal)] if literal else []
        parts.append(part)
        literal, rest = "", after
    return parts + ([Part(literal)] if literal else [])


def template_variables(template: str) -> list[str]:
    return [p.variable for p in parse_template(template) if p.variable]


def timestamp_units(template: str) -> list[str]:
    """Units of the timestamp placeholders, in order, without repeats."""
    units: list[str] = []
    for part in parse_template(template):
        if part.variable == "timestamp":
            if part.value not in UNITS:
                raise ValueError(f"timestamp needs unit={'|'.join(UNITS)}, got {part.text}")
            if part.value not in units:
                units.append(part.value)
    return units


def render(template: str, bindings: Mapping[str, Callable[[Part], Column]]) -> Column:
    """The name as a column; a variable without a binding stays as written."""
    pieces = [
        bindings[p.variable](p) if p.variable in bindings else F.lit(p.text)
        for p in parse_template(template)
    ]
    return F.concat(*pieces) if pieces else F.lit("")


def padded(column: Column, width: int) -> Column:
    return F.lpad(column.cast("string"), width, "0")


def partition_text(partition: Column) -> Callable[[Part], Column]:
    return lambda p: padded(partition, PARTITION_WIDTH) if p.flag else partition.cast("string")


def offset_text(offset: Column) -> Callable[[Part], Column]:
    return lambda p: padded(offset, OFFSET_WIDTH) if p.flag else offset.cast("string")


def timestamp_text(local: Column) -> Callable[[Part], Column]:
    return lambda p: time_unit(local, p.value or "")


def key_string(key: Column) -> Column:
    """Null becomes the word ``null``; binary keys are read as UTF-8."""
    return F.coalesce(key.cast("string"), F.lit("null"))


def record_bindings(
    *,
    topic: Column | None = None,
    partition: Column | None = None,
    start_offset: Column | None = None,
    key: Column | None = None,
    local: Column | None = None,
) -> dict[str, Callable[[Part], Column]]:
    bindings: dict[str, Callable[[Part], Column]] = {}
    if topic is not None:
        bindings["topic"] = lambda p: topic
    if partition is not None:
        bindings["partition"] = partition_text(partition)
    if start_offset is not None:
        bindings["start_offset"] = offset_text(start_offset)
    if key is not None:
        bindings["key"] = lambda p: key_string(key)
    if local is not None:
        bindings["timestamp"] = timestamp_text(local)
    return bindings


def record_time(
    ts_source: str, tz: str, millis: Column | None = None, clock: Column | None = None
) -> Column:
    """Local time of a name: the record's own, or the start of the batch.

    ``clock`` is that start where it is known; it defaults to the job's.
    """
    source = ts_source.lower()
    if source == "event":
        return local_time(F.col("timestamp_ms") if millis is None else millis, tz)
    if source == "wallclock":
        return local_time(F.unix_millis(F.current_timestamp() if clock is None else clock), tz)
    raise ValueError(f"timestamp source must be event or wallclock, got {ts_source!r}")


def upgrade_template(template: str) -> str:
    """The legacy unit ``YYYY`` is read as ``yyyy``."""
    return re.sub(
        r"\{\{\s*timestamp\s*:\s*unit\s*=\s*YYYY\s*\}\}",
        lambda m: m.group(0).replace("YYYY", "yyyy"),
        template,
    )


def name_suffix(fmt: str, compression: str = "none") -> str:
    return (".avro" if fmt == "avro" else "") + CODEC_SUFFIX[compression]


def default_template(fmt: str = "csv", compression: str = "none") -> str:
    return DEFAULT_TEMPLATE + name_suffix(fmt, compression)


def legacy_name(
    prefix_template: str,
    *,
    topic: Column,
    partition: Column,
    start_offset: Column,
    local: Column,
    fmt: str = "csv",
    compression: str = "none",
) -> Column:
    """Rendered prefix, then ``topic-partition-offset`` with a padded offset.

    ``partition`` is never padded here, whatever its parameter says.
    """
    bindings = record_bindings(topic=topic, start_offset=start_offset, local=local)
    bindings["partition"] = lambda p: partition.cast("string")
    bindings["utc_date"] = lambda p: F.to_date(
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    ).cast("string")
    bindings["local_date"] = lambda p: F.to_date(F.localtimestamp()).cast("string")
    return F.concat(
        render(prefix_template, bindings),
        topic,
        F.lit("-"),
        partition.cast("string"),
        F.lit("-"),
        padded(start_offset, OFFSET_WIDTH),
        F.lit(name_suffix(fmt, compression)),
    )


def resolve_mode(template: str) -> str:
    """Which grouping a template asks for, judged by its set of variables.

    Required variables must all be there. What is left over must be empty or
    meet the optional set, so an extra unknown variable passes beside an
    optional one.
    """
    variables = set(template_variables(template))
    if not variables:
        raise ValueError(f"template {template!r} has no variables")

    def fits(required: set[str], optional: set[str]) -> bool:
        rest = variables - required
        return required <= variables and (not rest or bool(rest & optional))

    if fits({"topic", "partition", "key", "start_offset"}, {"timestamp"}):
        return "topic_partition_key"
    if fits({"topic", "partition", "start_offset"}, {"timestamp"}):
        return "topic_partition"
    if variables == {"key"}:
        return "key"
    if fits({"key"}, {"topic", "partition"}):
        return "key_topic_partition"
    raise ValueError(f"unsupported set of template variables in {template!r}: {sorted(variables)}")


def check_grouping(template: str, max_records: int = 0) -> str:
    """The mode; key-based names hold one record, so a larger limit is refused."""
    mode = resolve_mode(template)
    if max_records < 0:
        raise ValueError("max_records must not be negative")
    if mode.startswith("key") and max_records > 1:
        raise ValueError(f"with {template!r} max_records must be 1 or not set")
    return mode


def extract_variables(
    name: Column, template: str, *, on_mismatch: str = "error"
) -> dict[str, Column]:
    """Variables of a rendered name, by the template it was rendered from.

    The whole name must match: text literally, variables as short as they
    can be, a repeated variable equal to its first occurrence.
    """
    order: list[str] = []
    regex = r"\A"
    for part in parse_template(template):
        if part.variable is None:
            regex += _quote(part.text)
        elif part.variable in order:
            regex += rf"(?:\{order.index(part.variable) + 1})"
        else:
            order.append(part.variable)
            regex += "(.*?)"
    regex += r"\z"
    if on_mismatch == "error":
        missing = F.raise_error(F.concat(F.lit("name does not match the template: "), name))
    elif on_mismatch == "null":
        missing = F.lit(None).cast("string")
    else:
        raise ValueError("on_mismatch must be error or null")
    return {
        variable: F.when(name.rlike(regex), F.regexp_extract(name, regex, i)).otherwise(missing)
        for i, variable in enumerate(order, start=1)
    }


def _quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


# What each placeholder of a source pattern may match.
_SOURCE_GROUPS = {
    "{{start_offset}}": r"(?<startOffset>\d+)",
    "{{timestamp}}": r"(?:\d+)",
    "{{topic}}": r"(?<topic>[a-zA-Z0-9\-_.]+)",
    "{{partition}}": r"(?<partition>\d+)",
}


@dataclass(frozen=True)
class SourceMatch:
    matches: Column
    topic: Column
    partition: Column
    offset: Column


def match_source_name(name: Column, pattern: str) -> SourceMatch:
    """Topic, partition and offset found anywhere in an object name.

    Only the exact placeholders are replaced; all other text is a regular
    expression. A number too large for its type is null and the row stays.
    """
    regex = pattern
    for placeholder, group in _SOURCE_GROUPS.items():
        regex = regex.replace(placeholder, group)
    try:
        groups = re.compile(re.sub(r"\(\?<(?=[A-Za-z])", "(?P<", regex)).groupindex
    except re.error as e:
        raise ValueError(f"cannot compile the source pattern {pattern!r}: {e}") from e

    def group(label: str) -> Column:
        if label not in groups:
            return F.lit(None).cast("string")
        # No group matches the empty text, which stands for a name that does not fit.
        return F.nullif(F.regexp_extract(name, regex, groups[label]), F.lit(""))

    return SourceMatch(
        matches=name.rlike(regex),
        topic=group("topic"),
        partition=group("partition").try_cast("int"),
        offset=group("startOffset").try_cast("bigint"),
    )

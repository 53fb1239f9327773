"""Grouping records into files by a name template.

Every grouping is per flush: ``batch_id``, where present, leads each group.
Records of a (topic, partition) are taken in offset order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.functions.naming import (
    check_grouping,
    key_string,
    record_bindings,
    record_time,
    render,
    timestamp_units,
    upgrade_template,
)
from sluice.functions.timestamps import time_unit
from sluice.operators.compaction import compact_records
from sluice.operators.slices import (
    SEED,
    SLICE,
    SLICE_WIDTH,
    attach,
    before,
    rank,
    running,
    running_totals,
    seeded,
    with_seeds,
    with_slice,
    within,
    without_seeds,
)

# When a flush began, where the records carry it; else the time of the job.
FLUSH_TIME = "_flush_time"
_LOCAL = "_local_time"
_STATE = "_state"


def group_records(
    records: DataFrame,
    template: str,
    *,
    max_records: int = 0,
    ts_source: str = "wallclock",
    tz: str = "UTC",
    schema_rotation: bool = False,
    prefix: str = "",
    slice_width: int = SLICE_WIDTH,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """The records with ``start_offset`` and ``file_name`` added.

    The template's variables choose the grouping. Key-based names keep only
    the last record of each name and carry no start offset. ``totals`` adds
    running sums within each file, up to and including the record; where a
    group is one file, they come from the same slices as its start.
    """
    template = upgrade_template(template)
    mode = check_grouping(template, max_records)
    if totals and (mode.startswith("key") or max_records or schema_rotation or timestamp_units(template)):
        how = {"ts_source": ts_source, "tz": tz, "schema_rotation": schema_rotation, "prefix": prefix}
        grouped = group_records(records, template, max_records=max_records, slice_width=slice_width, **how)
        file = [c for c in ("batch_id",) if c in grouped.columns] + ["file_name"]
        return running_totals(grouped, file, "offset", totals, width=slice_width)
    if mode.startswith("key"):
        return compact_records(records.drop(FLUSH_TIME), template, prefix=prefix)

    by = [c for c in ("batch_id",) if c in records.columns] + ["topic", "partition"]
    if mode == "topic_partition_key":
        records = records.withColumn("_key_string", key_string(F.col("key")))
        by.append("_key_string")
    clock = F.col(FLUSH_TIME) if FLUSH_TIME in records.columns else None
    records = records.withColumn(_LOCAL, record_time(ts_source, tz, clock=clock)).drop(FLUSH_TIME)
    if schema_rotation:
        records = _require_schemas(records)

    state = ["key_schema_id", "value_schema_id"] if schema_rotation else []
    if max_records:
        units = timestamp_units(template)
        if units:
            rendered = [time_unit(F.col(_LOCAL), u) for u in units]
            records = records.withColumn("_rendered_time", F.concat_ws("-", *rendered))
            state = [*state, "_rendered_time"]
        started = _limited_starts(records, by, state, max_records, slice_width)
    elif state:
        started = _run_starts(records, by, state, slice_width)
    elif totals:
        started = _group_totals(records, by, slice_width, totals)
    else:
        started = _group_starts(records, by, slice_width)

    name = render(
        template,
        record_bindings(
            topic=F.col("topic"),
            partition=F.col("partition"),
            start_offset=F.col("start_offset"),
            key=F.col("key"),
            local=F.col(_LOCAL),
        ),
    )
    named = started.withColumn("file_name", F.concat(F.lit(prefix), name))
    return named.drop("_key_string", _LOCAL, "_rendered_time")


def placed_width(
    template: str,
    *,
    max_records: int = 0,
    schema_rotation: bool = False,
    slice_width: int = SLICE_WIDTH,
) -> int:
    """Offsets per ordered stretch that ``group_records`` leaves in its tasks.

    Groupings that end in a window over slices leave each slice of a file
    whole and in order, and key-based ones have files of one record; the
    writer need not shuffle them again. Unlimited ones end in a join and give
    0, for no order at all; so do timed ones cut by schema alone, whose files
    of several times have their records in turn.
    """
    template = upgrade_template(template)
    mode = check_grouping(template, max_records)
    runs = schema_rotation and not timestamp_units(template)
    placed = mode.startswith("key") or max_records or runs
    return slice_width if placed else 0


def _require_schemas(records: DataFrame) -> DataFrame:
    """Rotation by schema needs a key schema and a value schema on every record."""
    known = F.col("key_schema_id").isNotNull() & F.col("value_schema_id").isNotNull()
    error = F.raise_error(F.lit("records must have schemas for key and value"))
    return records.withColumn(
        "value_schema_id",
        F.when(known, F.col("value_schema_id")).otherwise(error.cast("int")),
    )


def _group_starts(records: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Unlimited files: the first offset of the whole group."""
    sliced = with_slice(records, "offset", width)
    firsts = sliced.groupBy(*by, SLICE).agg(F.min("offset").alias("_first"))
    starts = firsts.select(
        *by, SLICE, F.min("_first").over(W.partitionBy(*by)).alias("start_offset")
    )
    return attach(sliced, starts, by).drop(SLICE)


def _group_totals(records: DataFrame, by: Sequence[str], width: int, totals: dict[str, Column]) -> DataFrame:
    """Unlimited files: the first offset of the whole group and running sums, from one table of slices."""
    added = {f"_add_{name}": expr for name, expr in totals.items()}
    sliced = with_slice(records, "offset", width).withColumns(added)
    per_slice = sliced.groupBy(*by, SLICE).agg(F.min("offset").alias("_first"), *[F.sum(a).alias(a) for a in added])
    seeds = per_slice.select(
        *by,
        SLICE,
        F.min("_first").over(W.partitionBy(*by)).alias("_entry"),
        *[F.coalesce(F.sum(a).over(before(by)), F.lit(0)).alias(a) for a in added],
    )
    window = running(by, "offset")
    sums = {name: F.sum(f"_add_{name}").over(window) for name in totals}
    summed = with_seeds(sliced, seeds).withColumns(sums | {"start_offset": F.max("_entry").over(window)})
    return without_seeds(summed, "_entry", *added)


def _differs(window) -> Column:
    """True where the state is not that of the row before, seeds included."""
    previous = F.lag(_STATE).over(window)
    return previous.isNull() | (previous != F.col(_STATE))


def _state_per_slice(marked: DataFrame, by: Sequence[str], position: str) -> DataFrame:
    """Per slice: records, states at its ends, and where the state last changed in it."""
    inside = F.col("_change") & F.col("_follows")
    return marked.groupBy(*by, SLICE).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("offset").alias("_first"),
        F.min_by(_STATE, "offset").alias("_first_state"),
        F.max_by(_STATE, "offset").alias("_last_state"),
        F.max(F.when(inside, F.col(position))).alias("_last_change"),
    )


def _mark_changes(sliced: DataFrame, by: Sequence[str]) -> DataFrame:
    """Marks changes of state inside slices; the first row of a slice follows nothing."""
    window = within(by, "offset")
    return (
        sliced.withColumn("_rank", F.row_number().over(window))
        .withColumn("_change", _differs(window))
        .withColumn("_follows", F.col("_rank") > 1)
    )


def _with_edges(per_slice: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds the state before each slice and whether the slice starts with another."""
    earlier = F.lag("_last_state").over(W.partitionBy(*by).orderBy(SLICE))
    return per_slice.withColumn("_state_before", earlier).withColumn(
        "_edge",
        F.col("_state_before").isNull() | (F.col("_state_before") != F.col("_first_state")),
    )


def _run_starts(
    records: DataFrame, by: Sequence[str], state: Sequence[str], width: int
) -> DataFrame:
    """Unlimited files that start anew whenever the state changes."""
    sliced = with_slice(records, "offset", width).withColumn(_STATE, F.struct(*state))
    narrow = sliced.select(*by, SLICE, "offset", _STATE)
    per_slice = _with_edges(_state_per_slice(_mark_changes(narrow, by), by, "offset"), by)
    latest = F.coalesce("_last_change", F.when(F.col("_edge"), F.col("_first")))
    seeds = per_slice.withColumn("_latest", latest).select(
        *by,
        SLICE,
        F.col("_state_before").alias(_STATE),
        F.max("_latest").over(before(by)).alias("_entry"),
    )
    start = seeded("_entry", F.when(F.col("_change"), F.col("offset")))
    started = (
        with_seeds(sliced, seeds)
        .withColumn("_change", _differs(within(by, "offset")))
        .withColumn("start_offset", F.max(start).over(running(by, "offset")))
    )
    return without_seeds(started, _STATE, "_change", "_entry")


def _limited_starts(
    records: DataFrame, by: Sequence[str], state: Sequence[str], max_records: int, width: int
) -> DataFrame:
    """Files of at most ``max_records``; a change of state also starts a new one."""
    sliced = with_slice(records, "offset", width)
    if state:
        sliced = sliced.withColumn(_STATE, F.struct(*state))
    narrow = sliced.select(*by, SLICE, "offset", *([_STATE] if state else []))

    seeds = _run_seeds(narrow, by, bool(state))
    carry = [c for c in seeds.columns if c not in (*by, SLICE)]
    # What a seed carries is handed on beside the last head of its slice.
    handed_on = [F.max(F.when(F.col(SEED), F.col(c))).alias(c) for c in carry]
    seeds = (
        _mark_heads(with_seeds(narrow, seeds), by, max_records, bool(state))
        .groupBy(*by, SLICE)
        .agg(F.max(F.when(F.col("_head"), F.col("offset"))).alias("_last_head"), *handed_on)
        .select(*by, SLICE, *carry, F.max("_last_head").over(before(by)).alias("_entry"))
    )
    marked = _mark_heads(with_seeds(sliced, seeds), by, max_records, bool(state))
    start = seeded("_entry", F.when(F.col("_head"), F.col("offset")))
    started = marked.withColumn("start_offset", F.max(start).over(running(by, "offset")))
    return without_seeds(started, _STATE, "_base", "_run", "_head", "_entry")


def _run_seeds(narrow: DataFrame, by: Sequence[str], stateful: bool) -> DataFrame:
    """Per slice: records before it, the rank at which the run in progress began,
    and the state it has."""
    base = F.coalesce(F.sum("_n").over(before(by)), F.lit(0)).alias("_base")
    if not stateful:
        counts = narrow.groupBy(*by, SLICE).agg(F.count(F.lit(1)).alias("_n"))
        return counts.select(*by, SLICE, base)
    per_slice = _with_edges(_state_per_slice(_mark_changes(narrow, by), by, "_rank"), by)
    latest = F.coalesce(
        F.col("_base") + F.col("_last_change"), F.when(F.col("_edge"), F.col("_base") + 1)
    )
    return (
        per_slice.select("*", base)
        .withColumn("_latest", latest)
        .select(
            *by,
            SLICE,
            "_base",
            F.max("_latest").over(before(by)).alias("_run"),
            F.col("_state_before").alias(_STATE),
        )
    )


def _mark_heads(df: DataFrame, by: Sequence[str], max_records: int, stateful: bool) -> DataFrame:
    """Marks the record that opens each file."""
    df = df.withColumn("_rank", rank("_base", by, "offset"))
    run: Column = F.lit(1)
    if stateful:
        df = df.withColumn("_change", _differs(within(by, "offset")))
        began = seeded("_run", F.when(F.col("_change"), F.col("_rank")))
        run = F.max(began).over(running(by, "offset"))
    head = F.col(SEED).isNull() & (F.pmod(F.col("_rank") - run, F.lit(max_records)) == 0)
    return df.withColumn("_head", head).drop("_rank", "_change")

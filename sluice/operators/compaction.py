"""Keeping the last record of each name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.naming import check_grouping, record_bindings, render

ARRIVAL = ("timestamp_ms", "topic", "partition", "offset")


def compact_records(
    records: DataFrame,
    template: str,
    *,
    prefix: str = "",
    across_flushes: bool = False,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """The last record per rendered name, in each flush or over all of them.

    The last is the greatest by flush and ``arrival``. It is found by
    partial aggregation, so a name that holds most of the records still
    shuffles one row per input task.
    """
    if not check_grouping(template).startswith("key"):
        raise ValueError(f"{template!r} is not a key-based name")
    name = F.concat(
        F.lit(prefix),
        render(
            template,
            record_bindings(topic=F.col("topic"), partition=F.col("partition"), key=F.col("key")),
        ),
    )
    flush = [c for c in ("batch_id",) if c in records.columns]
    group = ["file_name"] if across_flushes else [*flush, "file_name"]
    order = [*flush, *arrival] if across_flushes else list(arrival)
    columns = [c for c in records.columns if c not in group]
    return (
        records.withColumn("file_name", name)
        .groupBy(*group)
        .agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
        .select(*[c for c in group if c != "file_name"], "_last.*", "file_name")
    )

"""Record size estimates and the thresholds that ask for a commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.slices import SLICE_WIDTH, running_totals

# Fixed value: bytes added to the key and value of each record.
RECORD_OVERHEAD = 20


def record_size(key: Column, value: Column) -> Column:
    """Overhead plus the UTF-8 length of key and value."""

    def size(c: Column) -> Column:
        return F.coalesce(F.octet_length(c.cast("binary")), F.lit(0))

    return (F.lit(RECORD_OVERHEAD) + size(key) + size(value)).cast("bigint")


def threshold_flags(
    grouped: DataFrame,
    *,
    max_bytes: int = 0,
    max_records: int = 0,
    slice_width: int = SLICE_WIDTH,
) -> DataFrame:
    """Adds running bytes and count of each file, and whether a limit is reached.

    A limit of 0 is no limit. The flag asks for a commit; it splits no file.
    """
    by = [c for c in ("batch_id",) if c in grouped.columns] + ["file_name"]
    totals = running_totals(grouped, by, "offset", file_totals(), width=slice_width)
    return _flagged(totals, max_bytes, max_records)


def file_totals() -> dict[str, Column]:
    """The running sums that thresholds look at, as ``group_records`` takes them."""
    return {"file_bytes": record_size(F.col("key"), F.col("value")), "file_records": F.lit(1).cast("bigint")}


def group_with_flags(
    records: DataFrame, template: str, *, max_bytes: int = 0, max_records: int = 0, **grouping
) -> DataFrame:
    """Files by ``template`` with their ``threshold_flags``.

    Where a file is a whole partition of a flush, starts and sums come from the
    same slices, so records are shuffled once for both. ``grouping`` are further
    arguments of ``group_records``; the thresholds limit no file.
    """
    from sluice.operators.grouping import group_records

    return _flagged(group_records(records, template, totals=file_totals(), **grouping), max_bytes, max_records)


def _flagged(totals: DataFrame, max_bytes: int, max_records: int) -> DataFrame:
    reached = F.lit(False)
    if max_bytes:
        reached = reached | (F.col("file_bytes") >= max_bytes)
    if max_records:
        reached = reached | (F.col("file_records") >= max_records)
    return totals.withColumn("threshold_reached", reached)

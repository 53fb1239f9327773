"""Assigning objects to a fixed number of workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf16_hash(text: Column) -> Column:
    """32-bit polynomial hash (factor 31) over the UTF-16 units of a string."""
    units = F.hex(F.encode(text, "UTF-16BE"))

    def fold(units: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.length(units), F.lit(4)),
            F.lit(0).cast("bigint"),
            lambda h, i: (h * 31 + F.conv(F.substring(units, i, 4), 16, 10).cast("bigint"))
            .bitwiseAND(F.lit(0xFFFFFFFF)),
        )

    # The one-element array works the units out once, not per character.
    unsigned = F.when(text == "", F.lit(0).cast("bigint")).otherwise(
        F.transform(F.array(units), fold)[0]
    )
    return F.when(unsigned >= 2**31, unsigned - F.lit(2**32)).otherwise(unsigned)


def shard_by_object(key: Column, tasks: int) -> Column:
    return F.pmod(utf16_hash(key), F.lit(_positive(tasks))).cast("int")


def shard_by_partition(partition: Column, tasks: int) -> Column:
    """Null where the name holds no partition; such objects belong to nobody."""
    return F.pmod(partition.cast("bigint"), F.lit(_positive(tasks))).cast("int")


def shard_balanced(key: Column, tasks: int) -> Column:
    """Cheaper than ``shard_by_object`` where only the balance matters."""
    return F.pmod(F.xxhash64(key), F.lit(_positive(tasks))).cast("int")


def _positive(tasks: int) -> int:
    if tasks <= 0:
        raise ValueError("the number of tasks must be at least 1")
    return tasks

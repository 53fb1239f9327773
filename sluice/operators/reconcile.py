"""Whether what was written is what came in: nothing lost, doubled or changed.

Both sides are reduced to one row per topic, partition and slice of offsets: the
number of records and three sums over a hash of each record that do not depend
on any order (the halves of the hash added up, and its exclusive or). The small
tables are joined; records are neither sorted nor joined. A slice that differs
can then be looked at record by record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.slices import SLICE, SLICE_WIDTH, with_slice

_BY = ("topic", "partition")
_SUMS = ("_n", "_low", "_high", "_xor")


def checksums(records: DataFrame, columns: Sequence[str], *, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """Per topic, partition and ``slice``: number and checksums of the records' ``columns``.

    A null is not an empty text. Equal records count as often as they come.
    """
    marked = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    hashed = with_slice(records, "offset", slice_width).select(*_BY, SLICE, F.xxhash64(*marked).alias("_hash"))
    return hashed.groupBy(*_BY, F.col(SLICE).alias("slice")).agg(
        F.count(F.lit(1)).alias("_n"),
        # Halves of 32 bits: the sums of some two billion records fit.
        F.sum(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"),
        F.sum(F.shiftrightunsigned("_hash", 32)).alias("_high"),
        F.bit_xor("_hash").alias("_xor"),
    )


def reconcile(
    log: DataFrame, objects: DataFrame, columns: Sequence[str] = ("offset", "key", "value"), *, slice_width: int = SLICE_WIDTH
) -> DataFrame:
    """The slices that differ: ``topic, partition, slice, n_log, n_objects, state``.

    ``state`` is ``missing`` or ``extra`` by the numbers, and ``changed`` where
    these agree. Topics and partitions may be null. No rows: all is there.
    """
    sides = [checksums(side, columns, slice_width=slice_width) for side in (log, objects)]
    left, right = (side.withColumnsRenamed({c: f"{c}{i}" for c in _SUMS}) for i, side in enumerate(sides))
    keys = [*_BY, "slice"]
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    both = left.join(right, same[0] & same[1] & same[2], "full")
    there = F.col("_n0").isNotNull()
    n_log, n_objects = F.coalesce("_n0", F.lit(0)), F.coalesce("_n1", F.lit(0))
    differs = ~(F.col("_n0").eqNullSafe(F.col("_n1")))
    for c in _SUMS[1:]:
        differs = differs | ~F.col(f"{c}0").eqNullSafe(F.col(f"{c}1"))
    state = F.when(n_objects < n_log, "missing").when(n_objects > n_log, "extra").otherwise("changed")
    return both.where(differs).select(
        *[F.when(there, F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys],
        n_log.alias("n_log"),
        n_objects.alias("n_objects"),
        state.alias("state"),
    )


def differing_records(
    log: DataFrame, objects: DataFrame, differing: DataFrame, columns: Sequence[str] = ("offset", "key", "value"), *, slice_width: int = SLICE_WIDTH
) -> DataFrame:
    """The records of the differing slices that one side has more often: ``topic, partition, *columns, n_log, n_objects``."""
    marks = differing.select(*_BY, F.col("slice").alias(SLICE))

    def counted(side: DataFrame, n: str) -> DataFrame:
        rows = with_slice(side, "offset", slice_width).select(*_BY, SLICE, *[c for c in columns if c not in _BY]).alias("r")
        same = F.lit(True)
        for k in (*_BY, SLICE):
            same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}"))
        kept = rows.join(marks.alias("m"), same, "left_semi")
        return kept.withColumns({c: F.lit(int(c == n)) for c in ("n_log", "n_objects")})

    both = counted(log, "n_log").unionByName(counted(objects, "n_objects")).drop(SLICE)
    keys = [c for c in both.columns if c not in ("n_log", "n_objects")]
    totals = both.groupBy(*keys).agg(F.sum("n_log").alias("n_log"), F.sum("n_objects").alias("n_objects"))
    return totals.where("n_log <> n_objects")

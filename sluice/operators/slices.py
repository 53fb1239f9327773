"""Ordered, running computations over groups of any size.

A window over (topic, partition) would put a whole partition into one task.
Offsets are unique within a partition, so a stretch of ``width`` consecutive
offsets, a *slice*, holds at most ``width`` records whatever the data looks
like. Every running computation here is done in two steps: one row per slice
is worked out first (a small table, windowed over the group), then each
record is finished inside its own slice.

What came before a slice reaches its records as a *seed*: a row of the small
table that joins the records by union and sorts before them. So the records
are shuffled and sorted once, however many slices there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE_WIDTH = 1 << 16
SLICE = "_slice"
SEED = "_seed"


def with_slice(
    df: DataFrame,
    position: str = "offset",
    width: int = SLICE_WIDTH,
    slice_by: str | None = None,
) -> DataFrame:
    """Adds the slice of each row.

    Rows that already come in bounded, ordered stretches, such as the blocks
    a file is read in, name that column in ``slice_by``; ``position`` then
    orders the rows of a stretch.
    """
    if slice_by:
        return df.withColumn(SLICE, F.col(slice_by))
    if width < 1:
        raise ValueError("slice width must be at least 1")
    at = F.col(position)
    return df.withColumn(
        SLICE, F.call_function("div", at - F.pmod(at, F.lit(width)), F.lit(width))
    )


def within(by: Sequence[str], position: str):
    """Window over one slice in order: bounded by the slice width."""
    return W.partitionBy(*by, SLICE).orderBy(F.col(position).asc_nulls_first())


def before(by: Sequence[str]):
    """Window over the earlier slices of a group."""
    return W.partitionBy(*by).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)


def running(by: Sequence[str], position: str):
    return within(by, position).rowsBetween(W.unboundedPreceding, 0)


def attach(df: DataFrame, per_slice: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join the table of all slices back; no key of this join exceeds the slice width.

    An outer join, as Spark may send its right side alone through the driver:
    rows read from objects look as small to it as the listing they come from.
    """
    keys = [*by, SLICE]
    return df.dropna(subset=keys).join(per_slice, keys, "left")


def with_seeds(df: DataFrame, seeds: DataFrame) -> DataFrame:
    """The rows and their seeds; ``seeds`` has the group, the slice and what to carry.

    A seed has no position and so comes first in ``within`` and ``running``.
    """
    return df.unionByName(seeds.withColumn(SEED, F.lit(True)), allowMissingColumns=True)


def seeded(name: str, own: Column) -> Column:
    """The carried value on a seed, a row's own value on a row."""
    return F.when(F.col(SEED).isNotNull(), F.col(name)).otherwise(own)


def without_seeds(df: DataFrame, *drop: str) -> DataFrame:
    return df.filter(F.col(SEED).isNull()).drop(SLICE, SEED, *drop)


def rank(base: str, by: Sequence[str], position: str) -> Column:
    """1-based rank in the group, counting on from the seed's ``base``."""
    return F.sum(seeded(base, F.lit(1).cast("bigint"))).over(running(by, position))


def row_numbers(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    *,
    width: int = SLICE_WIDTH,
    slice_by: str | None = None,
    name: str = "row_no",
) -> DataFrame:
    """1-based rank of each row in its group, in order of ``position``.

    ``position`` must be unique within the group.
    """
    sliced = with_slice(df, position, width, slice_by)
    counts = sliced.groupBy(*by, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    bases = counts.select(
        *by, SLICE, F.coalesce(F.sum("_n").over(before(by)), F.lit(0)).alias("_base")
    )
    numbered = with_seeds(sliced, bases).withColumn(name, rank("_base", by, position))
    return without_seeds(numbered, "_base")


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    totals: dict[str, Column],
    *,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Adds a running sum of each expression up to and including the row."""
    sliced = with_slice(df, position, width).withColumns(
        {f"_add_{name}": expr for name, expr in totals.items()}
    )
    added = [f"_add_{name}" for name in totals]
    sums = sliced.groupBy(*by, SLICE).agg(*[F.sum(a).alias(a) for a in added])
    # A seed adds all that came before its slice.
    seeds = sums.select(
        *by, SLICE, *[F.coalesce(F.sum(a).over(before(by)), F.lit(0)).alias(a) for a in added]
    )
    summed = with_seeds(sliced, seeds).withColumns(
        {name: F.sum(f"_add_{name}").over(running(by, position)) for name in totals}
    )
    return without_seeds(summed, *added)


def cut_at_first(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    stop: Column,
    *,
    width: int = SLICE_WIDTH,
    slice_by: str | None = None,
) -> DataFrame:
    """Keeps the rows before the first one where ``stop`` holds, per group."""
    sliced = with_slice(df, position, width, slice_by)
    stops = sliced.groupBy(*by, SLICE).agg(F.min(F.when(stop, F.col(position))).alias("_stop"))
    open_slices = stops.withColumn(
        "_ended", F.coalesce(F.bool_or(F.col("_stop").isNotNull()).over(before(by)), F.lit(False))
    ).filter(~F.col("_ended"))
    # A semi join, which never broadcasts the rows.
    rows, ends = sliced.alias("r"), open_slices.alias("s")
    same = [F.col(f"r.{c}") == F.col(f"s.{c}") for c in (*by, SLICE)]
    early = F.col("s._stop").isNull() | (F.col(f"r.{position}") < F.col("s._stop"))
    return rows.join(ends, [*same, early], "left_semi").drop(SLICE)

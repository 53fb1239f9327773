"""How far each object has been read, and what to read next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.slices import (
    SLICE,
    SLICE_WIDTH,
    before,
    rank,
    row_numbers,
    running,
    with_seeds,
    with_slice,
    without_seeds,
)
from sluice.sinks import store


def record_numbers(
    records: DataFrame,
    *,
    position: str = "position",
    slice_width: int = SLICE_WIDTH,
    slice_by: str | None = None,
) -> DataFrame:
    """Number of each record in its object, from 1."""
    return row_numbers(
        records,
        ["object_key"],
        position,
        width=slice_width,
        slice_by=slice_by,
        name="record_no",
    )


def object_progress(records: DataFrame, *by: str) -> DataFrame:
    """Records per object."""
    return records.groupBy(*by, "object_key").agg(F.count(F.lit(1)).alias("record_count"))


def resume(
    records: DataFrame,
    progress: DataFrame,
    *,
    by: Sequence[str] = ("object_key",),
    position: str = "position",
    slice_width: int = SLICE_WIDTH,
    slice_by: str | None = None,
) -> DataFrame:
    """Records not read yet: those past the stored count of their object.

    ``progress`` has ``by`` and ``record_count``, one row per object. It is
    matched to the slice table, not to the records, so a large object does
    not make one large join key; the records get it by seeds, so no join can
    send them through the driver. Lines read from files have
    ``position="row"`` and ``slice_by="block"``.
    """
    sliced = with_slice(records, position, slice_width, slice_by)
    seeds = (
        sliced.groupBy(*by, SLICE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(before(by)), F.lit(0)))
        .join(progress.select(*by, "record_count"), list(by), "left")
        .select(*by, SLICE, "_base", F.coalesce("record_count", F.lit(0)).alias("_done"))
    )
    numbered = with_seeds(sliced, seeds).withColumns(
        {"record_no": rank("_base", by, position), "_done": F.max("_done").over(running(by, position))}
    )
    return without_seeds(numbered.filter(F.col("record_no") > F.col("_done")), "_base", "_done")


def merge_progress(
    stored: DataFrame,
    updates: DataFrame,
    removed: DataFrame | None = None,
    *,
    by: Sequence[str] = ("bucket", "object_key"),
) -> DataFrame:
    """Stored entries with later ones on top and finished ones taken out.

    ``updates`` carries ``seq``: of several updates of an object the one with
    the greatest ``seq`` holds.
    """
    columns = [*by, "record_count"]
    both = stored.select(*columns, F.lit(None).cast("bigint").alias("seq")).unionByName(
        updates.select(*columns, F.col("seq").cast("bigint"))
    )
    order = F.coalesce("seq", F.lit(-(2**63)).cast("bigint"))
    merged = both.groupBy(*by).agg(F.max_by("record_count", order).alias("record_count"))
    if removed is not None:
        merged = merged.join(removed.select(*by).distinct(), list(by), "left_anti")
    return merged


def load_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest state below ``path``: ``object_key, record_count``; empty at first."""
    newest = _versions(spark, path)
    if not newest:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(f"{path.rstrip('/')}/{_name(newest[-1])}")


def store_progress(progress: DataFrame, path: str) -> None:
    """Writes a new state, and removes all but it and the one before, which readers may still use.

    A state counts once a mark of its own lies beside it, so clusters that
    have Spark write no ``_SUCCESS`` find it too.
    """
    spark = progress.sparkSession
    versions = _versions(spark, path)
    number = (versions or [0])[-1] + 1
    # What a failed attempt has left under that name is replaced.
    state = progress.select("object_key", F.col("record_count").cast("bigint").alias("record_count"))
    state.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_name(number)}")
    root = store.qualified(spark, path).rstrip("/")
    store.write_bytes(f"{root}/{_name(number)}{_WHOLE}", b"")
    for old in versions[:-1]:
        store.remove_tree(f"{root}/{_name(old)}")
        store.remove_tree(f"{root}/{_name(old)}{_WHOLE}")


_STATE = "object_key string, record_count bigint"
_WHOLE = ".whole"


def _name(number: int) -> str:
    return f"state-{number:012d}"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole states, told by the few names right below ``path``."""
    root = store.qualified(spark, path).rstrip("/")
    found = {}
    for name, folder, _, _ in store.children(root, lambda name: name.startswith("state-")):
        number = name.removeprefix("state-").removesuffix(_WHOLE)
        if number.isdigit():
            # Earlier states have Spark's mark alone.
            whole = not folder or store.exists(f"{root}/{name}/_SUCCESS")
            found[int(number)] = found.get(int(number), False) or whole
    return sorted(n for n, whole in found.items() if whole)


def drop_processed(objects: DataFrame, processed: DataFrame) -> DataFrame:
    """Objects that are not among the processed keys."""
    return objects.join(processed.select("object_key").distinct(), "object_key", "left_anti")

"""Objects to records in one call: choose, read, split and name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.hashing import shard_by_object, shard_by_partition
from sluice.functions.naming import match_source_name
from sluice.session import scratch_path
from sluice.sources import progress as prog
from sluice.sources.listing import list_files
from sluice.sources.objects import DEFAULT_CHUNK, match_names, read_objects

DISTRIBUTIONS = ("object_hash", "partition")


def object_filter(
    pattern: str,
    *,
    prefix: str = "",
    after: str | None = None,
    tasks: int = 1,
    task: int | None = None,
    distribution: str = "object_hash",
):
    """Whether an object is read, told from its key alone.

    One Spark job reads for all tasks; with ``task`` it reads the share of
    one, so that several applications can divide the objects among them.
    """
    if distribution not in DISTRIBUTIONS:
        raise ValueError(f"distribution must be one of {DISTRIBUTIONS}, got {distribution!r}")

    def keep(key: Column) -> Column:
        found = match_source_name(key, pattern)
        wanted = found.matches
        if prefix:
            wanted = wanted & key.startswith(prefix)
        if after is not None:
            wanted = wanted & (key > after)
        if task is not None:
            by_name = distribution == "object_hash"
            share = shard_by_object(key, tasks) if by_name else shard_by_partition(found.partition, tasks)
            wanted = wanted & (share == task)
        elif distribution == "partition":
            wanted = wanted & found.partition.isNotNull()
        return wanted

    return keep


def read_records(
    spark: SparkSession,
    root: str,
    pattern: str,
    fmt: str = "bytes",
    *,
    target_topic: str | None = None,
    prefix: str = "",
    after: str | None = None,
    tasks: int = 1,
    task: int | None = None,
    distribution: str = "object_hash",
    compression: str = "none",
    chunk_size: int = DEFAULT_CHUNK,
    on_error: str = "drop",
    tolerance: str | None = None,
    progress: DataFrame | None = None,
    listing: DataFrame | None = None,
    value_schema: str | None = None,
) -> DataFrame:
    """Records of the matching objects below ``root``.

    Columns: ``topic, partition, key`` (the object key in UTF-8), ``value,
    object_key, start_offset``. Parquet and Avro rows are a struct.
    ``tolerance`` (none or all) says in the connector's words what a bad line
    does, in place of ``on_error``: fail, or be left out.
    """
    if tolerance is not None:
        if tolerance not in ("none", "all"):
            raise ValueError("errors tolerance must be none or all")
        on_error = "drop" if tolerance == "all" else "fail"
    keep = object_filter(
        pattern, prefix=prefix, after=after, tasks=tasks, task=task, distribution=distribution
    )
    by_spark = fmt in ("parquet", "avro")
    # Names are taken apart once for each object, where tasks of our own read it.
    tag = None if by_spark else lambda listed: match_names(listed, pattern, target_topic=target_topic)
    read = read_objects(
        spark,
        root,
        fmt,
        compression=compression,
        chunk_size=chunk_size,
        on_error=on_error,
        progress=progress,
        keep=keep,
        listing=listing,
        value_schema=value_schema,
        tag=tag,
    )
    if by_spark:
        fields = [F.col(f"`{c}`") for c in read.columns if c != "object_key"]
        read = match_names(read.select("object_key", F.struct(*fields).alias("value")), pattern, target_topic=target_topic)
    return read.select(
        "topic",
        "partition",
        F.encode("object_key", "UTF-8").alias("key"),
        "value",
        "object_key",
        "start_offset",
    )


def read_new_records(
    spark: SparkSession, root: str, pattern: str, fmt: str = "bytes", *, state: str, **options
) -> tuple[DataFrame, Callable[[], None]]:
    """What the objects have given since the state kept below ``state``.

    Returns the records and a function that stores how far they go, to be
    called when they have been dealt with: until then a new run gives them
    again. ``options`` are those of ``read_records``. Not for Avro.
    """
    done = prog.load_progress(spark, state)
    # Listed once: what arrives later is neither read nor counted now.
    listed = scratch_path(spark, "listed")
    list_files(spark, root).select("object_key", "path", "length").write.parquet(listed)
    found = spark.read.schema("object_key string, path string, length bigint").parquet(listed)
    records = read_records(spark, root, pattern, fmt, progress=done, listing=found, **options)

    def commit() -> None:
        new = prog.object_progress(records).withColumnRenamed("record_count", "more")
        both = done.join(new, "object_key", "full")
        count = F.coalesce("record_count", F.lit(0)) + F.coalesce("more", F.lit(0))
        prog.store_progress(both.select("object_key", count.alias("record_count")), state)

    return records, commit

"""Objects picked up as they arrive, and their records."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from sluice.functions.naming import match_source_name
from sluice.sinks import store
from sluice.sources.connector import object_filter
from sluice.sources.objects import _file_key, clean_lines, is_bad_json
from sluice.sources.compressed import compressed_chunks, compressed_lines
from sluice.sources.streams import lines_between, range_chunks, range_lines, with_done
from sluice.sources.tables import ROW_INDEX, row_groups, rows_of
from sluice.streaming.objects import new_objects


def read_stream(
    spark: SparkSession,
    root: str,
    fmt: str = "bytes",
    *,
    state: str,
    pattern: str | None = None,
    target_topic: str | None = None,
    schema: T.StructType | str | None = None,
    chunk_size: int = 4096,
    compression: str = "none",
    objects_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    glob: str | None = None,
    prefix: str = "",
    after: str | None = None,
    tasks: int = 1,
    task: int | None = None,
    distribution: str = "object_hash",
    forget_after: float | None = None,
) -> DataFrame:
    """Records of new objects below ``root``, with topic and partition by name.

    Objects of any name are found, and read once (``streaming.objects``, which
    also says what ``state`` and ``forget_after`` are). A micro-batch takes
    ``bytes_per_batch`` or ``objects_per_batch`` where one is given, else all
    new objects.

    With a ``pattern``, ``prefix``, ``after`` and the share of one of several
    ``tasks`` choose objects as in ``connector.read_records``.

    Bad JSON lines are left out one by one here: a stream cannot look back
    into an object to cut it at its first bad line, as ``read_objects`` does.
    Parquet objects are read by row groups; columns they lack are null. Avro
    objects are found by Spark's file source, without hidden names or caps.
    """
    if fmt not in ("jsonl", "bytes", "parquet", "avro"):
        raise ValueError(f"unknown input format {fmt!r}")
    if fmt in ("parquet", "avro") and schema is None:
        raise ValueError(f"a {fmt} stream needs a schema")

    def wanted(objects: DataFrame) -> DataFrame:
        if pattern is None:
            return objects
        chosen = {"prefix": prefix, "after": after, "tasks": tasks, "task": task}
        keep = object_filter(pattern, distribution=distribution, **chosen)
        return objects.filter(keep(F.col("object_key")))

    if fmt == "avro":
        rows = spark.readStream.option("recursiveFileLookup", "true").format(fmt).schema(schema).load(root)
        records = wanted(rows.select(_file_key(root).alias("object_key"), F.struct(*rows.columns).alias("value")))
    else:
        caps = {"objects_per_batch": objects_per_batch, "bytes_per_batch": bytes_per_batch}
        found = new_objects(spark, root, state, prefix=prefix, after=after, glob=glob, forget_after=forget_after, **caps)
        records = _records(wanted(found), fmt, schema, chunk_size, compression)
    if pattern is None:
        return records
    found = match_source_name(F.col("object_key"), pattern)
    topic = F.lit(target_topic) if target_topic is not None else found.topic
    return records.filter(found.matches).select(
        "*",
        topic.alias("topic"),
        found.partition.alias("partition"),
        found.offset.alias("start_offset"),
    )


def _records(objects: DataFrame, fmt: str, schema, chunk_size: int, compression: str) -> DataFrame:
    """The records of listed objects; tasks read the objects themselves."""
    if fmt == "jsonl":
        lines = range_lines(objects) if compression == "none" else compressed_lines(objects, compression)
        records = clean_lines(lines.select("object_key", "line")).filter(~is_bad_json(F.col("line")))
        return records.withColumnRenamed("line", "value")
    if fmt == "bytes":
        listed = with_done(objects.drop("modified"))
        return range_chunks(listed, chunk_size) if compression == "none" else compressed_chunks(listed, compression, chunk_size)
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    rows = rows_of(row_groups(objects), kind).drop(ROW_INDEX)
    return rows.select("object_key", F.struct(*[f"`{c}`" for c in kind.names]).alias("value"))


def read_growing(
    spark: SparkSession,
    root: str,
    *,
    state: str,
    prefix: str = "",
    glob: str | None = None,
) -> DataFrame:
    """JSON lines of objects that grow at their end: ``object_key, value``, each record once.

    An object is told again when it is longer. Keyed state has its number of
    records and where they end, and it is read on from there. A last line
    without a newline counts if it is JSON; if not, it is left until it grows.
    Counting reads what is new once more, an object in one task, in bounded
    memory. A shorter object than before gives nothing.
    """
    objects = new_objects(spark, root, state, prefix=prefix, glob=glob, growing=True)
    stretches = objects.groupBy("object_key").applyInPandasWithState(
        _read_on, "object_key string, path string, length bigint, start bigint, end bigint, first_record bigint",
        "records bigint, bytes bigint", "append", "NoTimeout",
    )
    lines = clean_lines(lines_between(stretches).select("object_key", "line"))
    return lines.filter(~is_bad_json(F.col("line"))).withColumnRenamed("line", "value")


def _read_on(key: tuple, told: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The stretch of an object behind what has been read; the state moves to its end."""
    newest = max((row for frame in told for row in zip(frame["length"], frame["path"], strict=True)), default=(0, ""))
    length, path = newest
    records, start = state.get if state.exists else (0, 0)
    n, end = _complete(path, start, length)
    if n:
        state.update((records + n, end))
        names = ["object_key", "path", "length", "start", "end", "first_record"]
        yield pd.DataFrame([(key[0], path, length, start, end, records + 1)], columns=names)


def _complete(path: str, start: int, length: int) -> tuple[int, int]:
    """Lines that are not blank from ``start`` on, and where the last whole one ends."""
    n, end, rest = 0, start, b""
    if length <= start:
        return 0, start
    with store.open_random(path) as source:
        source.seek(start)
        left = length - start
        while left > 0 and (more := source.read(min(left, 1 << 20))):
            left -= len(more)
            *ended, rest = (rest + more).split(b"\n")
            n += sum(1 for line in ended if line.strip())
            end += sum(len(line) + 1 for line in ended)
    if rest.strip():
        try:
            json.loads(rest)
        except ValueError:
            return n, end
        return n + 1, end + len(rest)
    return n, end


def drop_processed_stream(objects: DataFrame, *, forget_after: str, at: str = "modified") -> DataFrame:
    """Objects of a stream whose key has not come before, by keyed state.

    For streams that may tell of an object more than once, such as a store's
    notifications or inventories taken again and again. A key is kept in the
    state store until the newest ``at`` (a timestamp) has passed its own by
    ``forget_after``, such as ``"7 days"``; what is older than that on arrival
    is taken as dealt with. So state is bounded by the keys of that time.
    """
    return objects.withWatermark(at, forget_after).dropDuplicatesWithinWatermark(["object_key"])


def publish_stream(
    records: DataFrame,
    checkpoint: str,
    *,
    servers: str | None = None,
    path: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Sends envelope rows to a log (with Spark's Kafka connector) or a table."""
    if servers:
        writer = records.select(
            "topic",
            "partition",
            F.encode("object_key", "UTF-8").alias("key"),
            F.col("value").cast("binary").alias("value"),
        ).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    elif path:
        writer = records.writeStream.format("parquet").option("path", path)
    else:
        raise ValueError("give servers or a path")
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drain(start: Callable[[], StreamingQuery]) -> int:
    """Runs an ``available_now`` stream until a run finds nothing new; how many runs found something.

    Spark takes one batch of this source in such a run, so capped batches need
    several.
    """
    runs = 0
    while True:
        query = start()
        query.awaitTermination()
        if not any(p["numInputRows"] for p in query.recentProgress):
            return runs
        runs += 1

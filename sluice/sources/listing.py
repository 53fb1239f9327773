"""Listing objects in tasks, every name included.

Spark's own listing runs on the driver and leaves out names that start with
``_`` or ``.``. Here each folder (or store prefix) is listed by a task, level by
level; only the number of folders comes back to the driver. A large flat folder
on a file system is cut into ranges of names, each of them read by a task of its
own, in batches of bounded size. (Stores are listed by one call a prefix, which
gives sizes and times with the names; pyarrow cannot start one after a key.)
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path, ship_package
from sluice.sinks import store

#: Names that one task looks at closely; a folder or range with more is cut further.
RANGE_NAMES = 20_000
BATCH_ROWS = 10_000
_SAMPLE = 4_096
_LEVEL = "path string, after string, upto string"
_FOUND = "path string, folder boolean, length bigint, modified timestamp, after string, upto string, task int"
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("folder", pa.bool_()),
        ("length", pa.int64()),
        ("modified", pa.timestamp("us", "UTC")),
        ("after", pa.string()),
        ("upto", pa.string()),
        ("task", pa.int32()),
    ]
)


def _in_range(name: str, after: str | None, upto: str | None) -> bool:
    return (after is None or name > after) and (upto is None or name <= upto)


def _ranges(names: Iterator[str], after: str | None, upto: str | None, most: int) -> list[tuple[str | None, str | None]]:
    """The range itself if it has at most so many names, else parts of it.

    Cuts come from a sample of fixed size, so memory is bounded; a part that
    turns out too large is cut again.
    """
    rng = random.Random(f"{after}/{upto}")
    sample: list[str] = []
    n = 0
    for name in names:
        n += 1
        if len(sample) < _SAMPLE:
            sample.append(name)
        elif (at := rng.randrange(n)) < _SAMPLE:
            sample[at] = name
    if n <= most:
        return [(after, upto)]
    sample.sort()
    parts = min(-(-2 * n // most), len(sample))
    cuts = sorted({sample[i * len(sample) // parts] for i in range(1, parts)} - {upto})
    return list(zip([after, *cuts], [*cuts, upto], strict=True))


def _batches(rows: Iterator[tuple], task: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append((*row, task))
        if len(held) == BATCH_ROWS:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _lister(most: int):
    def children(path: str, after: str | None, upto: str | None) -> Iterator[tuple]:
        if not store.is_local(path):
            for name, folder, size, modified in store.children(path):
                yield f"{path}/{name}", folder, size, modified, None, None
            return
        parts = _ranges((n for n in store.names(path) if _in_range(n, after, upto)), after, upto, most)
        if len(parts) > 1:
            for low, high in parts:
                yield path, True, None, None, low or "", high
            return
        for name, folder, size, modified in store.children(path, lambda n: _in_range(n, after, upto)):
            if not store.is_checksum(path, name):
                yield f"{path}/{name}", folder, size, modified, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(children(row["path"], row["after"], row["upto"]), task)

    return run


def walk(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, modified`` of all files below ``root``, and the ``task`` of its level that listed each.

    The folders that writers at work have made in the staging folder are no part
    of it, nor are the checksums that Hadoop puts beside local files. Each level
    is written to the shared scratch folder, so a lost executor costs the
    folders it was listing.
    """
    ship_package(spark)
    root = store.qualified(spark, root).rstrip("/")
    level = spark.createDataFrame([(root, None, None)], _LEVEL)
    tasks = spark.sparkContext.defaultParallelism * 4
    levels, folders = [], 1
    staging = f"{root}/{store.STAGING}/"
    in_staging = F.col("path").startswith(staging) & F.substring("path", len(staging) + 1, 2**31 - 1).rlike(store.ATTEMPT)
    while folders:
        out = scratch_path(spark, "listing")
        level.repartition(min(tasks, folders)).mapInArrow(_lister(RANGE_NAMES), _FOUND).write.parquet(out)
        found = spark.read.schema(_FOUND).parquet(out)
        levels.append(found)
        level = found.where(F.col("folder") & ~in_staging).select("path", "after", "upto")
        folders = level.count()
    files = levels[0]
    for more in levels[1:]:
        files = files.unionByName(more)
    return files.where(~F.col("folder")).drop("folder", "after", "upto")


def list_files(
    spark: SparkSession,
    root: str,
    *,
    keep: Callable[[Column], Column] | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Non-empty objects below ``root``: ``object_key, path, length, modified``.

    ``glob`` is matched with the last step of the name: ``*`` and ``?``.
    """
    root = store.qualified(spark, root).rstrip("/")
    key = F.substring("path", F.lit(len(root) + 2), F.lit(2**31 - 1))
    files = walk(spark, root).where("length > 0").select(key.alias("object_key"), "path", "length", "modified")
    if keep:
        files = files.where(keep(F.col("object_key")))
    if glob:
        last = F.element_at(F.split("object_key", "/"), -1)
        files = files.where(last.rlike(as_regex(glob)))
    return files


def as_regex(glob: str) -> str:
    """A glob of plain text, ``*`` and ``?`` as a pattern for the whole text."""
    pieces = {"*": ".*", "?": "."}
    return r"\A" + "".join(pieces.get(c) or f"\\x{{{ord(c):x}}}" for c in glob) + r"\z"


# The names Spark's readers leave out. A step of a path is left out
# if it begins with a dot, ends with the mark of a copy under way, or begins with
# an underscore and has no ``=``; folders named like Parquet's summaries are not.
_LEFT_OUT = r"(_[^/=]*|\.[^/]*|[^/]*\._COPYING_)"
_SUMMARY = r"(?!_metadata|_common_metadata)"


def is_hidden(key: Column) -> Column:
    """Whether Spark's readers would leave the object out."""
    return key.rlike(rf"(\A|/){_SUMMARY}{_LEFT_OUT}/") | key.rlike(rf"(\A|/){_LEFT_OUT}\z")

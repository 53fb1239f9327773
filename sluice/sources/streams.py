"""Objects, read in ranges inside tasks.

Ranges are dealt to the tasks by their bytes. Whatever ``tags`` a listing has,
columns beside key, path and length, every record of the object carries.
"""

from __future__ import annotations

import gzip
import io
import itertools
import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from sluice.session import ship_package

_LINES = "block bigint, row bigint, line string"
_CHUNKS = "record_no bigint, value binary"
BATCH_ROWS = 4096
# Rows per block of a compressed object, and bytes per range of a plain one.
BLOCK_ROWS = 1 << 18
RANGE_BYTES = 32 << 20
# The magic bytes and header length of a framed snappy stream.
SNAPPY_MAGIC = b"\x82SNAPPY\x00"
SNAPPY_HEADER = SNAPPY_MAGIC + struct.pack(">ii", 1, 1)


class SnappyFrames(io.RawIOBase):
    """Blocks of a framed snappy stream; streams may follow each other."""

    def __init__(self, source):
        self._source = source
        self._codec = pa.Codec("snappy")
        self._ready = b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self._ready:
            head = self._exactly(4, may_end=True)
            if not head:
                return 0
            if head == SNAPPY_MAGIC[:4]:
                self._exactly(len(SNAPPY_HEADER) - 4)
                continue
            block = self._exactly(struct.unpack(">i", head)[0])
            self._ready = self._codec.decompress(
                block, decompressed_size=_snappy_size(block), asbytes=True
            )
        n = min(len(into), len(self._ready))
        into[:n], self._ready = self._ready[:n], self._ready[n:]
        return n

    def _exactly(self, n: int, may_end: bool = False) -> bytes:
        data = b""
        while len(data) < n:
            more = self._source.read(n - len(data))
            if not more:
                if may_end and not data:
                    return b""
                raise EOFError("snappy stream ends inside a block")
            data += more
        return data


def _snappy_size(block: bytes) -> int:
    """Uncompressed length: the varint a raw snappy block starts with."""
    size = shift = 0
    for byte in block:
        size |= (byte & 0x7F) << shift
        if byte < 0x80:
            return size
        shift += 7
    raise EOFError("snappy block without a length")


def decompressed(raw, compression: str):
    """A reader of the plain bytes of an open object."""
    if compression == "none":
        return raw
    if compression == "gzip":
        return gzip.GzipFile(fileobj=raw, mode="rb")
    if compression == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
    if compression == "snappy":
        return io.BufferedReader(SnappyFrames(raw), 1 << 16)
    raise ValueError(f"unknown compression {compression!r}")


def with_done(listed: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    """Adds the number of records each object has already given."""
    if progress is None:
        return listed.withColumn("done", F.lit(0).cast("bigint"))
    return (
        listed.join(progress.select("object_key", "record_count"), "object_key", "left")
        .withColumn("done", F.coalesce("record_count", F.lit(0)).cast("bigint"))
        .drop("record_count")
    )


#: Groups that the running sums of bytes are worked out in; one row of each is broadcast.
_SUM_GROUPS = 1024


def dealt_by_bytes(ranges: DataFrame, size: str, *place: str, tasks: int | None = None) -> DataFrame:
    """The ranges in tasks of equal shares of all bytes, whichever objects they are of.

    ``place`` names a range, ``size`` its bytes. The ranges are put in a row by
    running sums and the row is cut into equal lengths, so a task has at most
    its share and one range. Groups of ranges are summed first, so no task sees
    them all. A stream, which has no sums, is dealt by the hash of ``place``.
    """
    ship_package(ranges.sparkSession)
    n = tasks or ranges.sparkSession.sparkContext.defaultParallelism * 4
    if ranges.isStreaming:
        return ranges.repartition(n, *place)
    grouped = ranges.withColumn("_group", F.pmod(F.xxhash64(*place), F.lit(_SUM_GROUPS)))
    sums = grouped.groupBy("_group").agg(F.sum(size).alias("_sum"))
    row = W.partitionBy(F.lit(0)).orderBy("_group")
    earlier = F.sum("_sum").over(row.rowsBetween(W.unboundedPreceding, -1))
    bases = sums.select(
        "_group", F.coalesce(earlier, F.lit(0)).alias("_base"), F.sum("_sum").over(W.partitionBy(F.lit(0))).alias("_all")
    )
    inside = W.partitionBy("_group").orderBy(*place).rowsBetween(W.unboundedPreceding, -1)
    at = F.col("_base") + F.coalesce(F.sum(size).over(inside), F.lit(0))
    share = F.least(F.floor(at / F.col("_all") * n), F.lit(n - 1)).cast("int")
    placed = grouped.join(F.broadcast(bases), "_group", "left").withColumn("_task", F.coalesce(share, F.lit(0)))
    return placed.repartitionById(n, "_task").drop("_group", "_base", "_all", "_task")


def record_schema(listed: DataFrame, tags: Sequence[str], columns: str) -> StructType:
    """Of records with the key and the tags of their object."""
    head = [StructField(c, listed.schema[c].dataType) for c in ("object_key", *tags)]
    return StructType([*head, *StructType.fromDDL(columns).fields])


def batch_of(row: dict, schema: pa.Schema, /, **columns: list) -> pa.RecordBatch:
    """Columns of records beside the key and tags of their object."""
    n = len(next(iter(columns.values())))
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.repeat(pa.scalar(row[f.name], f.type), n) for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def range_chunks(listed: DataFrame, chunk_size: int, tags: Sequence[str] = ()) -> DataFrame:
    """Fixed-size chunks of plain objects (``object_key, path, length, done``).

    An object is cut into ranges of whole chunks, so a large one is read by
    many tasks and never held as one value. Reading starts behind the chunks
    already done.
    """
    if chunk_size < 1:
        raise ValueError("chunk size must be at least 1")
    per_range = max(1, RANGE_BYTES // chunk_size) * chunk_size
    begin = F.col("done") * chunk_size
    starts = F.sequence(begin, F.col("length") - 1, F.lit(per_range).cast("bigint"))
    ranges = (
        listed.filter(begin < F.col("length"))
        .select("object_key", "path", *tags, "length", F.explode(starts).alias("start"))
        .withColumn("bytes", F.least(F.col("length") - F.col("start"), F.lit(per_range)))
    )
    schema = record_schema(listed, tags, _CHUNKS)
    arrow = to_arrow_schema(schema)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sluice.sinks.store import open_random

        for batch in batches:
            for row in batch.to_pylist():
                with open_random(row["path"]) as source:
                    source.seek(row["start"])
                    first = row["start"] // chunk_size + 1
                    yield from chunk_batches(row, arrow, source, chunk_size, first, per_range // chunk_size)

    return dealt_by_bytes(ranges, "bytes", "path", "start").mapInArrow(chunks, schema)


def chunk_batches(
    row: dict, schema: pa.Schema, source, size: int, first: int, limit: int | None
) -> Iterator[pa.RecordBatch]:
    """Chunks from where ``source`` stands, a few megabytes to a batch."""
    per_batch = max(1, (4 << 20) // size)
    number = first
    while limit is None or number < first + limit:
        room = per_batch if limit is None else min(per_batch, first + limit - number)
        held: list[bytes] = []
        while len(held) < room and (data := _fill(source, size)):
            held.append(data)
        if held:
            yield batch_of(row, schema, record_no=list(range(number, number + len(held))), value=held)
        number += len(held)
        if len(held) < room:
            return


def _fill(source, size: int) -> bytes:
    data = b""
    while len(data) < size and (more := source.read(size - len(data))):
        data += more
    return data


def range_lines(listed: DataFrame, tags: Sequence[str] = ()) -> DataFrame:
    """Lines of listed plain objects, read in ranges.

    A line belongs to the range its first byte is in.
    """
    whole = listed.filter("length > 0").withColumn("start", F.lit(0).cast("bigint"))
    return lines_between(whole.withColumn("end", F.lit(2**62).cast("bigint")), tags)


def lines_between(stretches: DataFrame, tags: Sequence[str] = ()) -> DataFrame:
    """Lines that begin from ``start`` to before ``end`` of plain objects (with ``path, length``)."""
    last = F.least(F.col("length"), F.col("end")) - 1
    starts = F.sequence(F.col("start"), last, F.lit(RANGE_BYTES).cast("bigint"))
    ranges = (
        stretches.filter(F.col("start") <= last)
        .select("object_key", "path", *tags, "length", F.explode(starts).alias("start"), "end")
        .withColumn("bytes", F.least(last + 1 - F.col("start"), F.lit(RANGE_BYTES)))
    )
    width = RANGE_BYTES
    schema = record_schema(stretches, tags, _LINES)
    arrow = to_arrow_schema(schema)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sluice.sinks.store import open_random

        for batch in batches:
            for row in batch.to_pylist():
                with open_random(row["path"]) as source:
                    found = _lines_from(source, row["start"], min(row["start"] + width, row["end"]))
                    yield from line_batches(row, arrow, found, row["start"])

    return dealt_by_bytes(ranges, "bytes", "path", "start").mapInArrow(lines, schema)


def _lines_from(source, start: int, end: int) -> Iterator[str]:
    """Lines that begin in a range of bytes, the last one read to its end."""
    # From the byte before, so that a line that begins at the start is seen whole.
    at = max(start - 1, 0)
    source.seek(at)
    partial, rest = start > 0, b""
    while True:
        more = source.read(1 << 20)
        *ended, rest = (rest + more).split(b"\n")
        if not more and rest:
            ended.append(rest)
        for line in ended:
            if partial:
                partial = False
            elif at < end:
                yield from line.decode("utf-8", "replace").removesuffix("\r").split("\r")
            else:
                return
            at += len(line) + 1
        if not more or (not partial and at >= end):
            return


def line_batches(
    row: dict, schema: pa.Schema, lines: Iterator[str], block: int, block_rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Lines with their place: the block, or with ``block_rows`` those that follow it, and a number."""
    first = 0
    while held := list(itertools.islice(lines, BATCH_ROWS)):
        numbers = range(first, first + len(held))
        blocks = [block + i // block_rows if block_rows else block for i in numbers]
        yield batch_of(row, schema, block=blocks, row=list(numbers), line=held)
        first += len(held)


def discard(source, n: int) -> None:
    while n > 0 and (data := source.read(min(n, 1 << 20))):
        n -= len(data)

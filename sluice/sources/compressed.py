"""Compressed objects, read by many tasks where they are made of many streams.

Streams of a codec may follow each other in an object; so the writer here puts
large objects together. Where they begin is not written anywhere, so for large
objects it is worked out first, as an index:

1. ranges of raw bytes are searched for what a stream can begin with;
2. each such place is read as a stream in a task of its own, to see whether it
   is one, where it ends, how many plain bytes it has and how they end;
3. an object's places are walked in order: a stream begins where the one before
   ended. What merely looks like a stream inside of another is left out.

Then ranges of whole streams are read, each from its first line or chunk that
begins in it. The first pass decompresses everything once more, which is the
price of reading in parallel; an object of one stream is one range.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.session import scratch_path
from sluice.sources import streams
from sluice.sources.streams import SNAPPY_HEADER, SNAPPY_MAGIC

# What streams begin with. Flags of gzip above 0x1f are reserved.
_BEGINS = {
    "gzip": re.compile(rb"\x1f\x8b\x08[\x00-\x1f]", re.DOTALL),
    "zstd": re.compile(rb"\x28\xb5\x2f\xfd", re.DOTALL),
    "snappy": re.compile(re.escape(SNAPPY_HEADER), re.DOTALL),
}
_LONGEST = len(SNAPPY_HEADER)
_INDEX = "start bigint, `end` bigint, plain bigint, plain_end bigint, clean boolean"


class Section(io.RawIOBase):
    """The bytes of an open object from ``start`` to before ``end``."""

    def __init__(self, source, start: int, end: int):
        source.seek(start)
        self._source, self._left = source, end - start

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self._source.read(min(len(into), self._left))
        into[: len(data)] = data
        self._left -= len(data)
        return len(data)


def plain_reader(source, compression: str, start: int, end: int) -> io.BufferedReader:
    """The plain bytes of the streams between two places."""
    section = io.BufferedReader(Section(source, start, end), 1 << 20)
    return io.BufferedReader(streams.decompressed(section, compression), 1 << 20)


def _begins(source, compression: str, start: int, end: int) -> Iterator[int]:
    """Places from ``start`` to before ``end`` where a stream may begin."""
    source.seek(start)
    at, held = start, b""
    while at < end:
        more = source.read(1 << 20)
        held += more
        # What begins in the last bytes is looked for when the next are there.
        sure = len(held) - _LONGEST + 1 if more else len(held)
        for found in _BEGINS[compression].finditer(held):
            if found.start() < min(sure, end - at):
                yield at + found.start()
        if not more:
            return
        if sure > 0:
            at, held = at + sure, held[sure:]


def _stream(source, compression: str, start: int) -> tuple[int, int, bool] | None:
    """``(end, plain bytes, whether they end a line)`` of the stream at a place, or None if it is none."""
    source.seek(start)
    if compression == "snappy":
        return _snappy_stream(source, start)
    import zstandard

    one = zlib.decompressobj(31) if compression == "gzip" else zstandard.ZstdDecompressor().decompressobj()
    at, n, last = start, 0, b""
    try:
        while not one.eof:
            data = source.read(1 << 14)
            if not data:
                return None
            at += len(data)
            plain = one.decompress(data)
            n, last = n + len(plain), plain[-1:] or last
    except (zlib.error, zstandard.ZstdError):
        return None
    end = at - len(one.unused_data)
    if compression == "gzip":  # zeros may follow a stream
        source.seek(end)
        while data := source.read(1 << 14):
            end += len(data) - len(data.lstrip(b"\0"))
            if data.strip(b"\0"):
                break
    return end, n, last == b"\n"


def _snappy_stream(source, start: int) -> tuple[int, int, bool] | None:
    source.seek(start + len(SNAPPY_HEADER))
    at, n, last = start + len(SNAPPY_HEADER), 0, b""
    while (head := source.read(4)) and head != SNAPPY_MAGIC[:4]:
        if len(head) < 4 or (size := struct.unpack(">i", head)[0]) < 1:
            return None
        block = source.read(size)
        if len(block) < size:
            return None
        at, n, last = at + 4 + size, n + streams._snappy_size(block), block
    plain = pa.Codec("snappy").decompress(last, decompressed_size=streams._snappy_size(last), asbytes=True) if last else b""
    return at, n, plain.endswith(b"\n")


class _Walk:
    """Ranges of whole streams of one object, from its places in order."""

    def __init__(self, row: dict, width: int):
        self.row, self.width = row, width
        self.at = 0  # where the next stream must begin
        self.plain, self.clean = 0, True
        self.open = (0, 0, True)

    def step(self, row: dict) -> Iterator[dict]:
        if row["start"] != self.at or row["end"] is None:
            return
        if row["start"] - self.open[0] >= self.width:
            yield self._range(row["start"], self.plain)
            self.open = (row["start"], self.plain, self.clean)
        self.at, self.plain = row["end"], self.plain + row["n"]
        self.clean = row["line"] if row["n"] else self.clean

    def finish(self) -> dict:
        """The last range goes to the end, past what could not be walked, whose reader tells why."""
        return self._range(self.row["length"], None)

    def _range(self, end: int, plain_end: int | None) -> dict:
        start, plain, clean = self.open
        return self.row | {"start": start, "end": end, "plain": plain, "plain_end": plain_end, "clean": clean}


def stream_ranges(listed: DataFrame, compression: str, tags: Sequence[str] = ()) -> DataFrame:
    """Ranges of about ``RANGE_BYTES`` of whole streams of the listed objects.

    Columns: those of the listing, ``start`` and ``end``, the plain bytes before
    ``start`` and before ``end`` (null in the last range) and whether the range
    begins with a line (``clean``). Worked out once, as a table.
    """
    from sluice.sinks.store import open_random

    spark = listed.sparkSession
    width = streams.RANGE_BYTES
    own = [c for c in ("object_key", "path", "length", *tags, "done") if c in listed.columns]
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(width).cast("bigint"))
    raw = listed.select(*own, F.explode(starts).alias("start"))
    raw = raw.withColumn("bytes", F.least(F.col("length") - F.col("start"), F.lit(width)))
    placed = streams.record_schema(listed, own[1:], "start bigint")
    told = streams.record_schema(listed, own[1:], "start bigint, `end` bigint, n bigint, line boolean")
    ranges = streams.record_schema(listed, own[1:], _INDEX)
    arrow = {name: to_arrow_schema(schema) for name, schema in (("placed", placed), ("told", told), ("ranges", ranges))}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_random(row["path"]) as source:
                    found = list(_begins(source, compression, row["start"], row["start"] + row["bytes"]))
                yield streams.batch_of(row, arrow["placed"], start=found)

    def try_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                with open_random(row["path"]) as source:
                    found = _stream(source, compression, row["start"]) or (None, None, None)
                row |= dict(zip(("end", "n", "line"), found, strict=True))
            yield pa.RecordBatch.from_pylist(rows, schema=arrow["told"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Walk | None = None
        for batch in batches:
            done: list[dict] = []
            for row in batch.to_pylist():
                if now is None or now.row["object_key"] != row["object_key"]:
                    done += [now.finish()] if now else []
                    now = _Walk({c: row[c] for c in own}, width)
                done += now.step(row)
            yield pa.RecordBatch.from_pylist(done, schema=arrow["ranges"])
        if now:
            yield pa.RecordBatch.from_pylist([now.finish()], schema=arrow["ranges"])

    searched = scratch_path(spark, "stream-starts")
    # An object is walked from its beginning, whether a stream is found there or not.
    found = streams.dealt_by_bytes(raw, "bytes", "path", "start").mapInArrow(search, placed)
    found.unionByName(listed.select(*own, F.lit(0).cast("bigint").alias("start"))).distinct().write.parquet(searched)
    tasks = spark.sparkContext.defaultParallelism * 4
    tried = spark.read.schema(placed).parquet(searched).repartition(tasks, "path", "start").mapInArrow(try_each, told)
    walked = tried.repartition("object_key").sortWithinPartitions("object_key", "start").mapInArrow(walk, ranges)
    path = scratch_path(spark, "stream-ranges")
    walked.write.parquet(path)
    return spark.read.schema(ranges).parquet(path)


def _ranges(listed: DataFrame, compression: str, tags: Sequence[str]) -> DataFrame:
    """What tasks read: small objects whole, large ones in ranges of whole streams."""
    listed = listed.filter("length > 0")
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    whole = {"start": zero, "end": F.col("length"), "plain": zero, "plain_end": nothing, "clean": F.lit(True)}
    small = listed.withColumns(whole)
    if not listed.isStreaming and compression in _BEGINS:
        large = listed.filter(F.col("length") > streams.RANGE_BYTES)
        if not large.isEmpty():
            ranges = stream_ranges(large, compression, tags)
            small = small.filter(F.col("length") <= streams.RANGE_BYTES).select(ranges.columns).unionByName(ranges)
    return streams.dealt_by_bytes(small.withColumn("bytes", F.col("end") - F.col("start")), "bytes", "path", "start")


def _own_lines(plain: io.BufferedReader, at: int, end: int | None, clean: bool) -> Iterator[str]:
    """Lines that begin before ``end``; where the range is not ``clean`` the first is another's."""
    for line in plain:
        if clean:
            yield from line.decode("utf-8", "replace").removesuffix("\n").removesuffix("\r").split("\r")
        clean = True
        at += len(line)
        if end is not None and at >= end:
            return


def compressed_lines(listed: DataFrame, compression: str, tags: Sequence[str] = ()) -> DataFrame:
    """Lines of listed objects; ``block`` and ``row`` are the same in every scan."""
    schema = streams.record_schema(listed, tags, streams._LINES)
    arrow, block_rows = to_arrow_schema(schema), streams.BLOCK_ROWS

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sluice.sinks.store import open_random

        for batch in batches:
            for row in batch.to_pylist():
                with open_random(row["path"]) as source, plain_reader(source, compression, row["start"], row["length"]) as plain:
                    found = _own_lines(plain, row["plain"], row["plain_end"], row["clean"])
                    # So many rows take more than a byte in any codec: blocks of ranges do not meet.
                    yield from streams.line_batches(row, arrow, found, row["start"], block_rows)

    return _ranges(listed, compression, tags).mapInArrow(lines, schema)


def compressed_chunks(listed: DataFrame, compression: str, chunk_size: int, tags: Sequence[str] = ()) -> DataFrame:
    """Chunks of the plain bytes of listed objects, behind those already done."""
    if chunk_size < 1:
        raise ValueError("chunk size must be at least 1")
    schema = streams.record_schema(listed, tags, streams._CHUNKS)
    arrow = to_arrow_schema(schema)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sluice.sinks.store import open_random

        for batch in batches:
            for row in batch.to_pylist():
                first = max(-(-row["plain"] // chunk_size), row["done"])
                limit = None if row["plain_end"] is None else -(-row["plain_end"] // chunk_size) - first
                if limit is not None and limit < 1:
                    continue
                with open_random(row["path"]) as source, plain_reader(source, compression, row["start"], row["length"]) as plain:
                    streams.discard(plain, first * chunk_size - row["plain"])
                    yield from streams.chunk_batches(row, arrow, plain, chunk_size, first + 1, limit)

    return _ranges(listed, compression, tags).mapInArrow(chunks, schema)

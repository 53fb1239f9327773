"""Writing each file group to the object its template names.

Three Spark jobs, none of which sends data or names through the driver:

1. *stage*: records are shuffled by (file, part) and written as pieces below
   ``_staging``. A part is a stretch of offsets, so a file of any size is
   spread over many tasks. Each attempt writes under a name of its own.
2. *manifest*: one row per piece, written as a table. Only pieces of
   successful attempts are in it.
3. *publish*: a file of one piece is moved into place; the pieces of a larger
   one are first put together below staging, each copied to its byte position by
   its own task, and the whole is moved. Stores without positional writes, and
   Parquet, whose one footer needs one writer, get one task per large file,
   which streams it in bounded memory.

Nothing appears under its final name before it is whole, and names follow from
the data, so a repeated flush puts the same objects in place. Staging goes when
the flush ends, well or not.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.formats import csv_line, envelope_columns, json_line, unwrap
from sluice.session import scratch_path, ship_package
from sluice.sinks import store
from sluice.sinks.codecs import CODECS, Encoder, encode
from sluice.sinks.store import STAGING

OUTPUT_FORMATS = ("csv", "json", "jsonl", "parquet")
# Offsets per part of a file that is shuffled for writing.
PART_OFFSETS = 1 << 18
# Bytes of records, as Arrow has them, per Parquet row group.
ROW_GROUP_BYTES = 64 << 20
# What stands before, between and after the records of a file.
FRAMES = {
    "csv": (b"", b"\n", b""),
    "jsonl": (b"", b"\n", b""),
    "json": (b"[\n", b",\n", b"\n]"),
}
FRAMELESS = (b"", b"", b"")
PIECE = (
    "file_name string, first bigint, last bigint, piece string, head bigint, size bigint,"
    " tail bigint, n_records bigint, schema_low bigint, schema_high bigint"
)
# What a record's schemas are, as one number, where a writer is to guard them.
_SCHEMA = "_schema"


def write_files(
    grouped: DataFrame,
    path: str,
    fmt: str = "csv",
    *,
    fields: Sequence[str] = ("value",),
    envelope: bool = True,
    compression: str = "none",
    value_encoding: str = "base64",
    map_keys: Sequence[str] = (),
    versions: Mapping[int, Sequence[str]] | None = None,
    part_offsets: int = PART_OFFSETS,
    placed: int = 0,
    guard: bool = False,
    staging: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Writes every file of ``grouped`` below ``path``; returns what was written.

    ``grouped`` is one flush. The result has ``file_name, n_records, n_bytes,
    n_parts``, read from the manifest in the shared scratch folder. A path
    without a scheme is on Spark's default file system.

    Parquet files of unwrapped values have columns of their own. With
    ``versions`` (the value's fields by ``value_schema_id``) a file has the
    fields of its version; a map value without ``map_keys`` gives a file the
    keys of its first record. A record that does not fit its file fails.

    ``placed`` says that the tasks of ``grouped`` already hold every stretch
    of so many offsets of a file in order, as ``grouping.placed_width`` tells
    of a grouping; the records are then not shuffled again. An order that
    does not hold fails the job.

    ``guard`` makes a file whose records differ in ``key_schema_id``, in
    ``value_schema_id`` or, where headers are written, in having any, fail the
    flush before anything is published.
    """
    spark = grouped.sparkSession
    path = store.qualified(spark, path)
    staging = store.qualified(spark, staging) if staging else staging_path(path)
    listed = scratch_path(spark, "manifest")
    try:
        how = {"fields": fields, "envelope": envelope, "compression": compression, "value_encoding": value_encoding}
        own = {"map_keys": map_keys, "versions": versions, "part_offsets": part_offsets, "placed": placed, "options": options, "guard": guard}
        manifest = stage_files(grouped, staging, listed, fmt, **how, **own)
        publish_files(manifest, path, staging, fmt, compression=compression, options=options)
    finally:
        store.remove_tree(staging)
        store.remove_if_empty(f"{path.rstrip('/')}/{STAGING}")
    return written(manifest)


def written(manifest: DataFrame) -> DataFrame:
    """Per file of a manifest: ``file_name, n_records, n_bytes, n_parts``."""
    return manifest.groupBy("file_name").agg(
        F.sum("n_records").alias("n_records"),
        F.sum("size").alias("n_bytes"),
        F.count(F.lit(1)).cast("bigint").alias("n_parts"),
    )


def stage_files(
    grouped: DataFrame,
    staging: str,
    listed: str,
    fmt: str = "csv",
    *,
    fields: Sequence[str] = ("value",),
    envelope: bool = True,
    compression: str = "none",
    value_encoding: str = "base64",
    map_keys: Sequence[str] = (),
    versions: Mapping[int, Sequence[str]] | None = None,
    part_offsets: int = PART_OFFSETS,
    placed: int = 0,
    guard: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Writes the records as pieces below ``staging`` and their manifest to ``listed``, which it returns.

    Arguments are those of :func:`write_files`.
    """
    if fmt not in OUTPUT_FORMATS:
        raise ValueError(f"output format must be one of {OUTPUT_FORMATS}, got {fmt!r}")
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}, got {compression!r}")
    spark = grouped.sparkSession
    ship_package(spark)
    part = F.call_function("div", F.col("offset"), F.lit(placed or part_offsets)).alias("part")
    place = ["file_name", "part", "offset"]
    schemas = [_schema_number(grouped, fields).alias(_SCHEMA)] if guard else []

    if fmt in FRAMES:
        rows = grouped.select(
            "file_name",
            part,
            "offset",
            *schemas,
            _payload(grouped, fmt, fields, envelope, value_encoding).alias("payload"),
        )
        stage = _text_stage(staging, FRAMES[fmt], compression)
    elif not envelope and (own := _own_fields(grouped, part, fields, map_keys, versions)) is not None:
        at, value = F.col("offset").alias("_at"), F.col(fields[0]).alias("_value")
        rows = own.select("file_name", part, at, *schemas, "_fields", value)
        place = ["file_name", "part", "_at"]
        stage = _fields_stage(staging, {"compression": compression, **(options or {})})
        placed = placed if versions else 0  # a join has found the keys
    else:
        keyed = grouped.select("*", *schemas).withColumn("_part", part).withColumn("_at", F.col("offset"))
        columns = _columns(keyed, fields, envelope, map_keys, ["file_name", "_part", "_at", *([_SCHEMA] if guard else [])])
        rows = columns.withColumnsRenamed({"_part": "part"})
        place = ["file_name", "part", "_at"]
        stage = _parquet_stage(staging, {"compression": compression, **(options or {})})
    if not placed:
        rows = rows.repartition("file_name", "part").sortWithinPartitions(*place)
    rows.mapInArrow(stage, PIECE).write.mode("overwrite").parquet(listed)
    return spark.read.schema(PIECE).parquet(listed)


def publish_files(
    manifest: DataFrame,
    path: str,
    staging: str,
    fmt: str,
    *,
    compression: str = "none",
    options: dict[str, str] | None = None,
) -> None:
    """Puts the staged pieces of a manifest in their places below ``path``."""
    ship_package(manifest.sparkSession)
    ends = manifest.groupBy("file_name").agg(F.min("schema_low").alias("low"), F.max("schema_high").alias("high"))
    mixed = ends.where("low <> high").limit(3).collect()
    if mixed:
        raise ValueError(f"the schema changes inside {', '.join(r['file_name'] for r in mixed)}; nothing is published")
    if fmt == "parquet":
        merge = _merger(path, staging, {"compression": compression, **(options or {})})
        _run(_in_order(manifest), merge, "file_name", "number")
    else:
        publish(manifest, path, staging, FRAMES.get(fmt, FRAMELESS), compression)


def staging_path(path: str) -> str:
    return f"{path.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"


def _schema_number(grouped: DataFrame, fields: Sequence[str]) -> Column:
    ids = [F.col(c) for c in ("key_schema_id", "value_schema_id") if c in grouped.columns]
    if "headers" in fields:
        ids.append(F.coalesce(F.size("headers"), F.lit(0)) > 0)
    # A null is a schema of its own.
    return F.xxhash64(F.lit(0), *[x for c in ids for x in (c.isNull(), c)])


def _own_fields(
    grouped: DataFrame,
    part: Column,
    fields: Sequence[str],
    map_keys: Sequence[str],
    versions: Mapping[int, Sequence[str]] | None,
) -> DataFrame | None:
    """The records with ``_fields``, the columns of their file; None if all have the same."""
    kind = grouped.schema[fields[0]].dataType if fields[0] in grouped.columns else None
    if versions is not None and isinstance(kind, T.StructType):
        known = F.create_map(*[F.lit(x) for v, names in versions.items() for x in (v, list(names))])
        unknown = F.raise_error(F.concat(F.lit("no fields for schema "), F.col("value_schema_id").cast("string")))
        names = F.coalesce(known[F.col("value_schema_id")], unknown.cast("array<string>"))
        return grouped.withColumn("_fields", names)
    if isinstance(kind, T.MapType) and not map_keys:
        # The first record of the file has them. They reach its records by part, so no join key is larger.
        by = ["file_name", "_own_part"]
        parts = grouped.withColumn("_own_part", part)
        heads = parts.groupBy(*by).agg(F.min_by(F.map_keys(fields[0]), "offset").alias("_names"), F.min("offset").alias("_first"))
        names = F.min_by("_names", "_first").over(W.partitionBy("file_name"))
        firsts = heads.select(*by, F.coalesce(names, F.array().cast("array<string>")).alias("_fields"))
        return parts.join(firsts, by).drop("_own_part")
    return None


def _payload(
    df: DataFrame, fmt: str, fields: Sequence[str], envelope: bool, value_encoding: str
) -> Column:
    if fmt == "csv":
        return csv_line(df, fields, value_encoding=value_encoding)
    return json_line(fields, envelope=envelope)


def _columns(
    df: DataFrame,
    fields: Sequence[str],
    envelope: bool,
    map_keys: Sequence[str],
    keep: Sequence[str],
) -> DataFrame:
    if envelope:
        return envelope_columns(df, fields, *keep)
    return unwrap(df, fields[0], *keep, map_keys=map_keys)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, part, start, end) of the stretches of equal file and part."""
    n = batch.num_rows
    if not n:
        return
    names, parts = batch["file_name"], batch["part"]
    change = pc.or_(
        pc.not_equal(names.slice(1), names.slice(0, n - 1)),
        pc.not_equal(parts.slice(1), parts.slice(0, n - 1)),
    )
    starts = [0, *[i + 1 for i in pc.indices_nonzero(change).to_pylist()], n]
    for start, end in zip(starts, starts[1:]):
        yield names[start].as_py(), parts[start].as_py(), start, end


def _pieces(batches, start_piece) -> Iterator[pa.RecordBatch]:
    """Drives writers over ordered batches: one piece per stretch of a file."""
    current, writer, done = None, None, []
    try:
        for batch in batches:
            for name, part, start, end in _runs(batch):
                if (name, part) != current:
                    if writer:
                        done.append(writer.close())
                        writer = None
                    current, writer = (name, part), start_piece(name)
                writer.take(batch.slice(start, end - start))
            if len(done) >= 1024:
                yield _piece_batch(done)
                done = []
        if writer:
            done.append(writer.close())
            writer = None
    finally:
        if writer:
            writer.abandon()
    if done:
        yield _piece_batch(done)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    number = pa.int64()
    fields = {
        "file_name": pa.string(),
        "first": number,
        "last": number,
        "piece": pa.string(),
        "head": number,
        "size": number,
        "tail": number,
        "n_records": number,
        "schema_low": number,
        "schema_high": number,
    }
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), fields.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(fields))


class Piece:
    """An open piece below the staging folder, named for this attempt only."""

    at = "offset"

    def __init__(self, staging: str, name: str):
        self.name, self.n = name, 0
        self.first = self.last = None
        self.schemas: tuple[int, int] | None = None
        self.path = f"{staging}/pieces/{uuid.uuid4().hex}"
        self.out = store.open_output(self.path)

    def take(self, batch: pa.RecordBatch) -> None:
        offsets = batch[self.at].to_numpy()
        if (offsets[1:] <= offsets[:-1]).any() or (self.n and offsets[0] <= self.last):
            raise ValueError(f"offsets of {self.name} do not rise")
        if self.first is None:
            self.first = int(offsets[0])
        self.last = int(offsets[-1])
        if _SCHEMA in batch.schema.names:
            seen = pc.min_max(batch[_SCHEMA]).as_py()
            low, high = self.schemas or (seen["min"], seen["max"])
            self.schemas = (min(low, seen["min"]), max(high, seen["max"]))
            batch = batch.drop_columns([_SCHEMA])
        self.add(batch)
        self.n += batch.num_rows

    def row(self, head: int, size: int, tail: int) -> tuple:
        return (self.name, self.first, self.last, self.path, head, size, tail, self.n, *(self.schemas or (None, None)))

    def abandon(self) -> None:
        self.out.close()


class TextPiece(Piece):
    """Head, records with separators between them, tail: each its own stream."""

    def __init__(self, staging, name, frame, compression):
        super().__init__(staging, name)
        before, self._between, self._after = frame
        self._compression = compression
        self._head = encode(before, compression)
        self.out.write(self._head)
        self._body = Encoder(self.out, compression)

    def add(self, batch: pa.RecordBatch) -> None:
        lines = batch["payload"].cast(pa.large_binary())
        one = pa.LargeListArray.from_arrays(pa.array([0, len(lines)], pa.int64()), lines)
        text = pc.binary_join(one, pa.scalar(self._between, pa.large_binary()))[0]
        if self.n:
            self._body.feed(self._between)
        self._body.feed(text.as_py())

    def close(self) -> tuple:
        body = self._body.finish()
        tail = encode(self._after, self._compression)
        self.out.write(tail)
        self.out.close()
        return self.row(len(self._head), len(self._head) + body + len(tail), len(tail))


class RowGroups:
    """A Parquet writer that gathers rows into row groups by bytes."""

    def __init__(self, out, schema: pa.Schema, options: dict):
        options = dict(options)
        self._target = options.pop("row_group_bytes", ROW_GROUP_BYTES)
        self._writer = pq.ParquetWriter(out, schema, **options)
        self._held: list[pa.Table] = []
        self._bytes = 0

    def add(self, rows: pa.Table) -> None:
        self._held.append(rows)
        self._bytes += rows.nbytes
        if self._bytes >= self._target:
            self._flush()

    def _flush(self) -> None:
        if self._held:
            rows = pa.concat_tables(self._held)
            self._writer.write_table(rows, row_group_size=max(1, rows.num_rows))
            self._held, self._bytes = [], 0

    def close(self) -> None:
        self._flush()
        self._writer.close()


class ParquetPiece(Piece):
    at = "_at"

    def __init__(self, staging, name, schema, options):
        super().__init__(staging, name)
        self._rows = RowGroups(self.out, schema, options)

    def add(self, batch: pa.RecordBatch) -> None:
        plain = batch.drop_columns(["file_name", "part", "_at"])
        self._rows.add(pa.Table.from_batches([plain]))

    def close(self) -> tuple:
        self._rows.close()
        size = self.out.tell()
        self.out.close()
        return self.row(0, size, 0)


class FieldsPiece(Piece):
    """A Parquet piece of one value whose columns its file names."""

    at = "_at"

    def __init__(self, staging, name, options):
        super().__init__(staging, name)
        self._options, self._fields, self._rows = options, None, None

    def add(self, batch: pa.RecordBatch) -> None:
        if self._fields is None:
            self._fields = batch["_fields"][0].as_py()
        if pc.unique(_joined(batch["_fields"])).to_pylist() != ["\x1f".join(self._fields)]:
            raise ValueError(f"the schema changes inside {self.name}")
        rows = _columns_of(batch["_value"], self._fields, self.name)
        if self._rows is None:
            self._rows = RowGroups(self.out, rows.schema, self._options)
        self._rows.add(rows)

    def close(self) -> tuple:
        self._rows.close()
        size = self.out.tell()
        self.out.close()
        return self.row(0, size, 0)


def _joined(names: pa.Array) -> pa.Array:
    return pc.binary_join(names, "\x1f")


def _columns_of(value: pa.Array, fields: list[str], name: str) -> pa.Table:
    """A struct's or a map's entries as columns; a key without a column is an error."""
    if pa.types.is_struct(value.type):
        return pa.Table.from_arrays([pc.struct_field(value, f) for f in fields], names=fields)
    value = value.take(pa.array(range(len(value))))  # a slice would still show all its parent's keys
    extra = set(pc.unique(value.keys).to_pylist()) - set(fields)
    if extra:
        raise ValueError(f"no column for {', '.join(sorted(extra))} in {name}")
    return pa.Table.from_arrays([pc.map_lookup(value, pa.scalar(f), "last") for f in fields], names=fields)


def _fields_stage(staging: str, options: dict):
    def stage(batches):
        yield from _pieces(batches, lambda name: FieldsPiece(staging, name, options))

    return stage


def _text_stage(staging: str, frame: tuple[bytes, bytes, bytes], compression: str):
    def stage(batches):
        yield from _pieces(
            batches, lambda name: TextPiece(staging, name, frame, compression)
        )

    return stage


def _parquet_stage(staging: str, options: dict):
    def stage(batches):
        schema = None

        def start(name):
            return ParquetPiece(staging, name, schema, options)

        def seen():
            nonlocal schema
            for batch in batches:
                schema = batch.drop_columns([c for c in ("file_name", "part", "_at", _SCHEMA) if c in batch.schema.names]).schema
                yield batch

        yield from _pieces(seen(), start)

    return stage


def _in_order(manifest: DataFrame) -> DataFrame:
    """The pieces of each file numbered by their offsets, which must not overlap."""
    by_offset = W.partitionBy("file_name").orderBy("first")
    earlier = by_offset.rowsBetween(W.unboundedPreceding, -1)
    apart = F.coalesce(F.max("last").over(earlier) < F.col("first"), F.lit(True))
    name = F.when(apart, F.col("file_name")).otherwise(
        F.raise_error(F.concat(F.lit("pieces overlap in "), F.col("file_name"))).cast("string")
    )
    body = F.col("size") - F.col("head") - F.col("tail")
    return manifest.select(
        name.alias("file_name"),
        *[c for c in manifest.columns if c != "file_name"],
        F.row_number().over(by_offset).alias("number"),
        F.count(F.lit(1)).over(W.partitionBy("file_name")).alias("n_parts"),
        F.coalesce(F.sum(body).over(earlier), F.lit(0)).alias("bodies_before"),
    )


def publish(
    manifest: DataFrame,
    path: str,
    staging: str,
    frame: tuple[bytes, bytes, bytes],
    compression: str,
) -> None:
    """Moves or assembles the staged pieces into their objects."""
    between = encode(frame[1], compression)
    pieces = _in_order(manifest)
    if not store.is_local(path):
        _run(pieces, _joiner(path, staging, between), "file_name", "number")
    elif _run(pieces, _placer(path, staging, between), "piece"):
        # The last piece tells the size: what stands before it, its body and the tail.
        gaps = (F.col("n_parts") - 1) * len(between)
        size = F.max(F.col("bodies_before") + F.col("size") + gaps).alias("whole")
        whole = pieces.filter("n_parts > 1").groupBy("file_name").agg(size)
        _run(whole, _finisher(path, staging), "file_name")


def _run(rows: DataFrame, task, by: str, order: str | None = None) -> int:
    """Runs a task over rows for its effect; the sum of what its partitions report.

    Rows are few bytes but much work, so they are spread over the cluster by
    a fixed number of partitions, which Spark does not merge by size.
    """
    spread = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism * 4, by)
    if order:
        spread = spread.sortWithinPartitions(by, order)
    return spread.mapInArrow(task, "n bigint").agg(F.sum("n")).first()[0] or 0


def _report(n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})


def _merger(path: str, staging: str, options: dict):
    """Copies the rows of Parquet pieces, in order, into their object."""

    def merge(name: str, pieces: Iterator[dict]) -> None:
        merged = f"{staging}/pieces/{uuid.uuid4().hex}"
        with store.open_output(merged) as out:
            rows = None
            for row in pieces:
                with store.open_random(row["piece"]) as source:
                    piece = pq.ParquetFile(source)
                    rows = rows or RowGroups(out, piece.schema_arrow, options)
                    for group in range(piece.num_row_groups):
                        rows.add(piece.read_row_group(group))
            rows.close()
            size = out.tell()
        store.move(merged, store.object_path(path, name), size)

    return _per_file(path, merge)


def _per_file(path: str, put_together):
    """Runs over manifest rows by file: moves single pieces, has others put together."""

    def task(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        n = 0
        for name, pieces in itertools.groupby(rows, key=lambda row: row["file_name"]):
            first = next(pieces)
            n += first["n_parts"]
            if first["n_parts"] == 1:
                store.move(first["piece"], store.object_path(path, name), first["size"])
            else:
                put_together(name, itertools.chain([first], pieces))
        yield _report(n)

    return task


def _whole(staging: str, name: str) -> str:
    return f"{staging}/pieces/whole-{hashlib.sha256(name.encode()).hexdigest()}"


def _placer(path: str, staging: str, between: bytes):
    """Moves files of one piece and copies other pieces to their byte positions.

    Reports the pieces copied, whose files are still to be moved. A retry
    writes the same bytes to the same places.
    """

    def place(row: dict) -> None:
        first, last = row["number"] == 1, row["number"] == row["n_parts"]
        skip = 0 if first else row["head"]
        length = row["size"] - skip - (0 if last else row["tail"])
        # One head, the bodies before this one, and what stands between them.
        at = 0 if first else row["head"] + row["bodies_before"] + (row["number"] - 2) * len(between)
        target = store.local_path(_whole(staging, row["file_name"]))
        handle = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
        with os.fdopen(handle, "wb") as out, open(store.local_path(row["piece"]), "rb") as source:
            out.seek(at)
            if not first:
                out.write(between)
            source.seek(skip)
            _copy(source, out, length)

    def task(batches):
        copied = 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["n_parts"] == 1:
                    store.move(row["piece"], store.object_path(path, row["file_name"]), row["size"])
                else:
                    place(row)
                    copied += 1
        yield _report(copied)

    return task


def _finisher(path: str, staging: str):
    def task(batches):
        n = 0
        for batch in batches:
            for row in batch.to_pylist():
                store.move(_whole(staging, row["file_name"]), store.object_path(path, row["file_name"]), row["whole"])
                n += 1
        yield _report(n)

    return task


def _joiner(path: str, staging: str, between: bytes):
    """Object stores have no positional writes: one stream per large object."""

    def join(name: str, pieces: Iterator[dict]) -> None:
        whole = f"{staging}/pieces/{uuid.uuid4().hex}"
        size = 0
        with store.open_output(whole) as out:
            for row in pieces:
                first, last = row["number"] == 1, row["number"] == row["n_parts"]
                if not first:
                    out.write(between)
                    size += len(between)
                skip = 0 if first else row["head"]
                length = row["size"] - skip - (0 if last else row["tail"])
                with store.open_input(row["piece"]) as source:
                    source.read(skip)
                    _copy(source, out, length)
                size += length
        store.move(whole, store.object_path(path, name), size)

    return _per_file(path, join)


def _copy(source, out, length: int) -> None:
    while length > 0:
        data = source.read(min(length, 1 << 20))
        if not data:
            raise EOFError("a staged piece is shorter than its manifest says")
        out.write(data)
        length -= len(data)

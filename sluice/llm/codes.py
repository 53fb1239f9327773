"""Product codes of vectors, learnt by exact rounds of nearest entries on metric trees.

Vectors become whole numbers, floor(scale * x), and are cut into equal parts.
Every part position has a codebook that starts as that part of the vectors with
the smallest ids. A round gives every part to the nearest entry (squared
distance, the lower index among equals) and moves the entry to the floor of its
parts' mean; an entry without parts stays.

Vectors are kept in blocks. Each block has a metric tree per part position
(``sluice.llm.anchors_tree``), built once and stored in the shared folder with
the block. In a round a task goes through the trees of its blocks; balls wholly
owned by one entry add their stored sums and counts. Tasks send sums per entry
and component, which Spark adds up, so that what reaches the driver is of the
codebooks' size whatever the input. All numbers are whole: the order of
additions does not matter and the result is exact.

Left out are vectors that are null or hold null or non-finite components.
Shorter vectors are filled up with zeros to the longest, as is the longest to a
multiple of the number of parts. Components so large that the errors would not
fit a long are an error. Rows with equal or null ids are vectors of their own
(null ids are the largest). Fewer vectors than entries make smaller codebooks;
an empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import anchors_tree
from sluice.llm.common import keep, ready

BLOCK_BYTES = 2 << 20  # of whole numbers in a block
_BLOCK = "block long, ids array<long>, labels array<string>, trees binary"


def usable(vec_col: str = "embedding"):
    """Whether a vector and all its components are there and finite."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(fine, F.lit(False))


class Codes:
    """Codebooks learnt from all vectors of a table, and the vectors' codes."""

    def __init__(self, blocks: DataFrame, codebooks: list[np.ndarray]):
        self.blocks, self.codebooks = blocks, codebooks

    def encode(self) -> DataFrame:
        """``block, vec_id, label, code array<int>, error`` of every vector used."""
        books = self.codebooks

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    trees = _unpacked(batch.column("trees")[i])
                    found = [anchors_tree.assign(t, b) for t, b in zip(trees, books, strict=True)]
                    code = np.stack([c for c, _ in found], 1)
                    n = len(code)
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(0, code.size + 1, code.shape[1], dtype=np.int32)), pa.array(code.ravel().astype(np.int32))
                    )
                    columns = [
                        pa.array(np.full(n, batch.column("block")[i].as_py())),
                        batch.column("ids")[i].values,
                        batch.column("labels")[i].values,
                        lists,
                        pa.array(sum(e for _, e in found)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "vec_id", "label", "code", "error"])

        return self.blocks.mapInArrow(run, "block long, vec_id long, label string, code array<int>, error long")

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimals with commas."""
        numbers = ",".join(str(x) for book in self.codebooks for x in book.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()

    def summary(self) -> DataFrame:
        """``vec_id, code, error, label_error, codebooks_sha256``; codes as two hex digits a part."""
        rows = keep(self.encode(), "codes")
        label = [F.col("label"), F.col("label").isNull().alias("no_label")]
        # Labels are told to blocks, not to rows: a label held by a third of the rows is one row a block.
        by_block = rows.groupBy("block", "label").agg(F.sum("error").alias("error"))
        total = by_block.groupBy("label").agg(F.sum("error").alias("label_error")).select("label_error", *_filled(label))
        told = by_block.select("block", *_filled(label)).join(total, ["label", "no_label"])
        hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
        rows = rows.select("block", "vec_id", hexed.alias("code"), "error", *_filled(label))
        return rows.join(told, ["block", "label", "no_label"]).select(
            "vec_id", "code", "error", "label_error", F.lit(self.digest()).alias("codebooks_sha256")
        )


def _filled(label: list) -> list:
    return [F.coalesce(label[0], F.lit("")).alias("label"), label[1]]


def _packed(trees: list) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(trees, protocol=5))


def _unpacked(blob: pa.Scalar) -> list[anchors_tree.Tree]:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob.as_buffer()))


def _whole(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), filled up with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    parent = pc.list_parent_indices(vectors).to_numpy()
    size = pc.list_value_length(vectors).to_numpy()
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(vectors), width), np.int64)
    out[parent, place] = np.floor(flat * scale)
    return out


def fit(
    vectors: DataFrame,
    *,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> Codes:
    """Learns ``entries`` (256 at most) for each of ``parts``; ``scale`` is a power of two."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    ready(vectors)
    rows = vectors.where(usable(vec_col)).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vec_col).cast("array<double>").alias("x"),
    )
    largest = F.max(F.aggregate("x", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v))))
    longest, largest = rows.agg(F.max(F.size("x")), largest).first()
    step = -(-(longest or 0) // parts) or 1
    width = step * parts
    if width * (2 * scale * (largest or 0.0) + 2) ** 2 >= 2.0**63:
        raise ArithmeticError(f"components up to {largest} have errors that do not fit a long")

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        size = max(1, BLOCK_BYTES // (8 * width))
        held: list[pa.Table] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            whole = _whole(table.column("x").chunk(0), width, scale)
            trees = [anchors_tree.build(np.ascontiguousarray(whole[:, i : i + step])) for i in range(0, width, step)]
            columns = [
                pa.array([number], pa.int64()),
                pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([table.column("label").to_pylist()], pa.list_(pa.string())),
                pa.array([_packed(trees)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "labels", "trees"])

        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, size - sum(map(len, held)))
                held.append(pa.Table.from_batches([part]))
                at += len(part)
                if sum(map(len, held)) == size:
                    yield block(pa.concat_tables(held))
                    held, number = [], number + 1
        if held:
            yield block(pa.concat_tables(held))

    blocks = keep(rows.mapInArrow(blocks_of, _BLOCK), "vector-blocks")
    # Of equal ids the smaller vector comes first, so that the start does not depend on the order of rows.
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    start = np.zeros((len(first), width), np.int64)
    for i, row in enumerate(first):
        start[i, : len(row.x)] = np.floor(np.array(row.x, np.float64) * scale)
    books = [np.ascontiguousarray(start[:, i : i + step]) for i in range(0, width, step)]
    for _ in range(rounds if first else 0):
        books = _moved(blocks, books)
    return Codes(blocks, books)


def _moved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round. Component -1 is an entry's number of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            for blob in batch.column(0):
                for t, tree, book in zip(total, _unpacked(blob), books, strict=True):
                    sums, counts = anchors_tree.totals(tree, book)
                    t[:, 1:] += sums
                    t[:, 0] += counts
        part = np.repeat(np.arange(len(total)), [t.size for t in total])
        entry, component = (np.concatenate(x) for x in zip(*(map(np.ravel, np.indices(t.shape)) for t in total), strict=True))
        columns = [part, entry, component - 1, np.concatenate([t.ravel() for t in total])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "component", "total"])

    sent = blocks.select("trees").mapInArrow(run, "part long, entry long, component long, total long")
    moved = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
    for row in sent.groupBy("part", "entry", "component").agg(F.sum("total").alias("total")).collect():
        moved[row.part][row.entry, row.component + 1] = row.total
    found = []
    for old, new in zip(books, moved, strict=True):
        used = new[:, :1] > 0
        found.append(np.where(used, new[:, 1:] // np.maximum(new[:, :1], 1), old))
    return found

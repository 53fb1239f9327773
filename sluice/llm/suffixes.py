"""Exact removal of repeated byte strings with an enhanced suffix array.

A byte goes if it is covered by a ``width``-byte string that also starts in a
document with a smaller id. Strings are judged on the input, whole texts, as
UTF-8; matches never cross documents.

Every window of ``width`` bytes belongs to an anchor (``sluice.llm.anchors``),
and equal windows to equal anchors, so suffixes need only be sorted among those
with one anchor string. Neighbouring windows with one anchor are a *context*.

1. Documents become blocks, written once. Each block asks for its distinct
   (anchor string, context) pairs (``sluice.llm.blobs``): is the anchor string
   known from other documents, and is the whole context known from a smaller
   one? In the second case all its windows are covered. A context is told once
   however many documents hold it.
2. Of what is left, the first document's contexts whose anchor string occurs
   elsewhere, with other bytes around it, go to the task of that string. It
   sorts the suffixes of the contexts into an enhanced suffix array and scans
   its common prefixes with a stack, which gives the tree of intervals of
   suffixes that share ``width`` bytes or more. An interval whose suffixes are
   preceded by different bytes is a maximal repeat; in all of its occurrences
   but those in its smallest document the shared bytes are covered. An interval
   that one byte precedes is left to the interval of the longer string, which
   has the same occurrences.
3. An anchor string with more than ``max_group`` different contexts is not
   sorted in one task: Spark takes the smallest id of each of its windows
   (partial aggregates) and joins it back.
4. Spans meet their blocks, and bytes are cut out.

A null or empty text has no bytes. Rows with equal ids are not smaller than
each other; a null id is larger than all others. Cutting within a character
leaves bytes that are not UTF-8; ``kept_text`` is without them, ``kept_sha256``
is of the bytes as they are left. A text of any length is one row of one block,
whole in the memory of its task; an empty table gives no rows. Other columns may
be carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from sluice.llm import anchors, blobs
from sluice.llm.common import keep, ready

LAST = (1 << 63) - 1  # stands for a null id
UNIQUE, COVERED, OPEN = 0, 1, 2
BATCH = 8_000  # contexts sorted at a time, if groups end there
_BLOCK = "block long, ids array<long>, lengths array<long>, data binary, rest binary"
_PART = "block long, spans binary, gram long, context binary, windows int, id long, at long"
_PART_TYPES = {"gram": pa.int64(), "context": pa.binary(), "windows": pa.int32(), "id": pa.int64(), "at": pa.int64()}


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents by ascending id; columns beyond id and text ride along."""
    first = TaskContext.get().partitionId() << 33

    def rows():
        for b in batches:
            for i in range(len(b)):
                yield b, i, b.column(0)[i].as_py(), (b.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")

    for number, block in enumerate(blobs.batches_of(rows(), lambda row: 64 + len(row[3]))):
        block.sort(key=lambda row: LAST if row[2] is None else row[2])
        rest = pa.Table.from_batches([b.slice(i, 1) for b, i, _, _ in block]).drop_columns(["_text"]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest.schema) as out:
            out.write_table(rest)
        squeeze = zstandard.ZstdCompressor(level=6).compress
        columns = [
            pa.array([first + number], pa.int64()),
            pa.array([[LAST if r[2] is None else r[2] for r in block]], pa.list_(pa.int64())),
            pa.array([[len(r[3]) for r in block]], pa.list_(pa.int64())),
            pa.array([squeeze(b"".join(r[3] for r in block))], pa.binary()),
            pa.array([squeeze(sink.getvalue().to_pybytes())], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "lengths", "data", "rest"])


class Block:
    """A block's runs of windows and its distinct (anchor string, context) pairs, ascending."""

    def __init__(self, ids, lengths, data: bytes):
        self.ids = np.asarray(ids, np.int64)
        self.ends = np.cumsum(np.asarray(lengths, np.int64))
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)

    def index(self, width: int, gram_bits: int) -> None:
        runs = anchors.runs(self.data, self.ends, width)
        gram = runs.gram >> np.uint64(64 - gram_bits) << np.uint64(64 - gram_bits)
        context = runs.context & np.uint64((1 << 48) - 1)
        run_ids = self.ids[np.searchsorted(self.ends, runs.first, side="right")]
        order = np.lexsort((runs.first, context, gram))  # documents are in order of id
        g, c = gram[order], context[order]
        new = np.r_[np.ones(min(1, len(g)), bool), (g[1:] != g[:-1]) | (c[1:] != c[:-1])]
        head = order[new]
        self.runs, self.run_ids = runs, run_ids
        self.pair = np.empty(len(order), np.int64)  # of each run
        self.pair[order] = np.cumsum(new) - 1
        self.head = head  # the first run of each pair
        self.gram, self.context, self.pair_ids = gram[head], context[head], run_ids[head]


def _ask(width: int, gram_bits: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["ids"], row["lengths"], row["data"])
                block.index(width, gram_bits)
                edges = blobs.cuts(block.gram, buckets)
                at = [i for i in range(buckets) if edges[i] < edges[i + 1]]
                arrays = (block.gram, block.context, block.pair_ids)
                sent = [blobs.pack(*(a[edges[i] : edges[i + 1]] for a in arrays)) for i in at]
                columns = [pa.array([row["block"]] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(sent, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "keys"])

    return run


def _state(frame: pd.DataFrame) -> pd.DataFrame:
    """For each pair: covered by a smaller document, open, or of no other document."""
    parts = [blobs.unpack(k, "<u8", "<u8", "<i8") for k in frame["keys"]]
    gram, context, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((ids, context, gram))
    g, c, d = gram[order], context[order], ids[order]
    new_gram = np.r_[True, g[1:] != g[:-1]]
    new_pair = new_gram | np.r_[True, c[1:] != c[:-1]]
    of_gram, of_pair = np.cumsum(new_gram) - 1, np.cumsum(new_pair) - 1
    low = np.minimum.reduceat(d, np.flatnonzero(new_gram))
    high = np.maximum.reduceat(d, np.flatnonzero(new_gram))
    contexts = np.bincount(of_gram[new_pair])
    state = np.full(len(g), UNIQUE, np.uint8)
    state[((low < high) & (contexts > 1))[of_gram]] = OPEN
    state[d > d[new_pair][of_pair]] = COVERED
    back = np.empty(len(g), np.uint8)
    back[order] = state
    ends = np.cumsum([len(p[0]) for p in parts])
    replies = [blobs.pack(b) for b in np.split(back, ends[:-1])]
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "reply": replies})


def _first(table: pa.Table) -> dict:
    return {name: table.column(name)[0].as_py() for name in table.column_names}


def _sort_out(width: int, gram_bits: int):
    """Spans of the covered contexts, and the open contexts, of one block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = _first(left)
        block = Block(row["ids"], row["lengths"], row["data"])
        block.index(width, gram_bits)
        replies = sorted(zip(right.column("bucket").to_pylist(), right.column("reply").to_pylist(), strict=True))
        state = np.concatenate([blobs.unpack(r, "u1")[0] for _, r in replies] or [np.zeros(0, np.uint8)])
        runs = block.runs
        covered = (state[block.pair] == COVERED) | (block.run_ids > block.pair_ids[block.pair])
        start, end = _merged(runs.first[covered], runs.last[covered] + width)
        open_ = np.flatnonzero((state[block.pair] == OPEN) & ~covered)
        # One document may hold a context often: the first place stands for all of them.
        head = np.unique(block.head[block.pair[open_]])
        again = np.setdiff1d(open_, head)
        chosen = np.concatenate([head, again])
        n = len(chosen)
        data = block.data.tobytes()
        contexts = [data[a:b] for a, b in zip(runs.first[chosen].tolist(), (runs.last[chosen] + width).tolist(), strict=True)]
        first = pa.table(
            {
                "block": pa.array([row["block"]], pa.int64()),
                "spans": pa.array([blobs.pack(start, end)], pa.binary()),
                **{k: pa.nulls(1, t) for k, t in _PART_TYPES.items()},
            }
        )
        others = pa.table(
            {
                "block": pa.array([row["block"]] * n, pa.int64()),
                "spans": pa.nulls(n, pa.binary()),
                "gram": pa.array(runs.gram[chosen].view(np.int64)),
                "context": pa.array(contexts, pa.binary()),
                "windows": pa.array((runs.last - runs.first + 1)[chosen].astype(np.int32)),
                "id": pa.array(block.run_ids[chosen]),
                "at": pa.array(runs.first[chosen]),
            }
        )
        return pa.concat_tables([first, others]).combine_chunks()

    return run


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Touching spans as one; those given are all within documents."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > reach[:-1]]
    return start[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]]


def intervals(common: np.ndarray, ids: np.ndarray, before: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """Maximal repeats of an enhanced suffix array: ``(first, last, length, smallest id)``.

    ``common[i]`` is the common prefix of suffixes i - 1 and i, ``before`` the
    byte before a suffix, or -1 where that is the context's edge. The stack
    holds the open intervals, outermost first: [length, first, smallest id,
    byte before or -1 if they differ]. An interval is closed when the common
    prefix falls below its length, and told if different bytes precede it.
    """
    found = []
    stack: list[list[int]] = []
    ids, before, common = ids.tolist(), before.tolist(), common.tolist()
    n = len(ids)
    for i in range(1, n + 1):
        shared = common[i] if i < n else 0
        low, byte, first = ids[i - 1], before[i - 1], i - 1
        while stack and stack[-1][0] > shared:
            length, first, top_low, top_byte = stack.pop()
            low = min(low, top_low)
            byte = byte if byte == top_byte else -1
            if byte == -1:
                found.append((first, i - 1, length, low))
        if shared >= least:
            if stack and stack[-1][0] == shared:
                top = stack[-1]
                top[2] = min(top[2], low)
                top[3] = byte if byte == top[3] else -1
            else:
                stack.append([shared, first, low, byte])
        # Below ``least`` the stack is empty: the next suffix starts anew.
    return found


def repeats(contexts: list[bytes], windows: np.ndarray, ids: np.ndarray, width: int):
    """``(context, from, to)`` of the bytes covered by maximal repeats with a smaller id.

    Only suffixes of at least ``width`` bytes count. Those whose first
    ``width`` bytes no other has (told by a hash) are alone in the suffix
    array and left out of the sort.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    start = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(contexts) + bytes(int(sizes.max(initial=0))), np.uint8)
    of = np.repeat(np.arange(len(contexts)), windows)
    place = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = start[of] + place
    hashed = np.zeros(len(buffer) - width + 1, np.uint64)
    for k in range(width):
        hashed = hashed * np.uint64(0x100000001B3) + buffer[k : k + len(hashed)] + np.uint64(1)
    _, back, n = np.unique(hashed[at], return_inverse=True, return_counts=True)
    shared = n[back] > 1
    of, place, at = of[shared], place[shared], at[shared]
    none = np.zeros(0, np.int64)
    if not len(of):
        return none, none, none
    length = (sizes[of] - place).astype(np.int64)
    wide = int(length.max())
    reach = np.minimum(at[:, None].astype(np.int32) + np.arange(wide, dtype=np.int32), len(buffer) - 1)
    suffix = buffer[reach]
    del reach
    suffix[np.arange(wide) >= length[:, None]] = 0
    order = np.argsort(length, kind="stable")
    order = order[np.argsort(suffix[order].view(f"S{wide}").ravel(), kind="stable")]
    suffix, length, of, place, at = suffix[order], length[order], of[order], place[order], at[order]
    differ = suffix[1:] != suffix[:-1]
    same = np.where(differ.any(1), differ.argmax(1), wide)
    common = np.r_[0, np.minimum(same, np.minimum(length[1:], length[:-1]))]
    before = np.where(place > 0, buffer[np.maximum(at - 1, 0)].astype(np.int64), -1)
    found = np.array(intervals(common, ids[of], before, width), np.int64).reshape(-1, 4)
    count = found[:, 1] - found[:, 0] + 1
    member = np.repeat(found[:, 0] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    low, size = np.repeat(found[:, 3], count), np.repeat(found[:, 2], count)
    later = ids[of[member]] > low
    member, size = member[later], size[later]
    return of[member], place[member], place[member] + size


def _scan(width: int):
    """Spans, packed by block, from open contexts that come sorted by anchor string."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        columns = [table.column(k).to_numpy() for k in ("block", "windows", "id", "at")]
        block, windows, ids, at = (c.astype(np.int64) for c in columns)
        of, lo, hi = repeats(table.column("context").to_pylist(), windows, ids, width)
        owner, start, end = block[of], at[of] + lo, at[of] + hi
        order = np.argsort(owner, kind="stable")
        owner, start, end = owner[order], start[order], end[order]
        edges = np.flatnonzero(np.r_[np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1]])
        spans = []
        for a, b in zip(edges, [*edges[1:], len(owner)], strict=False):
            spans.append(blobs.pack(*_merged(start[a:b], end[a:b])))
        return pa.RecordBatch.from_arrays([pa.array(owner[edges]), pa.array(spans, pa.binary())], names=["block", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += len(batch)
            if size >= BATCH:
                table = pa.concat_tables(held)
                gram = table.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))
                if cut:
                    yield solve(table.slice(0, cut))
                    held, size = [table.slice(cut)], len(table) - cut
        if size:
            yield solve(pa.concat_tables(held))

    return run


def _cut(schema: pa.Schema, with_text: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = _first(left)
        block = Block(row["ids"], row["lengths"], row["data"])
        size = len(block.data)
        depth = np.zeros(size + 1, np.int32)
        for blob in right.column("spans").to_pylist():
            if blob is not None:
                start, end = blobs.unpack(blob, "<i8", "<i8")
                np.add.at(depth, start, 1)
                np.add.at(depth, end, -1)
        single = right.filter(pa.compute.is_valid(right.column("start")))
        np.add.at(depth, single.column("start").to_numpy(), 1)
        np.add.at(depth, single.column("end").to_numpy(), -1)
        gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
        lengths = np.asarray(row["lengths"], np.int64)
        starts = block.ends - lengths
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = starts[(starts < size) & (lengths > 0)]
        opens[inner] = gone[inner]
        total, spans = depth, np.zeros(size + 1, np.int32)  # how many before each byte
        total[0] = 0
        np.cumsum(gone, out=total[1:])
        np.cumsum(opens, out=spans[1:])
        kept = [block.data[a:b][~gone[a:b]].tobytes() for a, b in zip(starts, block.ends, strict=True)]
        rest = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["rest"])).read_all()
        columns = [
            *rest.columns,
            pa.array(lengths),
            pa.array((total[block.ends] - total[starts]).astype(np.int64)),
            pa.array((spans[block.ends] - spans[starts]).astype(np.int64)),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ]
        if with_text:
            columns.append(pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()))
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def deduplicate(
    docs: DataFrame,
    *,
    width: int = 50,
    max_group: int = 4096,
    with_text: bool = False,
    carry: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, *carry, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]`` for every row.

    ``n_spans`` counts the maximal removed runs. ``width`` is 32 bytes at least.
    """
    if width < 32:
        raise ValueError("width must be 32 or more")
    ready(docs)
    buckets = blobs.n_buckets(docs, text_col)
    # Few anchor strings meet another of the same hash: 8 bits more than the text's length.
    gram_bits = min(62, max(40, (buckets * blobs.BUCKET_BYTES).bit_length() + 8))
    carried = [c for c in carry or [] if c not in (id_col, text_col)]
    rows = docs.select(
        F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text"), *(F.col(c) for c in carried)
    )
    blocks = keep(rows.mapInArrow(_encode, _BLOCK), "text-blocks")
    asked = blocks.select("block", "ids", "lengths", "data").mapInArrow(
        _ask(width, gram_bits, buckets), "block long, bucket int, keys binary"
    )
    replies = keep(blobs.answer(asked, _state, "block long, bucket int, reply binary"), "states")
    texts = blocks.select("block", "ids", "lengths", "data").groupBy("block")
    parts = keep(texts.cogroup(replies.groupBy("block")).applyInArrow(_sort_out(width, gram_bits), _PART), "contexts")

    contexts = parts.where("gram IS NOT NULL").select("block", "gram", "context", "windows", "id", "at")
    hot = keep(contexts.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > max_group).select("gram"), "hot")
    usual = contexts.join(hot, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram")
    scanned = usual.mapInArrow(_scan(width), "block long, spans binary")

    window = F.substring("context", F.col("k") + 1, F.lit(width)).alias("window")
    each = contexts.join(hot, "gram", "left_semi").withColumn("k", F.explode(F.expr("sequence(0, windows - 1)")))
    each = each.select("block", "gram", window, "id", (F.col("at") + F.col("k")).alias("start"))
    lows = each.groupBy("gram", "window").agg(F.min("id").alias("low"))
    single = each.join(lows, ["gram", "window"]).where("low < id").select("block", "start", (F.col("start") + width).alias("end"))

    no_span, no_blob = F.lit(None).cast("long"), F.lit(None).cast("binary")
    spans = parts.where("spans IS NOT NULL").select("block", "spans").unionByName(scanned)
    spans = spans.select("block", "spans", no_span.alias("start"), no_span.alias("end"))
    spans = spans.unionByName(single.select("block", no_blob.alias("spans"), "start", "end"))
    result = [*rows.drop("_text").schema.fields, *StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string").fields]
    if with_text:
        result.append(*StructType.fromDDL("kept_text string").fields)
    result = StructType([StructField(f.name, f.dataType, True) for f in result])
    spans = keep(spans, "spans")
    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(_cut(to_arrow_schema(result), with_text), result)

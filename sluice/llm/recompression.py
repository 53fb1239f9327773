"""Removal of repeated runs of words by recompression.

A word goes if it is covered by a window of ``width`` consecutive words whose
sequence also starts earlier: in a document with a smaller id, or earlier in the
same document. Windows are judged on the input, whole texts; none crosses
documents.

*Recompression.* Words get names. In every level, first each maximal run of one
name becomes a name of its own, then each name draws left or right by its own
hash and each left name followed by a right one becomes one. A name is a digest
of what it stands for (two lanes of 64 bits made from the parts' names), so all
tasks give the same string the same name with nothing to agree on. What a
symbol depends on is known: the run step looks at the two neighbours, the pair
step at one. The words between the outermost of those are the symbol's *reach*.
Wherever these words occur, the symbol is there again: equal windows have the
same interior symbols, those whose reach lies within the window.

Documents are kept in blocks, bounded batches that a task parses by itself.
Three rounds over all blocks (``sluice.llm.blobs``) tell them what others have:

1. *Words* of a block are its dictionary; texts are kept as numbers of it.
2. *Symbols*. Every window has an anchor, the leftmost interior symbol of the
   highest level that has one; neighbouring windows share it. Blocks send the
   anchors, with the words in their reach, and the symbols that span many words
   (the smallest ones over 2, 8, 32, ... times the width). A window whose anchor
   occurs once in the corpus is the only one of its kind. A long symbol that
   occurs earlier elsewhere reveals a repeat: all its words go, and no window
   within it need be asked for, so a copied document costs a few symbols.
3. *Windows* that are left are named by their anchor, its place, and the words on
   both sides of it (96 bits); the smallest document that has the name decides.

Every round sends a block's distinct keys only, so what a third of the documents
holds is one entry a block. A document must fit a task's memory, with about 150
bytes a word; blocks hold ``BLOCK_BYTES`` of text otherwise.

A null or empty text has no words and nothing is removed. Rows with equal ids are
documents of their own, none smaller than the other; a null id is larger than
all others. An empty table gives no rows. Names of columns do not clash: other
columns are left out unless carried.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from sluice.llm import blobs
from sluice.llm.common import keep, ready

LAST = (1 << 63) - 1  # stands for a null id
BUCKET_BYTES = 16 << 20  # of text for each bucket of keys
_BLOCK = "block long, ids array<long>, lengths array<long>, words binary, codes binary, rest binary"
_U = np.uint64
_ONE, _TWO = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_BASE = 0xD6E8FEB86659FD95  # odd: powers of it have inverses


def _fin(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _mix(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    """A name made of two, in one lane; not symmetric."""
    return _fin(_fin(a + _U(int(_ONE) * kind % (1 << 64))) + (b ^ (a >> _U(17))) * _TWO + _U(kind))


# --- symbols --------------------------------------------------------------------------


@dataclass
class Level:
    """Symbols of a block in order: two lanes of the name, words spanned, reach, document."""

    one: np.ndarray
    two: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray


def words_level(one: np.ndarray, two: np.ndarray, lengths: np.ndarray) -> Level:
    at = np.arange(len(one), dtype=np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    return Level(one, two, at, at + 1, at, at + 1, doc)


def _beyond(level: Level, bounds: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Reach to the left of the symbol before each and to the right of the one after; outside at a document's edge."""
    first, last = bounds
    inner = level.doc[1:] == level.doc[:-1]
    before = np.r_[first[level.doc[:1]] - 1, np.where(inner, level.lo[:-1], first[level.doc[1:]] - 1)]
    after = np.r_[np.where(inner, level.hi[1:], last[level.doc[:-1]] + 1), last[level.doc[-1:]] + 1]
    return before, after


def runs(level: Level, bounds: tuple[np.ndarray, np.ndarray]) -> Level:
    """Maximal runs of one name become a symbol each."""
    n = len(level.one)
    same = (level.one[1:] == level.one[:-1]) & (level.two[1:] == level.two[:-1]) & (level.doc[1:] == level.doc[:-1])
    first = np.flatnonzero(np.r_[True, ~same])
    last = np.r_[first[1:], n] - 1
    many = (last - first + 1).astype(np.uint64)
    before, after = _beyond(level, bounds)
    lanes = (np.where(many > 1, _mix(x[first], many, 1), x[first]) for x in (level.one, level.two))
    return Level(*lanes, level.start[first], level.end[last], before[first], after[last], level.doc[first])


def pairs(level: Level, bounds: tuple[np.ndarray, np.ndarray], number: int) -> Level:
    """Each left name followed by a right name becomes one symbol with it."""
    right = (_fin(level.one ^ _mix(level.one[:1] * _U(0) + _U(number), _TWO * np.ones(1, _U), 3)) >> _U(63)).astype(bool)
    pair = np.r_[~right[:-1] & right[1:] & (level.doc[1:] == level.doc[:-1]), False]
    keep_ = np.flatnonzero(np.r_[True, ~pair[:-1]])
    joined = pair[keep_]
    second = np.minimum(keep_ + 1, len(right) - 1)
    before, after = _beyond(level, bounds)
    lanes = (np.where(joined, _mix(x[keep_], x[second], 2), x[keep_]) for x in (level.one, level.two))
    lo = np.where(~joined & right[keep_], before[keep_], level.lo[keep_])
    hi = np.where(joined, level.hi[second], np.where(right[keep_], level.hi[keep_], after[keep_]))
    return Level(*lanes, level.start[keep_], np.where(joined, level.end[second], level.end[keep_]), lo, hi, level.doc[keep_])


class Powers:
    """Hashes of any range of words in constant time, the same wherever the words are."""

    def __init__(self, names: np.ndarray, base: int):
        n = len(names)
        self.inverse = _powers(pow(base, -1, 1 << 64), n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(names * _powers(base, n + 1)[:n], out=self.total[1:])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.total[hi] - self.total[lo]) * self.inverse[lo]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * _U(pow(base, done, 1 << 64))
        done += step
    return out


@dataclass
class Parsed:
    """What a block knows by itself."""

    window: np.ndarray  # where each window starts
    anchor: np.ndarray  # of each window: which of the anchors
    anchor_key: np.ndarray  # of each anchor occurrence
    long: list[np.ndarray]  # one, two, start, end, doc of the long symbols


class Block:
    def __init__(self, row: dict):
        self.ids = np.asarray(row["ids"], np.int64)
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.words = zstandard.ZstdDecompressor().decompress(row["words"]).split()
        self.codes = blobs.unpack(row["codes"], "<u4")[0]

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        digests = b"".join(map(xxhash.xxh3_128_digest, self.words))
        lanes = np.frombuffer(digests, "<u8").reshape(-1, 2)
        return lanes[self.codes, 0], lanes[self.codes, 1]

    def parse(self, width: int) -> Parsed:
        one, two = self.names()
        n = len(one)
        bounds = (self.starts, self.ends)
        level = words_level(one, two, self.lengths)
        self.doc = level.doc
        self.hash_one, self.hash_two = Powers(one, _BASE), Powers(two, _BASE ^ 0x5555555555555554)
        window = np.flatnonzero(np.arange(n) + width <= self.ends[level.doc]) if n else np.zeros(0, np.int64)
        best = np.zeros(len(window), np.int64)  # the anchor's level
        at = [np.zeros(len(window), np.int64) for _ in range(4)]  # its start, end, reach
        name = np.zeros(len(window), np.uint64)
        long: list[list[np.ndarray]] = []
        spans = [width * 2 * 4**k for k in range(16)]
        number, idle = 0, 0
        usable = len(window) > 0
        least = np.count_nonzero(self.lengths)
        while len(level.one) > least and idle < 16:
            if usable:
                inside = level.hi - level.lo <= width
                usable = bool(inside.any())
                if usable:
                    # The first symbol that reaches back no further than the window's start.
                    place = np.cumsum(np.bincount(level.lo + 1, minlength=n + 2))[window]
                    fits = place < len(level.lo)
                    fits[fits] = level.hi[place[fits]] <= window[fits] + width
                    chosen = place[fits]
                    best[fits], name[fits] = number, level.one[chosen]
                    for a, values in zip(at, (level.start, level.end, level.lo, level.hi), strict=True):
                        a[fits] = values[chosen]
            number += 1
            joined = pairs(runs(level, bounds), bounds, number)
            idle = idle + 1 if len(joined.one) == len(level.one) else 0
            # Long symbols: those made now that span a threshold none of their parts spans.
            size = joined.end - joined.start
            part = np.maximum.reduceat(level.end - level.start, np.searchsorted(level.start, joined.start))
            over = np.zeros(len(size), bool)
            for s in spans:
                over |= (size >= s) & (part < s)
            long.append([x[over] for x in (joined.one, joined.two, joined.start, joined.end, joined.doc)])
            level = joined
        kind = np.full(len(window), 5, np.uint64) + best.astype(np.uint64)
        fresh = np.r_[np.ones(min(1, len(window)), bool), (best[1:] != best[:-1]) | (at[0][1:] != at[0][:-1])]
        head = np.flatnonzero(fresh)
        reach = self.hash_one(at[2][head], at[3][head])
        key = _fin(_mix(name[head], reach, 7) + kind[head])
        self.at, self.name, self.best = at, name, best
        columns = [np.concatenate(x) for x in zip(*long, strict=True)] if long else []
        return Parsed(window, np.cumsum(fresh) - 1, key, columns or [np.zeros(0, np.int64)] * 5)

    def window_names(self, window: np.ndarray, width: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two lanes for the windows at ``rows``: the anchor, its place, and the words around it."""
        start, end = self.at[0][rows], self.at[1][rows]
        where = ((start - window) * 4096 + (end - start)).astype(np.uint64)
        lanes = []
        for powers, kind in ((self.hash_one, 11), (self.hash_two, 12)):
            sides = _mix(powers(window, start), powers(end, window + width), kind)
            lanes.append(_mix(_mix(self.name[rows], where, kind), sides, kind))
        return lanes[0], lanes[1]


# --- the rounds -------------------------------------------------------------------------


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents by ascending id; columns beyond id and text ride along."""
    first = TaskContext.get().partitionId() << 33

    def rows():
        for b in batches:
            for i in range(len(b)):
                yield b, i, b.column(0)[i].as_py(), (b.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")

    for number, block in enumerate(blobs.batches_of(rows(), lambda row: 64 + len(row[3]))):
        block.sort(key=lambda row: LAST if row[2] is None else row[2])
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        lengths, codes = [], []
        for _, _, _, text in block:
            words = text.split()  # at the bytes 20 and 09 to 0D
            codes.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
            lengths.append(len(words))
        rest = pa.Table.from_batches([b.slice(i, 1) for b, i, _, _ in block]).drop_columns(["_text"]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest.schema) as out:
            out.write_table(rest)
        squeeze = zstandard.ZstdCompressor(level=3).compress
        columns = [
            pa.array([first + number], pa.int64()),
            pa.array([[LAST if r[2] is None else r[2] for r in block]], pa.list_(pa.int64())),
            pa.array([lengths], pa.list_(pa.int64())),
            pa.array([squeeze(b" ".join(known))], pa.binary()),
            pa.array([blobs.pack(np.concatenate(codes))], pa.binary()),
            pa.array([squeeze(sink.getvalue().to_pybytes())], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCK.split(", ")])


def _firsts(keys: tuple[np.ndarray, ...], ids: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """Distinct keys in order with their smallest id; which key each row has, and which rows are repeats in the block."""
    order = np.lexsort((start, doc, *keys[::-1]))  # documents are in order of id
    differ = np.zeros(max(0, len(order) - 1), bool)
    for k in keys:
        differ |= k[order][1:] != k[order][:-1]
    new = np.r_[np.ones(min(1, len(order)), bool), differ]
    group = np.cumsum(new) - 1
    head = order[new]
    low = ids[doc[head]]
    repeat = np.zeros(len(order), bool)
    d = doc[order]
    again = ~new
    again[1:] &= d[1:] == d[:-1]
    repeat[order] = again | (ids[d] > low[group])
    of = np.empty(len(order), np.int64)
    of[order] = group
    return head, low, of, repeat


def _asked(block: Block, width: int, bits: int):
    """The distinct anchors (and whether the block has them twice) and long symbols of a block."""
    found = block.parse(width)
    key = found.anchor_key >> _U(64 - bits) << _U(64 - bits)
    anchors, of, n = np.unique(key, return_inverse=True, return_counts=True)
    one, two, start, end, doc = found.long
    two = two.astype(np.uint32)
    head, low, of_long, repeat = _firsts((one.astype(np.uint64), two), block.ids, doc.astype(np.int64), start)
    symbols = (one[head].astype(np.uint64), two[head], low)
    return found, (anchors, of, n > 1), (symbols, of_long, repeat)


def _ask(width: int, bits: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, (anchors, _, twice), (symbols, _, _) = _asked(Block(row), width, bits)
                a, s = blobs.cuts(anchors, buckets), blobs.cuts(symbols[0], buckets)
                at = [i for i in range(buckets) if a[i] < a[i + 1] or s[i] < s[i + 1]]
                keys = [blobs.pack(anchors[a[i] : a[i + 1]], twice[a[i] : a[i + 1]].astype(np.uint8)) for i in at]
                more = [blobs.pack(*(x[s[i] : s[i + 1]] for x in symbols)) for i in at]
                columns = [pa.array([row["block"]] * len(at), pa.int64()), pa.array(at, pa.int32())]
                columns += [pa.array(x, pa.binary()) for x in (keys, more)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "keys", "more"])

    return run


def _split(values: np.ndarray, parts: list) -> list[bytes]:
    ends = np.cumsum([len(p[0]) for p in parts])
    return [blobs.pack(x) for x in np.split(values.astype(np.uint8), ends[:-1])]


def _shared(parts: list) -> np.ndarray:
    """Of the blocks' anchors: whether any occurs a second time."""
    key, twice = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, of, n = np.unique(key, return_inverse=True, return_counts=True)
    often = np.bincount(of, weights=twice, minlength=len(n)) + n > 1
    return often[of]


def _later(parts: list) -> np.ndarray:
    """Of the blocks' keys: whether a smaller document of another block has it."""
    one, two, low = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((low, two, one))
    o, t, d = one[order], two[order], low[order]
    new = np.r_[np.ones(min(1, len(o)), bool), (o[1:] != o[:-1]) | (t[1:] != t[:-1])]
    least = d[new][np.cumsum(new) - 1]
    out = np.zeros(len(order), bool)
    out[order] = d > least
    return out


def _symbols_reply(frame: pd.DataFrame) -> pd.DataFrame:
    anchors = [blobs.unpack(k, "<u8", "u1") for k in frame["keys"]]
    symbols = [blobs.unpack(k, "<u8", "<u4", "<i8") for k in frame["more"]]
    columns = {"block": frame["block"], "bucket": frame["bucket"]}
    return pd.DataFrame({**columns, "reply": _split(_shared(anchors), anchors), "more": _split(_later(symbols), symbols)})


def _windows_reply(frame: pd.DataFrame) -> pd.DataFrame:
    keys = [blobs.unpack(k, "<u8", "<u4", "<i8") for k in frame["keys"]]
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "reply": _split(_later(keys), keys)})


def _joined(table: pa.Table, column: str) -> np.ndarray:
    replies = sorted(zip(table.column("bucket").to_pylist(), table.column(column).to_pylist(), strict=True))
    return np.concatenate([blobs.unpack(r, "u1")[0] for _, r in replies] or [np.zeros(0, np.uint8)]).astype(bool)


def _first_row(table: pa.Table) -> dict:
    return {name: table.column(name)[0].as_py() for name in table.column_names}


def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n words lie in one of the spans."""
    depth = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(depth[:n]) > 0


_STATE = "block long, bucket int, state binary, keys binary"


def _settle(width: int, bits: int, buckets: int):
    """A block's words that long symbols cover, and what it asks for its open windows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = _first_row(left)
        block = Block(row)
        found, (_, of_anchor, _), ((_, _, _), of_long, repeat) = _asked(block, width, bits)
        shared, later = _joined(right, "reply"), _joined(right, "more")
        n = len(block.codes)
        _, _, start, end, _ = found.long
        gone = repeat | later[of_long] if len(of_long) else np.zeros(0, bool)
        start, end = start[gone].astype(np.int64), end[gone].astype(np.int64)
        # The furthest end of a covered symbol that starts at or before each word.
        far = np.zeros(n + 1, np.int64)
        np.maximum.at(far, start, end)
        far = np.maximum.accumulate(far)
        window = found.window
        open_ = far[window] < window + width
        if len(window):
            open_ &= shared[of_anchor[found.anchor]]
        rows = np.flatnonzero(open_)
        window = window[rows]
        one, two = block.window_names(window, width, rows)
        two = (two >> _U(32)).astype(np.uint32)
        head, low, of, again = _firsts((one, two), block.ids, block.doc[window], window)
        # What is known is kept as flags: covered words, open windows, and repeats among them.
        state = np.zeros(n, np.uint8)
        state[_covered(n, start, end)] = 1
        state[window] |= 2
        state[window[again]] |= 4
        one, two = one[head], two[head]
        edges = blobs.cuts(one, buckets)
        at = [i for i in range(buckets) if edges[i] < edges[i + 1]]
        keys = [blobs.pack(*(x[edges[i] : edges[i + 1]] for x in (one, two, low))) for i in at]
        return pa.table(
            {
                "block": pa.array([row["block"]] * (len(at) + 2), pa.int64()),
                "bucket": pa.array([-2, -1, *at], pa.int32()),
                "state": pa.array([blobs.pack(state), blobs.pack(of.astype(np.uint32)), *[None] * len(at)], pa.binary()),
                "keys": pa.array([None, None, *keys], pa.binary()),
            }
        )

    return run


def _cut(schema: pa.Schema, width: int, with_text: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = _first_row(left)
        block = Block(row)
        n = len(block.codes)
        known = dict(zip(right.column("bucket").to_pylist(), right.column("reply").to_pylist(), strict=True))
        state = blobs.unpack(known.pop(-2), "u1")[0] if -2 in known else np.zeros(n, np.uint8)
        of = blobs.unpack(known.pop(-1), "<u4")[0] if -1 in known else np.zeros(0, np.uint32)
        later = np.concatenate([blobs.unpack(known[b], "u1")[0] for b in sorted(known)] or [np.zeros(0, np.uint8)])
        window = np.flatnonzero(state & 2)
        hit = (state[window] & 4) > 0
        if len(window):
            hit |= later[of] > 0
        gone = (state & 1) > 0
        gone |= _covered(n, window[hit], window[hit] + width)
        total = np.r_[0, np.cumsum(gone)]
        rest = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["rest"])).read_all()
        kept = []
        for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
            kept.append(b" ".join([block.words[c] for c in block.codes[a:b][~gone[a:b]].tolist()]))
        columns = [
            *rest.columns,
            pa.array(block.lengths),
            pa.array((total[block.ends] - total[block.starts]).astype(np.int64)),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ]
        if with_text:
            columns.append(pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()))
            columns.append(pa.array([_spans(gone[a:b]) for a, b in zip(block.starts, block.ends, strict=True)], schema.field("removed").type))
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _spans(gone: np.ndarray) -> list[dict]:
    """Maximal removed runs as first word and the word after the last."""
    edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
    return [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def deduplicate(
    docs: DataFrame,
    *,
    width: int = 20,
    with_text: bool = False,
    carry: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, *carry, n_words, n_removed, kept_sha256[, kept_text, removed]`` for every row.

    ``removed`` lists the removed runs of words as ``start, end``. ``width`` is
    from 2 to 2048 words.
    """
    if not 2 <= width <= 2048:
        raise ValueError("width must be from 2 to 2048")
    ready(docs)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("double"))).first()[0]
    buckets = max(16, -(-int(size or 0) // BUCKET_BYTES))
    bits = min(60, max(32, int(size or 0).bit_length() + 6))  # few anchors meet another of the same key
    carried = [c for c in carry or [] if c not in (id_col, text_col)]
    rows = docs.select(
        F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text"), *(F.col(c) for c in carried)
    )
    blocks = keep(rows.mapInArrow(_encode, _BLOCK), "word-blocks")
    narrow = blocks.drop("rest")
    asked = narrow.mapInArrow(_ask(width, bits, buckets), "block long, bucket int, keys binary, more binary")
    replies = blobs.answer(asked, _symbols_reply, "block long, bucket int, reply binary, more binary")
    state = narrow.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_settle(width, bits, buckets), _STATE)
    state = keep(state, "open-windows")
    asked = state.where("keys IS NOT NULL").select("block", "bucket", "keys")
    replies = blobs.answer(asked, _windows_reply, "block long, bucket int, reply binary")
    told = replies.unionByName(state.where("state IS NOT NULL").select("block", "bucket", F.col("state").alias("reply")))
    result = [*rows.drop("_text").schema.fields, *StructType.fromDDL("n_words long, n_removed long, kept_sha256 string").fields]
    if with_text:
        result += StructType.fromDDL("kept_text string, removed array<struct<start: long, end: long>>").fields
    result = StructType([StructField(f.name, f.dataType, True) for f in result])
    cut = _cut(to_arrow_schema(result), width, with_text)
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(cut, result)

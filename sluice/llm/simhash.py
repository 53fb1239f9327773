"""SimHash fingerprints and near-duplicates within a bit distance.

Two fingerprints of eight bytes within ``max_bits`` bits differ in at most
``max_bits`` bytes, so at least ``8 - max_bits`` bytes agree in place. The
inverted index is kept by byte positions: for the postings not to grow with a
single byte's 256 values, a posting's key is a set of positions with their
bytes, from a family such that every choice of ``8 - max_bits`` positions holds
a set of the family. Pairs that meet in a posting are tallied (agreeing
positional bytes), kept if they reach the guaranteed count, and verified by bit
distance. Equal fingerprints are one class before all this; a posting with
many fingerprints is dealt out in squares of bounded size; tasks hand on
spanning forests, never all pairs.

The shingles of a text of any length are counted whole, some at a time. A null
text, or one without words, has fingerprint zero and is linked like any other;
an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import components, keep, ready

SEED = 42
BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def fingerprint(text: str | None, words: int = 3) -> int:
    """A bit is 1 if over half of the shingles' XXH64 have it; no words: 0."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        hi = min(n, lo + 65536)
        hashes = np.fromiter(
            (digest(b" ".join(tokens[i : i + words]), SEED) for i in range(lo, hi)), np.uint64, hi - lo
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, fp`` for every row: a hash of the text, and the 64 bits as a signed long."""
    ready(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint(t.as_py(), words) for t in batch.column(1))
            fps = np.fromiter(found, np.uint64, len(batch)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:1], batch.column(2), pa.array(fps)], names=["doc_id", "digest", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), digest(text_col).alias("digest"))
    return rows.mapInArrow(run, "doc_id long, digest long, fp long")


def digest(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions; any ``8 - max_bits`` positions hold one of them.

    The eight positions fall into equal halves, thirds or eighths; as one part
    of them must hold its share of the agreeing positions, all subsets of that
    size within the parts do. The family with the longest keys wins.
    """
    agreeing = 8 - max_bits
    best: list[tuple[int, ...]] = []
    for parts in range(1, 8):
        groups = [tuple(int(x) for x in g) for g in np.array_split(np.arange(8), parts)]
        share = -(-agreeing // parts)
        sets = [s for g in groups for s in itertools.combinations(g, share) if len(g) >= share]
        if len(sets) <= 16 and (not best or share > len(best[0])):
            best = sets
    if agreeing < 1 or not best:
        raise ValueError("max_bits must be 7 or less")
    return best


def links(fps: DataFrame, *, max_bits: int = 3, square: int = 2048) -> DataFrame:
    """``a, b``: fingerprints (distinct, column ``fp``) that link, as spanning forests.

    Every two fingerprints within ``max_bits`` are joined by a path of the
    links returned, each of which is within ``max_bits`` itself.
    """
    ready(fps)
    sets = position_sets(max_bits)
    keys = []
    for i, positions in enumerate(sets):
        mask = sum(0xFF << (8 * p) for p in positions)
        mask -= (mask >> 63) << 64  # as a signed long
        keys.append(F.struct(F.lit(i).alias("s"), F.col("fp").bitwiseAND(F.lit(mask)).alias("k")))
    posted = fps.select("fp", F.explode(F.array(*keys)).alias("p")).select("p.s", "p.k", "fp")
    sizes = posted.groupBy("s", "k").agg(F.count("*").alias("n")).where("n > 1")
    sides = F.ceil(F.col("n") / square).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("sides")).cast("int")
    dealt = (
        posted.join(sizes, ["s", "k"])
        .withColumn("sides", sides)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.expr("sequence(0, sides - 1)")))
        .select("s", "k", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")
    )
    squares = ["s", "k", "i", "j"]
    placed = dealt.repartition(*squares).sortWithinPartitions(*squares, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            starts = np.flatnonzero(np.r_[True, (rows[1:, :4] != rows[:-1, :4]).any(1)])
            yield _edges(rows[: starts[-1]], starts[:-1], max_bits)
            rest = rows[starts[-1] :]
        if rest is not None:
            yield _edges(rest, np.array([0]), max_bits)

    return placed.mapInArrow(run, "a long, b long").distinct()


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then bit distance."""
    bits = BITS[(a ^ b).view(np.uint8)].reshape(len(a), 8)
    tally = (bits == 0).sum(1)
    return (tally >= 8 - max_bits) & (bits.sum(1) <= max_bits)


def _edges(rows: np.ndarray, starts: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links within runs of rows of one square; runs are at most two sides long."""
    fps = np.ascontiguousarray(rows[:, 4])
    sizes = np.diff(np.r_[starts, len(rows)])
    left, right = [], []
    run = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat(sizes <= 8, sizes)
    some, run = fps[small], run[small]
    for step in range(1, 8):
        same = np.flatnonzero(run[step:] == run[:-step]) if len(some) > step else np.array([], int)
        same = same[_near(some[same], some[same + step], max_bits)]
        left.append(some[same])
        right.append(some[same + step])
    for start, size in zip(starts[sizes > 8], sizes[sizes > 8], strict=True):
        for a, b in _forest(fps[start : start + size], max_bits):
            left.append(a)
            right.append(b)
    left, right = (np.concatenate(x) if x else np.array([], np.int64) for x in (left, right))
    return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["a", "b"])


def _forest(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Breadth-first trees over one square's fingerprints: each is reached once."""
    waiting = fps
    while len(waiting) > 1:
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            at = front.pop()
            near = _near(np.full(len(waiting), at), waiting, max_bits)
            reached, waiting = waiting[near], waiting[~near]
            yield np.full(len(reached), at), reached
            front.extend(reached.tolist())


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept`` for every row.

    Fingerprints link at ``max_bits`` or fewer differing bits; a document
    without words (null, empty, blank) has fingerprint 0 and links like any
    other. ``component_id`` is the smallest id reachable, null only if no
    reachable row has an id; ``kept`` says whether it is the row's own (rows
    that repeat an id are all kept or all left). Other columns are left out.
    """
    marked, centred = _grouped(docs, words, max_bits, id_col, text_col)
    firsts = centred.groupBy("centre").agg(F.min("first.doc_id").alias("component_id"))
    named = centred.join(firsts, "centre").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _grouped(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints; and per fingerprint its first row and its component's centre."""
    marked = keep(fingerprints(docs, words=words, id_col=id_col, text_col=text_col), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    classes = keep(marked.groupBy("fp").agg(F.min(row).alias("first")), "classes")
    joined = components(keep(links(classes.select("fp"), max_bits=max_bits), "near"))
    joined = joined.select(F.col("node").alias("fp"), F.col("component").alias("centre"))
    centred = classes.join(joined, "fp", "left").select("fp", "first", F.coalesce("centre", "fp").alias("centre"))
    return marked, keep(centred, "centred")


def survivors(
    docs: DataFrame, *, words: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns.

    The row with the smallest id stays (null comes last; of several texts with
    that id, one by their hash; of rows equal in both, any one).
    """
    _, centred = _grouped(docs, words, max_bits, id_col, text_col)
    first = centred.groupBy("centre").agg(F.min("first").alias("first"))

    def slot(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("null"))

    wanted = keep(first.select(slot("first.doc_id").alias("slot"), F.col("first.digest").alias("digest")), "survivors")
    # As one column, the rows' own names cannot clash with the keys'.
    rows = docs.select(F.struct("*").alias("row"), slot(id_col).alias("slot"), digest(text_col).alias("digest"))
    return rows.join(wanted, ["slot", "digest"], "left_semi").dropDuplicates(["slot", "digest"]).select("row.*")

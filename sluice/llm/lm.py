"""Language-model scoring by deleted interpolation.

The probability of a word after its predecessor mixes maximum-likelihood
estimates: bigram c(v,w)/c(v), unigram c(w)/N, and the uniform 1/(V+1). The
weights of the mixture depend on a bucket of the context's frequency c(v). They
are learned by expectation-maximisation on held-out counts: for the tokens of
each training document, the counts of the whole training corpus with that
document deleted. For scores, all training counts are used.

``order=3`` mixes the trigram estimate c(u,v,w)/c(u,v) with that probability in
turn; its weights depend on a bucket of c(u,v) and are learned in the same way,
in a second pass, as they need the first weights. A first word has the start
context alone before it, at either order.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z in lower case;
each document ends in one end token and starts after a start context that
occurs once per document. A null or empty text is the end token alone. Ids may
be null or repeat; every row is a document. Without training rows N and V are
0, and every token has probability 1. A text of any length is read whole, in one
block; an empty table gives no rows. Other columns are left out.

How it runs: documents become blocks of token numbers, written once. Each block
asks for the counts of its distinct words and bigrams (``sluice.llm.blobs``);
the answers meet the block again, which turns them into counts per token and
into a histogram of (frequency bucket, bigram estimate, unigram estimate), in
steps of a quarter octave, with the sums of either estimate per cell. EM runs
on that histogram, whose size does not depend on the corpus.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import blobs
from sluice.llm.common import held_out, keep, ready

START = np.uint64(0x9E3779B97F4A7C15)  # the hash of the start context
END = b"\n"  # no word holds it
BUCKETS = 40  # of context frequency, by powers of two
STEPS = 4 * 48  # of an estimate, by quarter octaves; 0 is a step of its own
_BLOCK = "block long, ids array<long>, lengths array<int>, train array<boolean>, tokens binary, hashes binary"
_CODES = (
    "block long, ids array<long>, lengths array<int>, train array<boolean>, counts binary, starts long, "
    "cells array<long>, n array<long>, p2 array<double>, p1 array<double>"
)
_TOP_CELLS = "cells array<long>, n array<long>, p3 array<double>, p2 array<double>"


def tokenize(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split() + [END]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks: token numbers into the block's ascending word hashes."""
    first = TaskContext.get().partitionId() << 33
    rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True))
    for number, block in enumerate(blobs.batches_of(rows, lambda row: 64 + len(row[1].as_py() or ""))):
        known: dict[bytes, int] = defaultdict(count().__next__)
        tokens, lengths = [], []
        for _, text, _ in block:
            words = tokenize(text.as_py())
            lengths.append(len(words))
            tokens.append(np.fromiter((known[w] for w in words), np.int32, len(words)))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
        order = np.argsort(hashes)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([first + number], pa.int64()),
                pa.array([[r[0] for r in block]], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int32())),
                pa.array([[r[2] for r in block]], pa.list_(pa.bool_())),
                pa.array([blobs.pack(place[np.concatenate(tokens)])], pa.binary()),
                pa.array([blobs.pack(hashes[order])], pa.binary()),
            ],
            names=["block", "ids", "lengths", "train", "tokens", "hashes"],
        )


class Block:
    """A block's tokens, their predecessors, and its distinct bigrams (and trigrams) by key."""

    def __init__(self, lengths, train, tokens: bytes, hashes: bytes, order: int = 2):
        self.lengths = np.asarray(lengths, np.int64)
        self.tokens = blobs.unpack(tokens, "<u4")[0].astype(np.int64)
        self.hashes = blobs.unpack(hashes, "<u8")[0]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.train = np.repeat(np.asarray(train, bool), self.lengths)
        self.words = len(self.hashes)
        self.previous = np.r_[0, self.tokens[:-1]]
        self.previous[self.starts] = self.words  # the start context
        self.keys, self.pair = self._keyed(self.previous, self.hashes)
        #: Per family of keys: ascending keys, and each token's place among them.
        self.families = [(self.hashes, self.tokens), (self.keys, self.pair)]
        if order == 3:
            self.before = np.r_[0, self.pair[:-1]]  # the bigram that ends before the token
            self.before[self.starts] = len(self.keys)
            self.families.append(self._keyed(self.before, self.keys))

    def _keyed(self, context: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (context, token) by ascending key, and each token's place among them."""
        both, back = np.unique(context * self.words + self.tokens, return_inverse=True)
        keys = _mix(np.r_[hashes, START][both // self.words], self.hashes[both % self.words])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return keys[order], place[back]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + b * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) & np.uint64(0xFFFFFFFFFFFFFF00)  # 56 bits


def _ask(buckets: int, order: int):
    """Words go to the buckets from 0, bigrams to those from ``buckets``, trigrams to those after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["lengths"], row["train"], row["tokens"], row["hashes"], order)
                at, sent = [], []
                for family, (keys, index) in enumerate(block.families):
                    counts = np.bincount(index[block.train], minlength=len(keys)).astype(np.uint32)
                    edges = blobs.cuts(keys, buckets)
                    for i in range(buckets):
                        lo, hi = edges[i], edges[i + 1]
                        if lo < hi:
                            at.append(family * buckets + i)
                            sent.append(blobs.pack(keys[lo:hi], counts[lo:hi]))
                columns = [pa.array([row["block"]] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(sent, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "keys"])

    return run


def _total(frame: pd.DataFrame) -> pd.DataFrame:
    """Each key's count over all blocks; the first row tells of the bucket's words."""
    parts = [blobs.unpack(k, "<u8", "<u4") for k in frame["keys"]]
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    totals = np.bincount(back, np.concatenate([c for _, c in parts]), len(keys)).astype(np.uint64)
    ends = np.cumsum([len(k) for k, _ in parts])
    replies = [blobs.pack(totals[b]) for b in np.split(back, ends[:-1])]
    rest = [0] * (len(frame) - 1)
    return pd.DataFrame(
        {
            "block": frame["block"],
            "bucket": frame["bucket"],
            "reply": replies,
            "types": [int((totals > 0).sum()), *rest],
            "tokens": [int(totals.sum()), *rest],
        }
    )


def _step(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.clip(-4 * np.log2(p), 0, STEPS - 1), 0).astype(np.int64)


def bucket_of(c: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 + floor(log2), at most ``BUCKETS - 1``."""
    return np.minimum(np.frexp(c.astype(np.float64))[1], BUCKETS - 1)


def _own(doc: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    """For each token, how often its index occurs in its document."""
    _, back, n = np.unique(doc * size + index, return_inverse=True, return_counts=True)
    return n[back]


def _answers(right: pd.DataFrame, buckets: int, order: int) -> list[np.ndarray]:
    """A block's counts per family, in order of its keys."""
    replies = dict(zip(right["bucket"], right["reply"], strict=True))
    families = [range(f * buckets, (f + 1) * buckets) for f in range(order)]
    return [np.concatenate([blobs.unpack(replies[b], "<u8")[0] for b in f if b in replies]).astype(np.int64) for f in families]


def _starts(block: Block, words: np.ndarray) -> int:
    """The start context's count: that of the end."""
    return int(words[np.searchsorted(block.hashes, np.uint64(xxhash.xxh64_intdigest(END)))])


def _deleted(block: Block, words: np.ndarray, bigrams: np.ndarray, total: int):
    """For each training token, with its document deleted: the context's count, bigram and unigram estimate."""
    t = block.train
    context = np.r_[words, _starts(block, words)][block.previous]
    lengths = np.repeat(block.lengths, block.lengths)[t]
    two = bigrams[block.pair][t] - _own(block.doc[t], block.pair[t], len(block.keys))
    c = context[t] - _own(block.doc[t], block.previous[t], block.words + 1)
    one = words[block.tokens][t] - _own(block.doc[t], block.tokens[t], block.words)
    return c, two / np.maximum(c, 1), one / np.maximum(total - lengths, 1)


def _histogram(c: np.ndarray, high: np.ndarray, low: np.ndarray):
    """Cells of (bucket of c, step of either estimate): numbers and sums."""
    cell = (bucket_of(c) * STEPS + _step(high)) * STEPS + _step(low)
    cells, back, n = np.unique(cell, return_inverse=True, return_counts=True)
    return cells, n, *(np.bincount(back, p, len(cells)) for p in (high, low))


def _counted(total: int, buckets: int, order: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        families = _answers(right, buckets, order)
        for row in left.itertuples():
            block = Block(row.lengths, row.train, row.tokens, row.hashes, order)
            cells = _histogram(*_deleted(block, *families[:2], total))
            counts = [found[index].astype(np.uint64) for found, (_, index) in zip(families, block.families, strict=True)]
            starts = _starts(block, families[0])
            out.append((row.block, row.ids, row.lengths, row.train, blobs.pack(*counts), starts, *cells))
        return pd.DataFrame(out, columns=[part.split()[0] for part in _CODES.split(", ")])

    return run


def _top_counted(weights: np.ndarray, total: int, types: int, buckets: int):
    """Cells of the trigram estimates and what the lower orders give, each with its document deleted."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        words, bigrams, trigrams = _answers(right, buckets, 3)
        for row in left.itertuples():
            block = Block(row.lengths, row.train, row.tokens, row.hashes, 3)
            c, p2, p1 = _deleted(block, words, bigrams, total)
            w2, w1, w0 = weights[:, bucket_of(c)]
            t, (keys, place) = block.train, block.families[2]
            three = trigrams[place][t] - _own(block.doc[t], place[t], len(keys))
            pair = np.r_[bigrams, _starts(block, words)][block.before][t]
            pair = pair - _own(block.doc[t], block.before[t], len(block.keys) + 1)
            out.append(_histogram(pair, three / np.maximum(pair, 1), w2 * p2 + w1 * p1 + w0 / (types + 1)))
        return pd.DataFrame(out, columns=[part.split()[0] for part in _TOP_CELLS.split(", ")])

    return run


def mixture(cells: np.ndarray, n: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float, rounds: int = 50) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per frequency bucket, by EM on the cells."""
    estimates = np.stack([p2 / n, p1 / n, np.full(len(n), p0)])
    # No weight of a word's way out is 0.
    return _learned(cells, n, estimates, [[0.5], [0.4], [0.1]], [[0.0], [0.5], [0.5]], rounds)


def top_mixture(cells: np.ndarray, n: np.ndarray, p3: np.ndarray, p2: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights (trigram, lower orders) per frequency bucket."""
    return _learned(cells, n, np.stack([p3 / n, p2 / n]), [[0.5], [0.5]], [[0.0], [0.5]], rounds)


def _learned(cells, n, estimates: np.ndarray, first: list, added: list, rounds: int) -> np.ndarray:
    bucket = cells // (STEPS * STEPS)
    weights = np.tile(first, (1, BUCKETS))
    for _ in range(rounds):
        share = weights[:, bucket] * estimates
        share *= n / share.sum(0)
        found = np.stack([np.bincount(bucket, s, BUCKETS) for s in share])
        found = found + np.array(added)
        weights = found / found.sum(0)
    return weights


def _cells(df: DataFrame, high: str, low: str) -> list[np.ndarray]:
    """The histogram of all blocks; its size does not depend on the corpus."""
    each = df.select(F.explode(F.arrays_zip("cells", "n", high, low)).alias("c"))
    sums = each.groupBy("c.cells").agg(*[F.sum(f"c.{x}").alias(x) for x in ("n", high, low)])
    found = sums.toPandas().sort_values("cells")
    return [found[c].to_numpy() for c in ("cells", "n", high, low)]


def _scored(weights: np.ndarray, top: np.ndarray | None, total: int, types: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = blobs.unpack(row["counts"], *["<u8"] * (2 if top is None else 3))
                one, two, *three = (x.astype(np.float64) for x in held)
                lengths = np.asarray(row["lengths"], np.int64)
                at = np.cumsum(lengths) - lengths
                context = np.r_[0.0, one[:-1]]
                context[at] = row["starts"]
                w2, w1, w0 = weights[:, bucket_of(context)]
                p = w2 * two / np.maximum(context, 1) + w1 * one / max(total, 1) + w0 / (types + 1)
                if top is not None:
                    pair = np.r_[0.0, two[:-1]]
                    pair[at] = row["starts"]
                    w3, rest = top[:, bucket_of(pair)]
                    p = w3 * three[0] / np.maximum(pair, 1) + rest * p
                base = np.log10((one + 1) / (total + types + 1))
                score = np.log10(p) if total else np.zeros(len(p))
                columns = [
                    pa.array(row["ids"], pa.int64()),
                    pa.array([not x for x in row["train"]], pa.bool_()),
                    pa.array(lengths),
                    pa.array(np.add.reduceat((one > 0).astype(np.int64), at)),
                    pa.array(np.full(len(lengths), total, np.int64)),
                    pa.array(np.add.reduceat(base, at)),
                    pa.array(np.add.reduceat(score, at)),
                ]
                names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def score(
    docs: DataFrame, *, order: int = 2, id_col: str = "doc_id", text_col: str = "text", hold: tuple[int, int] = (7, 2)
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Learns from the rows that are not held out (``hold``: modulus and
    remainder of crc32 of the id as text). ``base_score`` is that of add-one
    unigrams, ``score`` the model's of ``order`` two or three, both as log10.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = ready(docs)
    buckets = blobs.n_buckets(docs, text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (~held_out(id_col, *hold)).alias("train")
    )
    blocks = keep(rows.mapInArrow(_encode, _BLOCK), "lm-blocks")
    asked = blocks.mapInArrow(_ask(buckets, order), "block long, bucket int, keys binary")
    replies = keep(
        blobs.answer(asked, _total, "block long, bucket int, reply binary, types long, tokens long"), "lm-replies"
    )
    known = replies.where(F.col("bucket") < buckets).agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    types, total = known.types or 0, known.tokens or 0
    met = blocks.groupBy("block").cogroup(replies.select("block", "bucket", "reply").groupBy("block"))
    codes = keep(met.applyInPandas(_counted(total, buckets, order), _CODES), "lm-counts")

    weights, top = mixture(*_cells(codes, "p2", "p1"), 1 / (types + 1)), None
    if order == 3:
        top = top_mixture(*_cells(met.applyInPandas(_top_counted(weights, total, types, buckets), _TOP_CELLS), "p3", "p2"))
    plain = codes.select("ids", "lengths", "train", "counts", "starts")
    return plain.mapInArrow(
        _scored(weights, top, total, types),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )

"""Looking keys up across blocks of documents.

A block is a bounded batch of documents that one task has read. To learn
something about its keys (hashes of n-grams, of passages) over all blocks, it
sends each *bucket* (a range of hash values) one blob with its distinct keys in
ascending order. The bucket's task sees the blobs of all blocks and sends one
blob back for each, aligned with what it got. So keys are pre-aggregated before
the shuffle, take a few bytes each, and a key held by a third of the documents
is still one entry per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20


def n_buckets(docs: DataFrame, text_col: str) -> int:
    """One bucket for each 8 MiB of text, 16 at least."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("double"))).first()[0]
    return max(16, -(-int(total or 0) // BUCKET_BYTES))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, each as planes of bytes that compress alone.

    Ascending hashes lose their leading bytes that way, small counts all but one.
    """
    planes = [np.ascontiguousarray(a[:, None].view(np.uint8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    widths = [np.dtype(t).itemsize for t in types]
    n, at, found = len(data) // sum(widths), 0, []
    for t, width in zip(types, widths, strict=True):
        planes = data[at : at + n * width].reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(t))
        at += n * width
    return found


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of ascending 64-bit keys starts, and the end."""
    step = (1 << 64) // buckets
    firsts = np.array([i * step for i in range(1, buckets)], np.uint64)
    return np.r_[0, np.searchsorted(keys, firsts), len(keys)]


def batches_of(rows: Iterator[tuple], size: Callable[[tuple], int]) -> Iterator[list[tuple]]:
    """Rows in lists of about ``BLOCK_BYTES``; a longer row is a list of its own."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BLOCK_BYTES:
            yield held
            held, total = [], 0
    if held:
        yield held


def answer(requests: DataFrame, reply: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Runs ``reply`` on the rows ``block, bucket, keys`` of each bucket."""
    return requests.groupBy("bucket").applyInPandas(reply, schema)

"""Sum-of-squares online packing of tokenized documents into sequences.

Each document becomes token ids and a closing id. Whole windows are cut off
it; what remains is placed online: into the fill level for which the sum of
the squared counts of partly filled windows, kept in a level array, grows
least (a new window is level 0; ties go to the fullest level). At most
``max_open`` windows stay open in a task. Beyond that, and at the end of the
task's rows, the open windows are closed by cutting the emptiest up to fill the
fullest; what is left over at the end is cut into windows whose lengths are
powers of two, so that no window is padded.

Packing needs no shuffle: each task packs the rows it reads. Sequence ids are
unique across tasks and repeatable for a table read from files; after other
operators, write the table first.

A null or empty text is a document of the closing id alone. Null and repeated
document ids are kept as they are; every row is its own document. An empty
table gives no pieces. Other columns are left out.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ready

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


class Encoder:
    """Token ids of a text by ``tokenizers``.

    Where the same vocabulary is given as ranks as well, texts of Latin
    characters go through ``tiktoken``, which is about four times as fast and
    gives the same ids there; all others, and texts that hold a special token,
    go through ``tokenizers``.
    """

    def __init__(self, spec: dict):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(spec["tokenizer"])
        self.quick = None
        if spec["ranks"]:
            import tiktoken

            pairs = (line.split() for line in spec["ranks"].splitlines())
            ranks = {base64.b64decode(a): int(b) for a, b in pairs}
            self.quick = tiktoken.Encoding("ranks", pat_str=spec["pattern"], mergeable_ranks=ranks, special_tokens={})
            special = [re.escape(t.content) for t in self.exact.get_added_tokens_decoder().values()]
            self.odd = re.compile("|".join(["[^\x00-ɏ]", *special]))

    def __call__(self, text: str | None, end_id: int) -> np.ndarray:
        if not text:
            return np.array([end_id], "<u4")
        if self.quick and not self.odd.search(text):
            ids = self.quick.encode_ordinary(text)
        else:
            ids = self.exact.encode(text, add_special_tokens=False).ids
        ids.append(end_id)
        return np.array(ids, "<u4")


class Packer:
    """One task's windows. A piece is ``[doc_id, start, ids, doc_tokens]``."""

    def __init__(self, size: int, max_open: int, first_id: int):
        self.size, self.max_open, self.next_id = size, max_open, first_id
        self.levels = np.zeros(size, np.int64)
        self.windows: dict[int, list[list]] = {}
        self.n_open = 0
        self.out: list[tuple] = []

    def emit(self, pieces: list) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            crc = zlib.crc32(ids.tobytes())
            self.out.append((doc_id, start, len(ids), crc, total, self.next_id, at))
            at += len(ids)
        self.next_id += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.size
        for at in range(0, whole, self.size):
            self.emit([[doc_id, at, ids[at : at + self.size], n]])
        if whole < n:
            self.place([doc_id, whole, ids[whole:], n])

    def place(self, piece: list) -> None:
        s = len(piece[2])
        counts = self.levels
        best, level = 2 * counts[s] + 1, 0
        if self.n_open:
            at = np.flatnonzero(counts[1 : self.size - s + 1]) + 1
            if len(at):
                after = at + s
                gain = 1 - 2 * counts[at] + np.where(after < self.size, 2 * counts[after % self.size] + 1, 0)
                i = len(at) - 1 - int(np.argmin(gain[::-1]))
                if gain[i] <= best:
                    level = int(at[i])
        window = self._take(level) if level else []
        window.append(piece)
        if level + s == self.size:
            self.emit(window)
        else:
            self._put(level + s, window)
        if self.n_open > self.max_open:
            self.close(last=False)

    def _take(self, level: int) -> list:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.windows[level].pop()

    def _put(self, level: int, window: list) -> None:
        self.levels[level] += 1
        self.n_open += 1
        self.windows.setdefault(level, []).append(window)

    def close(self, last: bool) -> None:
        """Fills the fullest windows with what is cut off the emptiest."""
        left = [w for level in sorted(self.windows) for w in self.windows[level]]
        self.windows, self.n_open = {}, 0
        self.levels[:] = 0
        loose: list[list] = []  # pieces of the emptiest windows, yet to be placed
        while left:
            window = left.pop()
            gap = self.size - sum(len(p[2]) for p in window)
            while gap and (loose or left):
                if not loose:
                    loose = left.pop(0)
                doc_id, start, ids, total = loose.pop()
                if len(ids) > gap:
                    loose.append([doc_id, start, ids[:-gap], total])
                    start, ids = start + len(ids) - gap, ids[-gap:]
                window.append([doc_id, start, ids, total])
                gap -= len(ids)
            if gap == 0:
                self.emit(window)
            elif last:
                self._binary(window)
            else:
                self._put(self.size - gap, window)
            if loose and not left:
                left, loose = [loose], []

    def _binary(self, window: list) -> None:
        """Windows of falling powers of two: one for each bit of the length."""
        length = sum(len(p[2]) for p in window)
        pieces = window[::-1]
        for bit in range(length.bit_length() - 1, -1, -1):
            want = length & (1 << bit)
            part = []
            while want:
                doc_id, start, ids, total = pieces.pop()
                if len(ids) > want:
                    pieces.append([doc_id, start + want, ids[want:], total])
                    ids = ids[:want]
                part.append([doc_id, start, ids, total])
                want -= len(ids)
            if part:
                self.emit(part)

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) or [()] * len(_NAMES)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    ranks: str | None = None,
    pattern: str | None = None,
    sequence: int = 1024,
    end_id: int = 0,
    max_open: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents and their places: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the path of a tokenizers file, ``ranks`` and ``pattern``
    the same vocabulary for tiktoken; both are read on the driver and
    broadcast, a few MB whatever the input. ``sequence`` is a power of two.
    """
    if sequence & (sequence - 1) or sequence < 1:
        raise ValueError("sequence must be a power of two")
    spark = ready(docs)
    spec = {"tokenizer": _read(tokenizer), "ranks": _read(ranks) if ranks else None, "pattern": pattern}
    shared = spark.sparkContext.broadcast(spec)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        packer = Packer(sequence, max_open, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, encoder(text.as_py(), end_id))
            yield packer.flush()
        packer.close(last=True)
        yield packer.flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(packed, SCHEMA)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()

"""Hashed character n-grams, labelled texts in shards, and rounds of averaged training."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import keep

PIECE = 1 << 18  # characters hashed at a time; bounds memory for very long texts
SHARD_BYTES = 64 << 20  # of text in a shard, about
LEAST_SHARDS = 8


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = (x * np.uint32(0x9E3779B1)) ^ (y + np.uint32(0x7F4A7C15)) * np.uint32(0x85EBCA77)
    return x ^ (x >> np.uint32(15))


def counted_grams(text: str | None, sizes: tuple[int, ...], bits: int, lower: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """The buckets, ascending, of a whole text's character n-grams, their counts, and its length.

    The text stands between two spaces, so an empty or null text has few, but
    defined, features.
    """
    text = f" {text or ''} "
    if lower:
        text = text.lower()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) <= PIECE:
        found, counts = np.unique(_hashes(codes, sizes, bits), return_counts=True)
        return found, counts, len(codes)
    counts = np.zeros(1 << bits, np.int64)
    for at in range(0, len(codes), PIECE):
        for n in sizes:  # a gram belongs to the piece it starts in
            here = _hashes(codes[at : at + PIECE + n - 1], (n,), bits)
            counts += np.bincount(here[:PIECE], minlength=1 << bits)
    found = np.flatnonzero(counts).astype(np.uint32)
    return found, counts[found], len(codes)


def _hashes(codes: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    found, run = [], _mix(codes, np.uint32([1]))
    for n in range(1, max(sizes) + 1):
        if n > 1:
            run = _mix(run[: len(codes) - n + 1], codes[n - 1 :])
        if n in sizes:
            found.append(run >> np.uint32(32 - bits))
    return np.concatenate(found)


def known_labels(labels: DataFrame, id_col: str, label_col: str, allowed: Column) -> DataFrame:
    """``id, label`` of all labelled ids.

    Null ids and labels are left out; an id with several labels has the largest.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    return known.where(allowed).groupBy("id").agg(F.max("label").alias("label"))


def labelled_texts(
    docs: DataFrame, known: DataFrame, id_col: str, text_col: str, allowed: Column, *, broadcast_rows: int = 1_000_000
) -> DataFrame:
    """``shard, id, label, text`` of all documents with a label; a file holds one shard, in order.

    The number of shards grows with the bytes of text, so a shard is bounded.
    Labels are broadcast up to ``broadcast_rows`` of them, so the corpus is not
    shuffled; beyond that the allowed texts are. Texts are smaller than their
    features, which are worked out anew in each round.
    """
    n = known.count()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(allowed)
    usual = rows.agg(F.avg(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    shards = max(LEAST_SHARDS, math.ceil(n * usual / SHARD_BYTES))
    rows = rows.join(F.broadcast(known) if n <= broadcast_rows else known, "id")
    shard = F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards)).cast("int")
    rows = rows.select(shard.alias("shard"), F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "text")
    placed = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "id", "label", "text")
    return keep(placed, "labelled")


SLICE = 1 << 16  # numbers of an array that are added up in one task
_PART = "shard int, name string, part int, numbers binary"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard, which follow each other; one shard is held at a time."""
    now, held = None, []
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for start, end in zip(edges, edges[1:]):
            if start < end:
                if held and shards[start] != now:
                    yield now, pa.Table.from_batches(held)
                    held = []
                now = int(shards[start])
                held.append(batch.slice(start, end - start))
    if held:
        yield now, pa.Table.from_batches(held)


def added(rows: DataFrame, make: Callable[[pa.Table], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Runs ``make`` on each shard of ``labelled_texts`` where it lies and adds its arrays up, by name.

    The sums are made in slices by Spark, so the driver gets each array once,
    however many shards there are. Shards are added in their order, which
    makes the result the same in every run.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, table in _shards(batches):
            for name, numbers in make(table).items():
                cut = [numbers[at : at + SLICE].astype("<f4").tobytes() for at in range(0, len(numbers), SLICE)]
                n = len(cut)
                columns = {"shard": pa.array([shard] * n, pa.int32()), "name": pa.array([name] * n), "part": pa.array(range(n), pa.int32())}
                yield pa.RecordBatch.from_pydict(columns | {"numbers": pa.array(cut, pa.binary())})

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        numbers = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in frame["numbers"])
        first = frame.iloc[0]
        return pd.DataFrame({"name": [first["name"]], "part": [first["part"]], "numbers": [numbers.astype("<f4").tobytes()]})

    made = rows.mapInArrow(parts, _PART)
    sums = made.groupBy("name", "part").applyInPandas(total, "name string, part int, numbers binary").collect()
    found: dict[str, list] = {}
    for row in sorted(sums, key=lambda row: (row.name, row.part)):
        found.setdefault(row.name, []).append(np.frombuffer(row.numbers, "<f4"))
    return {name: np.concatenate(pieces).astype(np.float64) for name, pieces in found.items()}


Step = Callable[[dict, dict, Sequence[tuple], np.ndarray, int], dict]


def average_rounds(rows: DataFrame, params: dict, fixed: dict, featurize: Callable, step: Step, rounds: int) -> dict:
    """Parameter mixing: in each round every shard trains from the common
    parameters, and the results are averaged by the shards' rows.

    ``fixed`` goes with the parameters and stays as it is.
    """
    context = rows.sparkSession.sparkContext
    for number in range(rounds):
        shared = context.broadcast(({k: v.astype(np.float32) for k, v in params.items()}, fixed))
        sums = added(rows, _trainer(shared, featurize, step, number))
        if sums:
            params = {k: sums[k] / sums["rows"][0] for k in params}
        shared.destroy()
    return params


class _Featurized:
    """The features of texts, worked out as they are asked for: a shard's would not fit at once."""

    def __init__(self, texts: pa.ChunkedArray, featurize: Callable):
        self._texts, self._featurize = texts.combine_chunks(), featurize

    def __len__(self) -> int:
        return len(self._texts)

    def __getitem__(self, at: int) -> tuple:
        return self._featurize(self._texts[int(at)].as_py())


def _trainer(shared: Broadcast, featurize: Callable, step: Step, number: int) -> Callable[[pa.Table], dict]:
    def train(table: pa.Table) -> dict:
        params, fixed = shared.value
        params = {k: np.array(v, np.float64) for k, v in params.items()}
        new = step(params, fixed, _Featurized(table["text"], featurize), table["label"].to_numpy(), number)
        n = len(table)
        return {"rows": np.array([n]), **{k: v * n for k, v in new.items()}}

    return train

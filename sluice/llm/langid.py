"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector binds its
letters' vectors (elementwise product), each permuted (rotated) by its place;
a document bundles (adds up) the vectors of all n-grams of its whole text; a
language's prototype bundles the directions of its documents. A document has
the language whose prototype has the largest cosine with it (ties: the first
in order of name).

Text is lower-cased; everything that is not a letter separates words, and runs
of it count once. A text that is null or has no letter is ``und`` with score 0;
so is every text where nothing was learned. Null languages are not learned
from; null and repeated ids are kept. Texts of any length count whole, and an
empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import held_out, ready

N = 3
SYMBOLS = 4096  # 0 separates words; letters beyond share the symbols by hash
UNIT = 1 << 20
PIECE = 1 << 20
ROWS = 128


@cache
def _symbols() -> np.ndarray:
    letters = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]
    at = np.array(letters, np.int64)
    table = np.zeros(0x110000, np.uint16)
    table[at] = np.where(at < SYMBOLS, at, 1 + (at * 2654435761 >> 7) % (SYMBOLS - 1))
    return table


@cache
def _letters(dim: int, seed: int) -> np.ndarray:
    return (np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dim), np.int8) * 2 - 1).astype(np.int8)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the distinct n-grams and their counts; none if there is no letter."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not text:
        return codes, counts
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.r_[np.uint16(0), _symbols()[chars], np.uint16(0)].astype(np.int64)
    found = found[np.r_[True, (found[1:] | found[:-1]) > 0]]
    if len(found) < 3:
        return codes, counts
    for at in range(0, len(found) - N + 1, PIECE):
        part = found[at : at + PIECE + N - 1]
        new, n = np.unique(part[:-2] << 24 | part[1:-1] << 12 | part[2:], return_counts=True)
        codes, back = np.unique(np.r_[codes, new], return_inverse=True)
        counts = np.bincount(back, np.r_[counts, n]).astype(np.int64)
    return codes, counts


def vectors(texts: list[str | None], dim: int, seed: int) -> np.ndarray:
    """One bundled vector per text, zero where there is no letter."""
    letters = _letters(dim, seed)
    each = [ngrams(t) for t in texts]
    codes, column = np.unique(np.concatenate([c for c, _ in each]), return_inverse=True)
    row = np.repeat(np.arange(len(texts)), [len(c) for c, _ in each])
    counts = np.concatenate([n for _, n in each])
    bundled = np.zeros((len(texts), dim), np.float32)
    order = np.argsort(column, kind="stable")
    edges = np.searchsorted(column[order], np.arange(0, len(codes) + 4096, 4096))
    for k, at in enumerate(range(0, len(codes), 4096)):
        some = codes[at : at + 4096]
        bound = letters[some & 4095].copy()
        bound *= np.roll(letters, 1, axis=1)[some >> 12 & 4095]
        bound *= np.roll(letters, 2, axis=1)[some >> 24]
        here = order[edges[k] : edges[k + 1]]
        weights = np.zeros((len(texts), len(some)), np.float32)
        weights[row[here], column[here] - at] = counts[here]
        bundled += weights @ bound.astype(np.float32)
    return bundled


def _directions(texts: list[str | None], dim: int, seed: int) -> np.ndarray:
    found = vectors(texts, dim, seed)
    length = np.linalg.norm(found, axis=1, keepdims=True)
    return np.divide(found, length, out=np.zeros_like(found), where=length > 0)


def fit(
    docs: DataFrame,
    *,
    dim: int = 1024,
    seed: int = 7,
    max_langs: int = 10_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    hold: tuple[int, int] = (4, 2),
) -> dict:
    """``langs`` in order of name and their ``prototypes``, from all rows not held out.

    Directions are added as whole numbers, so the sums do not depend on the
    order of tasks. Tasks hand on one row per language and dimension.
    """
    ready(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                found = np.rint(_directions(part.column(1).to_pylist(), dim, seed) * UNIT).astype(np.int64)
                for lang, vector in zip(part.column(0).to_pylist(), found, strict=True):
                    sums[lang] = sums.get(lang, 0) + vector
        langs = sorted(sums)
        columns = [pa.array(langs, pa.string()), pa.array([sums[k].tolist() for k in langs], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "sums"])

    rows = docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col, *hold))
    parts = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    parts = parts.mapInArrow(run, "lang string, sums array<long>")
    total = parts.select("lang", F.posexplode("sums").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    prototypes: dict[str, np.ndarray] = {}
    for r in total.limit(max_langs * dim + 1).toLocalIterator():
        prototypes.setdefault(r.lang, np.zeros(dim))[r.at] = r.value
    if len(prototypes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(k for k, v in prototypes.items() if v.any())
    stacked = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in langs]).reshape(len(langs), dim)
    return {"langs": langs, "prototypes": stacked.astype(np.float32), "dim": dim, "seed": seed}


def predict(
    docs: DataFrame,
    model: dict,
    *,
    sharpness: float = 12.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    hold: tuple[int, int] = (4, 2),
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, cosine`` for every row.

    ``score`` is the best language's share after a softmax of the cosines. The
    model (a vector per language) is broadcast.
    """
    shared = ready(docs).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prototypes = np.array([*shared.value["langs"], "und"]), shared.value["prototypes"]
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                found = _directions(part.column(1).to_pylist(), shared.value["dim"], shared.value["seed"])
                cosines = found.astype(np.float64) @ prototypes.T
                blank = ~found.any(1) | (len(langs) == 1)
                if cosines.shape[1]:
                    best = cosines.argmax(1)
                    top = cosines[np.arange(len(found)), best]
                    score = 1 / np.exp(sharpness * (cosines - top[:, None])).sum(1)
                else:
                    best, top, score = (np.zeros(len(found)) for _ in range(3))
                best = np.where(blank, len(langs) - 1, best).astype(int)
                columns = [langs[best], np.where(blank, 0.0, score), np.where(blank, 0.0, top)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, columns)], names=["doc_id", "lang_pred", "score", "cosine"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, "doc_id long, lang_pred string, score double, cosine double")
    return found.select("doc_id", held_out("doc_id", *hold).alias("held_out"), "lang_pred", "score", "cosine")

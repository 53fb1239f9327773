"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A document's features are the hashed n-grams of its whole lower-cased text, by
the logarithm of their density in it. From the labelled documents come smoothed
sums of a bucket's feature in either class; the logarithm of their ratio scales
the bucket, and logistic regression is trained on the scaled features.

Documents without a label are scored like all others. A null or empty text has
the features of an empty text and gets a score too. A training set without
rows gives the score 0.5; one with a single class gives that class's share,
smoothed. Texts of any length count whole, and an empty table gives no rows.
Null ids are kept; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import held_out, keep, ready
from sluice.llm.features import added, average_rounds, counted_grams, known_labels, labelled_texts

SIZES = (4, 5, 6)
DENSITY = 1500.0  # one occurrence in so many characters makes a feature log 2
BITS = 20


def _features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    found, counts, length = counted_grams(text, SIZES, BITS, True)
    return found, np.log1p(DENSITY * counts / length).astype(np.float32)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    rounds: int = 4,
    alpha: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    hold: tuple[int, int] = (3, 1),
) -> dict[str, np.ndarray]:
    """``weights`` by bucket (ratios included) and ``bias``.

    Learns from all labelled rows that are not held out (``hold``: modulus and
    remainder of crc32 of the id).
    """
    ready(docs)
    allowed = ~held_out("id", *hold)
    known = keep(known_labels(labels, id_col, label_col, allowed), "known")
    rows = labelled_texts(docs, known, id_col, text_col, allowed)

    sums = added(rows, _class_sums)
    n = sums.get("rows", np.zeros(2))
    bias = np.log((n[1] + alpha) / (n[0] + alpha))
    if not n.all():
        return {"weights": np.zeros(1 << BITS, np.float32), "bias": np.float32([bias])}
    usual = alpha * sums["means"][0] / n.sum()
    ratio = np.log((sums["toxic"] + usual) / (n[1] + 2 * alpha)) - np.log((sums["clean"] + usual) / (n[0] + 2 * alpha))
    ratio[sums["seen"] < 3] = 0.0  # too rare to tell from chance
    ratio = ratio.astype(np.float32)
    del sums
    start = {"w": np.zeros(1 << BITS), "b": np.array([bias])}
    params = average_rounds(rows, start, {"ratio": ratio}, _features, _step, rounds)
    return {"weights": (params["w"] * ratio).astype(np.float32), "bias": params["b"].astype(np.float32)}


def _class_sums(table: pa.Table) -> dict[str, np.ndarray]:
    """Rows of either class, sums of the features in them, and documents by bucket (to three)."""
    found, seen = np.zeros((2, 1 << BITS)), np.zeros(1 << BITS, np.uint8)
    n, means = np.zeros(2), 0.0
    for label, text in zip(table["label"], table["text"], strict=True):
        at, x = _features(text.as_py())
        toxic = int(label.as_py() > 0)
        found[toxic, at] += x
        seen[at] += seen[at] < 3
        n[toxic] += 1
        means += float(x.mean()) if len(x) else 0.0
    return {"rows": n, "means": np.array([means]), "clean": found[0], "toxic": found[1], "seen": seen}


def _step(params: dict, fixed: dict, found: Sequence[tuple], label: np.ndarray, number: int) -> dict:
    """One pass of stochastic gradient steps over a shard's rows."""
    w, b, ratio = params["w"], params["b"], fixed["ratio"]
    rate = 0.1 / (1 + number)
    for i in np.random.default_rng(number).permutation(len(found)):
        at, x = found[i]
        x = ratio[at] * x
        margin = float(x @ w[at]) + b[0]
        error = (label[i] > 0) - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        # Steps are divided by the row's squared length: long rows don't overshoot.
        w[at] += rate * error / max(1.0, 0.0005 * float(x @ x)) * x
        b[0] += rate * error
    return {"w": w * (1 - 1e-3), "b": b}


def score(
    docs: DataFrame,
    model: dict[str, np.ndarray],
    *,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    hold: tuple[int, int] = (3, 1),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; the model (4 MB) is broadcast."""
    spark: SparkSession = ready(docs)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(_scores(batch.column(1), shared.value), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        held_out("doc_id", *hold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, model: dict[str, np.ndarray], *, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    shared = ready(docs).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(batch.column(text_col), shared.value)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)


def _scores(texts: pa.Array, model: dict[str, np.ndarray]) -> np.ndarray:
    weights, bias = model["weights"], float(model["bias"][0])
    rows = (_features(t.as_py()) for t in texts)
    margins = np.array([np.dot(weights[at], x) for at, x in rows], np.float64)
    return 1 / (1 + np.exp(-np.clip(margins + bias, -500, 500)))

"""Quality: ordinal cumulative-link regression on graded ratings.

All grades share the weights of hashed character n-grams (case-sensitive, by
the square roots of their shares of the whole text); ascending thresholds cut
the weighted sum into grades: P(grade <= k) = sigmoid(threshold_k - sum).
Grades are whatever whole numbers the labels hold, in their order; they need
not be evenly spaced. The expected grade is the mean over that distribution,
the tail probability that of ``select_grade`` or more.

A null or empty text has the features of an empty text. Without labelled rows
there is no grade: expected grade and tail probability are null and nothing is
selected. With one grade alone, every row has it. Texts of any length count
whole, and an empty table gives no rows. Null ids are kept; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import held_out, keep, ready
from sluice.llm.features import average_rounds, counted_grams, known_labels, labelled_texts

SIZES = (1, 2, 3)
BITS = 18


def _features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    found, counts, _ = counted_grams(text, SIZES, BITS, False)
    return found, np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_grades: int = 1000,
    rounds: int = 6,
    rate: float = 8.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    hold: tuple[int, int] = (5, 0),
) -> dict[str, np.ndarray]:
    """``grades`` ascending, ``weights`` by bucket, ``thresholds`` between grades.

    Learns from all labelled rows that are not held out.
    """
    ready(docs)
    allowed = ~held_out("id", *hold)
    known = keep(known_labels(labels, id_col, label_col, allowed), "known")
    rows = labelled_texts(docs, known, id_col, text_col, allowed)
    counts = sorted((r.label, r["count"]) for r in rows.groupBy("label").count().limit(max_grades + 1).collect())
    if len(counts) > max_grades:
        raise ValueError(f"more than {max_grades} grades")
    grades = np.array([g for g, _ in counts], np.int64)
    if len(grades) < 2:
        return {"grades": grades, "weights": np.zeros(1 << BITS, np.float32), "thresholds": np.zeros(0)}
    below = np.cumsum([n for _, n in counts])[:-1] / sum(n for _, n in counts)

    start = {"w": np.zeros(1 << BITS), "cuts": np.log(below / (1 - below))}
    params = average_rounds(rows, start, {"grades": grades, "rate": rate}, _features, _step, rounds)
    return {"grades": grades, "weights": params["w"].astype(np.float32), "thresholds": params["cuts"]}


def _step(params: dict, fixed: dict, found: Sequence[tuple], label: np.ndarray, number: int) -> dict:
    """One pass of stochastic gradient steps over a shard's rows."""
    w, cuts = params["w"], params["cuts"]
    pace = fixed["rate"] / (1 + number)
    at_grade = np.searchsorted(fixed["grades"], label)
    for i in np.random.default_rng(number).permutation(len(found)):
        at, x = found[i]
        total = float(w[at] @ x)
        y = int(at_grade[i])
        upper = _sigmoid(cuts[y] - total) if y < len(cuts) else 1.0
        lower = _sigmoid(cuts[y - 1] - total) if y else 0.0
        mass = max(upper - lower, 1e-6)
        w[at] += pace * (upper + lower - 1) * x
        if y < len(cuts):
            cuts[y] += 0.05 * pace * min(upper * (1 - upper) / mass, 1.0)
        if y:
            cuts[y - 1] -= 0.05 * pace * min(lower * (1 - lower) / mass, 1.0)
        cuts[:] = np.maximum.accumulate(cuts)
    return {"w": w, "cuts": cuts}


def score(
    docs: DataFrame,
    model: dict[str, np.ndarray],
    *,
    select_grade: int | None = None,
    min_tail: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    hold: tuple[int, int] = (5, 0),
) -> DataFrame:
    """``doc_id, held_out, expected_grade, tail_probability, selected`` for every row.

    ``select_grade`` defaults to the best grade; rows whose tail probability
    reaches ``min_tail`` are selected. The model (1 MB) is broadcast.
    """
    shared = ready(docs).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, weights, cuts = (shared.value[k] for k in ("grades", "weights", "thresholds"))
        wanted = len(grades) - 1 if select_grade is None else int(np.searchsorted(grades, select_grade))
        for batch in batches:
            means, tails = [None] * len(batch), [None] * len(batch)
            for i, text in enumerate(batch.column(1) if len(grades) else ()):
                at, x = _features(text.as_py())
                below = np.r_[0.0, _sigmoid(cuts - float(weights[at] @ x)), 1.0]
                means[i] = float(np.diff(below) @ grades)
                tails[i] = 1 - float(below[min(wanted, len(grades))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(means, pa.float64()), pa.array(tails, pa.float64())],
                names=["doc_id", "expected_grade", "tail_probability"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")
    return found.select(
        "doc_id",
        held_out("doc_id", *hold).alias("held_out"),
        "expected_grade",
        "tail_probability",
        F.coalesce(F.col("tail_probability") >= min_tail, F.lit(False)).alias("selected"),
    )

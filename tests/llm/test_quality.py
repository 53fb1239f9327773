"""Ordinal regression: held-out accuracy on three grades, and odd rows."""

import random

import numpy as np

from sluice.llm import quality


def fixture(spark, n=1200):
    """Grades 0, 2 and 7: the share of shouted words falls with the grade."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        grade = (0, 2, 7)[i % 3]
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(rng.randrange(30, 120))]
        words = [w.upper() + "!" if rng.random() < {0: 0.5, 2: 0.2, 7: 0.0}[grade] else w for w in words]
        rows.append((i, " ".join(words), 1))
        labels.append((i, grade))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, grade int"),
        spark.createDataFrame(labels + [(None, 2), (5, None)], "doc_id long, quality int"),
    )


def test_grades(spark):
    docs, labels = fixture(spark)
    model = quality.fit(docs, labels)
    assert model["grades"].tolist() == [0, 2, 7] and (np.diff(model["thresholds"]) > 0).all()
    held = [r for r in quality.score(docs, model).collect() if r.held_out]
    means = {g: np.mean([r.expected_grade for r in held if (0, 2, 7)[r.doc_id % 3] == g]) for g in (0, 2, 7)}
    assert means[0] < means[2] - 0.5 and means[2] < means[7] - 1.5
    assert np.mean([r.selected == (r.doc_id % 3 == 2) for r in held]) > 0.93
    wider = {r.doc_id: r for r in quality.score(docs, model, select_grade=2).collect()}
    assert all(wider[r.doc_id].tail_probability >= r.tail_probability for r in held)


def test_odd_rows(spark):
    docs, labels = fixture(spark, 90)
    model = quality.fit(docs, labels)
    rows = [(None, None), (1, ""), (1, ""), (2, "x" * 700_000)]
    found = quality.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(found) == 4 and all(0 <= r.expected_grade <= 7 and 0 <= r.tail_probability <= 1 for r in found)
    assert quality.score(docs.limit(0), model).count() == 0


def test_few_grades(spark):
    docs, labels = fixture(spark, 30)
    none = quality.score(docs, quality.fit(docs, labels.limit(0))).collect()
    assert {(r.expected_grade, r.tail_probability, r.selected) for r in none} == {(None, None, False)}
    one = quality.score(docs, quality.fit(docs, labels.where("quality = 2"))).collect()
    assert {(r.expected_grade, r.tail_probability, r.selected) for r in one} == {(2.0, 1.0, True)}

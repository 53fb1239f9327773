"""The pipeline: every stage against a plain version of it on its own input."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontamination import brute as held_items
from test_packing import check as check_packed
from test_simhash import slow_components, slow_fingerprint
from test_suffixes import brute as cut_out

import corpus_pipeline as cp
from sluice.llm import toxicity
from sluice.llm.common import keep

CLASHING = ["slot", "digest", "row", "kept_text", "block", "_text", "shard", "h"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    path = str(tmp_path_factory.mktemp("corpus"))
    words = ["".join(rng.choices("abcdefghi", k=rng.randrange(2, 9))) for _ in range(500)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(5)]
    passage = " ".join(rng.choices(words, k=60))
    rows, labels = [], []
    for i in range(400):
        w = rng.choices(words, k=rng.randrange(30, 150))
        if i % 5 == 0:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["grubface", "dolt", "vile"])
        if i % 7 == 1:
            w[10:10] = passage.split()
        if i % 11 == 2:
            w[5:5] = items[i % 5][1].upper().split()
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(500 + i, rows[i][1], None, None, None) for i in range(1, 60)]
    rows += [(600 + i, rows[i][1] + " extra", None, "t", 1) for i in range(1, 60)]
    rows += [(700, None, None, None, None), (701, "", "x", None, 0), (702, " \n", None, None, 1), rows[3], rows[3], (None, rows[4][1], None, None, 0)]
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s, _ in rows]
    clash = F.concat(F.lit("x"), F.col("doc_id").cast("string"))
    documents = spark.createDataFrame(rows, COLUMNS).withColumns({c: clash for c in CLASHING})
    documents.write.parquet(f"file://{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{path}/benchmark.parquet")
    return f"file://{path}", items


def rows_of(df):
    assert df.columns == [*[c.split()[0] for c in COLUMNS.split(", ")], *CLASHING]
    for c in CLASHING:
        assert df.where(F.col(c) != F.concat(F.lit("x"), F.col("doc_id").cast("string"))).isEmpty()
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_stages(spark, tables):
    path, items = tables
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    before = rows_of(docs)

    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    step = keep(cp.without_toxic(spark, docs, path), "t")
    scores = dict(zip([r[1] for r in before], toxicity._scores(cp_texts(before), model), strict=True))
    after = rows_of(step)
    assert after == [r for r in before if scores[r[1]] < 0.7] and step.columns == docs.columns
    toxic = {r[0] for r in before if r[1] and any(w in r[1] for w in ("grubface", "dolt", "vile"))}
    assert len(toxic & {r[0] for r in after}) <= 0.05 * len(toxic) and len(after) > len(before) - 1.1 * len(toxic)

    before, step = after, keep(cp.without_near_copies(spark, step, path), "s")
    after = rows_of(step)
    fps = [slow_fingerprint(r[1]) for r in before]
    group = slow_components(set(fps), 3)
    members = defaultdict(list)
    for r, f in zip(before, fps, strict=True):
        members[group[f]].append(r)
    assert len(after) == len(members)
    last = 1 << 62
    low = [min(last if r[0] is None else r[0] for r in m) for m in members.values()]
    assert sorted(last if r[0] is None else r[0] for r in after) == sorted(low) and set(after) <= set(before)

    before, step = after, keep(cp.without_repeats(spark, step, path), "r")
    after = rows_of(step)
    kept = {c[0]: c[5] for c in cut_out([r[:2] for r in before])}
    assert {str(r[0]): r[1] for r in after} == kept and all(r[4] == len(r[1]) for r in after)
    assert sorted((r[0], r[2], r[3]) for r in after if r[0] < 300) == sorted((r[0], r[2], r[3]) for r in before if r[0] < 300)

    before, step = after, keep(cp.without_benchmark(spark, step, path), "b")
    after = rows_of(step)
    held = dict(held_items([r[:2] for r in before], items))
    assert after == [r for r in before if not held[str(r[0])]]

    pieces = keep(cp.packed(spark, step, path), "p").collect()
    check_packed(pieces, [(r[0], r[1]) for r in after], 1024)
    assert len(cp.run(spark, path).collect()) == len(pieces)


def cp_texts(rows):
    import pyarrow as pa

    return pa.array([r[1] for r in rows], pa.string())


def test_empty_corpus(spark, tables, tmp_path):
    path, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in cp.STAGES[:-1]:
        docs = keep(stage(spark, docs, path), "e")
        assert rows_of(docs) == []
    assert cp.packed(spark, docs, path).count() == 0


def test_scores_are_the_operators(spark, tables):
    path, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = {"weights": np.zeros(1 << toxicity.BITS, np.float32), "bias": np.float32([2.0])}
    assert toxicity.clean(docs, model).count() == 0
    assert toxicity.score(docs, model).where("predicted = 0").count() == 0

"""The classifier: held-out accuracy, and defined results for odd rows."""

import random
import zlib

from pyspark.sql import functions as F

from sluice.llm import toxicity


def fixture(spark, n=900):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(["ba", "lo", "ti", "mur", "ane"], k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 200))]
        toxic = i % 4 == 0
        for _ in range(1 + len(words) // 40 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["grubface", "Dolt", "vile"])
        rows.append((i, " ".join(words), 0.5))
        labels.append((i, int(toxic), "z"))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, score double"),
        spark.createDataFrame(labels + [(None, 1, "z"), (3, None, "z"), (0, 1, "z")], "doc_id long, toxic int, text string"),
    )


def test_held_out(spark):
    docs, labels = fixture(spark)
    found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert sum(r.held_out for r in found) > 200
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)


def test_odd_rows(spark):
    docs, labels = fixture(spark, 60)
    model = toxicity.fit(docs, labels)
    rows = [(None, None), (1, ""), (1, ""), (2, "x" * 700_000), (3, "퟿\U0010ffff")]
    found = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
    assert found[0].held_out is False and found[0].score == found[1].score


def test_without_training_rows(spark):
    docs, labels = fixture(spark, 30)
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.5}
    clean = toxicity.score(docs, toxicity.fit(docs, labels.where("toxic = 0"))).collect()
    assert all(0 < r.score < 0.5 for r in clean)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0


def test_pieces_give_the_same_grams(monkeypatch):
    from sluice.llm import features

    text = "".join(random.Random(2).choices("abcdÉ ", k=5000))
    for sizes, lower in (((4, 5, 6), True), ((1, 2, 3), False)):
        monkeypatch.setattr(features, "PIECE", 1 << 18)
        whole = features.counted_grams(text, sizes, 18, lower)
        monkeypatch.setattr(features, "PIECE", 100)
        cut = features.counted_grams(text, sizes, 18, lower)
        assert (cut[0] == whole[0]).all() and (cut[1] == whole[1]).all() and cut[2] == whole[2] == 5002


def test_every_label_is_learned_from(spark, monkeypatch):
    """However many there are; a shard holds a bounded part of them, and lies in a file of its own."""
    from sluice.llm import features

    monkeypatch.setattr(features, "SHARD_BYTES", 1 << 14, raising=False)
    n = 20_000
    ids = spark.range(n)
    word = F.when(F.col("id") % 4 == 0, F.lit("grubface")).otherwise(F.lit("mild"))
    docs = ids.select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("balo ti"), word, F.lit("mur ane")).alias("text"))
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    taken = []
    added = features.added

    def counted(rows, make):
        taken.append(rows)
        return added(rows, make)

    monkeypatch.setattr(toxicity, "added", counted)
    model = toxicity.fit(docs, labels)
    allowed = [i for i in range(n) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(allowed) > 12_000 and sorted(r.id for r in taken[0].select("id").collect()) == allowed
    files = taken[0].groupBy(F.input_file_name().alias("file")).agg(F.count_distinct("shard").alias("n"), F.max("shard").alias("shard"))
    found = files.collect()
    assert len(found) > features.LEAST_SHARDS and all(r.n == 1 for r in found) and len({r.shard for r in found}) == len(found)
    scores = toxicity.score(docs, model).groupBy((F.col("doc_id") % 4 == 0).alias("toxic")).agg(F.min("predicted").alias("low"), F.max("predicted").alias("high"))
    assert {(r.toxic, r.low, r.high) for r in scores.collect()} == {(True, 1, 1), (False, 0, 0)}


def test_labels_too_many_to_broadcast(spark):
    from sluice.llm.features import known_labels, labelled_texts

    docs, labels = fixture(spark, 90)
    known = known_labels(labels, "doc_id", "toxic", F.lit(True))
    found = [labelled_texts(docs, known, "doc_id", "text", F.col("id") != 7, broadcast_rows=n) for n in (0, 1_000_000)]
    rows = [sorted(map(tuple, f.collect())) for f in found]
    assert rows[0] == rows[1] and sorted(r[1] for r in rows[0]) == [i for i in range(90) if i != 7]

"""Decontamination against all windows of all texts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import decontamination as dec


def split(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w):
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(docs, items, least=0.8):
    found = []
    for doc_id, text in docs:
        w, hit = split(text), set()
        for item_id, item in items:
            target = split(item)
            if not target or not w:
                continue
            for s in range(max(1, len(w) - len(target) + 1)):
                a, b = shingles(target), shingles(w[s : s + len(target)])
                if sum((a & b).values()) / sum((a | b).values()) >= least:
                    hit.add(item_id)
        found.append((str(doc_id), sorted(hit)))
    return sorted(found)


def fixture():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randrange(2, 6))) for _ in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([14, 30, 30, 55])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "!!"), (53, "quirky zebra"), (54, items[0][1]), (55, "go go go go go go go go")]
    docs = [(900, None), (901, ""), (902, "a quirky, Zebra!"), (903, items[1][1]), (903, items[1][1]), (903, "other text"), (None, items[2][1])]
    for i in range(150):
        w = rng.choices(vocabulary, k=rng.randrange(1, 120))
        if i % 3:
            part = split(items[rng.randrange(12)][1])
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(part))
                part = rng.choice([part[:at] + part[at + 1 :], part[:at] + ["new"] + part[at:], part[:at] + ["new"] + part[at + 1 :]])
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() for x in part]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs.append((800, "go " * 7_000 + items[3][1]))
    return docs, items


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_against_all_windows(spark, broadcast_rows):
    docs, items = fixture()
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = dec.decontaminate(d, b, broadcast_rows=broadcast_rows).collect()
    want = brute([x for x in docs if x[0] != 800], items)
    assert sorted((str(r.doc_id), r.items) for r in found if r.doc_id != 800) == want
    long = next(r for r in found if r.doc_id == 800)
    assert long.items == [3, 55] and long.similarity == 1.0 and long.n_items == 2 and long.contaminated


def test_fingerprint(spark):
    import xxhash

    w = split(fixture()[1][0][1])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    want = sum((2 * sum(h >> b & 1 for h in hashes) > len(w)) << b for b in range(64))
    got = spark.createDataFrame([(w,)], "w array<string>").select(dec.simhash("w")).first()[0]
    assert got & (1 << 64) - 1 == want


def test_blocks_cover_the_fingerprint(spark):
    for radius in (0, 3, 16, 63):
        row = spark.range(1).select(F.lit(-1).cast("long").alias("fp")).select(dec.block_keys("fp", radius)).first()[0]
        assert len(row) == radius + 1 and sum(bin(k.bits & (1 << 64) - 1).count("1") for k in row) == 64


def test_empty(spark):
    docs, items = fixture()
    d = spark.createDataFrame(docs[:20], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert dec.decontaminate(d.limit(0), b).count() == 0
    assert not any(r.contaminated for r in dec.decontaminate(d, b.limit(0)).collect())


def test_copies_cut_to_just_the_threshold_are_all_found(spark):
    """As many words of the item cut off its ends as 0.8 allows, in texts of other words."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(i, " ".join(word() for _ in range(m))) for i, m in enumerate([14, 22, 40, 60, 100] * 40)]
    docs = []
    for n in range(6000):
        i, text = items[n % len(items)]
        w = text.split()
        cut = (len(w) - 4) // 9  # (m - 4 - cut) / (m - 4 + cut) is 0.8 or a little more
        head = rng.randint(0, cut)
        part = w[head : len(w) - (cut - head)]
        docs.append((n, " ".join([*(word() for _ in range(20)), *part, *(word() for _ in range(20))])))
    found = dec.matches(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    )
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == {(n, n % len(items)) for n in range(6000)}


def test_windows_meet_the_items_of_their_shingles_only(spark, sf_dir):
    """Rows of the block join stay near the number of windows, far below windows times items."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    kept = {}
    original, dec.keep = dec.keep, lambda df, name: kept.setdefault(name, original(df, name))
    try:
        assert dec.matches(docs, items).count() > 0
    finally:
        dec.keep = original
    prints, targets = kept["window-prints"], kept["item-prints"]
    assert prints.count() < prints.select("m", "window").distinct().join(targets.select("m"), "m").count()

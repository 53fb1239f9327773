"""Deleted interpolation against counts and EM done token by token."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluice.llm import blobs, lm


def brute(rows, order=2):
    """(n_tokens, n_known, N, base, score) per row; EM on every training token."""
    docs = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"] for _, t in rows]
    train = [i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    one, two = Counter(), Counter()
    for words, t in zip(docs, train, strict=True):
        if t:
            one.update(words)
            two.update(zip(["<s>", *words], words, strict=False))
    total, types = sum(one.values()), len(one)
    one["<s>"] = sum(train)
    samples = defaultdict(list)
    for words, t in zip(docs, train, strict=True):
        if t:
            own1, own2 = Counter(words), Counter(zip(["<s>", *words], words, strict=False))
            own1["<s>"] = 1
            for v, w in zip(["<s>", *words], words, strict=False):
                c = one[v] - own1[v]
                p2 = (two[v, w] - own2[v, w]) / max(c, 1)
                p1 = (one[w] - own1[w]) / max(total - len(words), 1)
                samples[c.bit_length()].append((p2, p1, 1 / (types + 1)))
    weights = defaultdict(lambda: np.array([0.0, 0.5, 0.5]))
    for bucket, p in samples.items():
        p, w = np.array(p), np.array([0.5, 0.4, 0.1])
        for _ in range(50):
            share = w * p
            w = (share / share.sum(1, keepdims=True)).sum(0) + [0, 0.5, 0.5]
            w /= w.sum()
        weights[bucket] = w
    grams = [[*zip(["<s>", "<s>", *words], ["<s>", *words], words, strict=False)] for words in docs]
    three = Counter(g for gs, t in zip(grams, train, strict=True) if t for g in gs)
    two["<s>", "<s>"] = sum(train)

    def lower(v, w, one, two, n):
        p = np.array([two[v, w] / max(one[v], 1), one[w] / max(n, 1), 1 / (types + 1)])
        return weights[one[v].bit_length()] @ p

    top, samples = defaultdict(lambda: np.array([0.0, 1.0])), defaultdict(list)
    for gs, t in zip(grams, train, strict=True):
        if t and order == 3:
            own = [Counter(g[2] for g in gs), Counter(g[1:] for g in gs), Counter(gs)]
            own[0]["<s>"] = own[1]["<s>", "<s>"] = 1
            one_, two_, three_ = (Counter(a) for a in (one, two, three))
            for a, b in zip((one_, two_, three_), own, strict=True):
                a.subtract(b)
            for u, v, w in gs:
                p3 = three_[u, v, w] / max(two_[u, v], 1)
                samples[two_[u, v].bit_length()].append((p3, lower(v, w, one_, two_, total - len(gs))))
    for bucket, p in samples.items():
        p, w = np.array(p), np.array([0.5, 0.5])
        for _ in range(50):
            share = w * p
            w = (share / share.sum(1, keepdims=True)).sum(0) + [0, 0.5]
            w /= w.sum()
        top[bucket] = w
    if order == 3:
        found = []
        for words, gs in zip(docs, grams, strict=True):
            base = sum(math.log10((one[w] + 1) / (total + types + 1)) for w in words)
            score = 0.0
            for u, v, w in gs:
                p = np.array([three[u, v, w] / max(two[u, v], 1), lower(v, w, one, two, total)])
                score += math.log10(top[two[u, v].bit_length()] @ p)
            found.append((len(words), sum(one[w] > 0 for w in words), total, base, score))
        return found
    found = []
    for words in docs:
        base = sum(math.log10((one[w] + 1) / (total + types + 1)) for w in words)
        score = 0.0
        for v, w in zip(["<s>", *words], words, strict=False):
            p = np.array([two[v, w] / max(one[v], 1), one[w] / max(total, 1), 1 / (types + 1)])
            score += math.log10(weights[one[v].bit_length()] @ p) if total else 0.0
        found.append((len(words), sum(one[w] > 0 for w in words), total, base, score))
    return found


def fixture(n=150):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("Ka", "lo", "é", "zu") for b in ("x", "ri", "NN", "")]
    rows = [(i, rng.choice([" ", "\n\t"]).join(rng.choices(words[: rng.randrange(2, 16)], k=rng.randrange(0, 80)))) for i in range(n)]
    return rows + [(None, "Ka lo"), (3, rows[3][1]), (n, None), (n + 1, ""), (n + 2, "w " * 20_000), (n + 3, "never before seen")]


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("block_bytes", [2000, 1 << 23])
def test_against_brute_force(spark, monkeypatch, block_bytes, order):
    rows = fixture()
    want = brute(rows, order)
    monkeypatch.setattr(blobs, "BUCKET_BYTES", 1000)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block int, train string")
    df = df.repartition(1 if block_bytes > 10_000 else 5)
    found = lm.score(df, order=order).collect()
    assert len(found) == len(rows)
    key = lambda x: tuple(str(v) for v in x)
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found if r.doc_id is not None)
    assert got == sorted((i, *w[:3], round(w[3], 6)) for (i, _), w in zip(rows, want, strict=True) if i is not None)
    scores = sorted(((key((r.doc_id, r.n_tokens, round(r.base_score, 6))), r.score) for r in found))
    expected = sorted((key((i, w[0], round(w[3], 6))), w[4]) for (i, _), w in zip(rows, want, strict=True))
    for (a, s), (b, e) in zip(scores, expected, strict=True):
        assert a == b and s == pytest.approx(e, rel=0.02, abs=0.05)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in found)


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty).count() == 0 and lm.score(empty, order=3).count() == 0
    with pytest.raises(ValueError, match="order"):
        lm.score(empty, order=4)
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_better_than_its_base(spark):
    rng = random.Random(9)
    follow = {w: rng.sample(range(200), 4) for w in range(200)}
    rows = []
    for i in range(400):
        w, text = rng.randrange(200), []
        for _ in range(60):
            text.append(f"w{w}")
            w = rng.choice(follow[w])
        rows.append((i, " ".join(text)))
    found = lm.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert sum(r.score for r in found) > 0.5 * sum(r.base_score for r in found)


def test_trigrams_tell_more_where_words_depend_on_two(spark):
    rng = random.Random(10)
    rows = []
    for i in range(500):
        text = [rng.randrange(30), rng.randrange(30)]
        for _ in range(60):
            text.append((7 * text[-2] + 11 * text[-1] + rng.randrange(2)) % 30)
        rows.append((i, " ".join(f"w{w}" for w in text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    two, three = (sum(r.score for r in lm.score(docs, order=o).where("held_out").collect()) for o in (2, 3))
    assert three > 0.6 * two


def test_pack():
    keys = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64))
    counts = np.arange(1000, dtype=np.uint32)
    a, b = blobs.unpack(blobs.pack(keys, counts), "<u8", "<u4")
    assert (a == keys).all() and (b == counts).all()
    edges = blobs.cuts(keys, 7)
    assert edges[0] == 0 and edges[-1] == 1000 and (np.diff(edges) >= 0).all()

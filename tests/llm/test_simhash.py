"""SimHash near-duplicates against all pairs."""

import itertools
import random
import re
from collections import Counter

import xxhash

from sluice.llm import simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def slow_components(fps, max_bits):
    """Component of each distinct fingerprint: the set of fingerprints reachable."""
    at = {f: f for f in fps}

    def root(f):
        while at[f] != f:
            f = at[f]
        return f

    for a, b in itertools.combinations(sorted(fps), 2):
        if bin(a ^ b).count("1") <= max_bits:
            at[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_position_sets_hold_every_choice():
    for max_bits in range(8):
        sets = simhash.position_sets(max_bits)
        for agreeing in itertools.combinations(range(8), 8 - max_bits):
            assert any(set(s) <= set(agreeing) for s in sets)
    assert len(simhash.position_sets(3)) == 8 and len(simhash.position_sets(3)[0]) == 3


def test_documents(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(n)] for n in (300, 120, 60, 4, 2, 1)]
    texts = [None, "", "  \t", "É é É", "ÀB c d"]
    for words in base:
        for _ in range(25):
            own = list(words)
            own[rng.randrange(len(own))] = rng.choice(["X", "yy", own[0]])
            texts.append(rng.choice([" ", "\n", "\x0b\x0c"]).join(own))
    texts += texts[:40]
    rows = [(i, t, "e") for i, t in enumerate(texts)] + [(None, texts[5], "e"), (7, texts[7], "e")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    fps = [slow_fingerprint(t) for _, t, _ in rows]
    group = slow_components(set(fps), 3)
    lowest = {}
    for (doc_id, _, _), f in zip(rows, fps, strict=True):
        if doc_id is not None:
            lowest[group[f]] = min(lowest.get(group[f], doc_id), doc_id)
    want = sorted((str(i), f"{f:016x}", lowest[group[f]], i == lowest[group[f]]) for (i, _, _), f in zip(rows, fps, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id, r.kept) for r in found) == want


def test_hot_postings(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(50)}
    fps |= {rng.getrandbits(10) << 20 for _ in range(400)}  # they share most postings
    signed = [(f - (f >> 63 << 64),) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), square=32).collect()
    mask = (1 << 64) - 1
    assert all(bin((r.a ^ r.b) & mask).count("1") <= 3 for r in edges)
    want = slow_components(fps, 3)
    got = {f: f for f in fps}

    def root(f):
        while got[f] != f:
            f = got[f]
        return f

    for r in edges:
        got[root(r.a & mask)] = root(r.b & mask)
    classes = lambda find: {frozenset(f for f in fps if find(f) == c) for c in {find(f) for f in fps}}
    assert classes(root) == classes(want.get)


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_text_longer_than_one_piece():
    """Counted in pieces of 65,536 shingles, it has the fingerprint of a plain count, ties and repeats included."""
    rng = random.Random(3)
    for n in (65_537, 65_538, 140_000):
        words = [f"w{rng.randrange(50)}" for _ in range(n)]
        shingles = Counter(" ".join(words[i : i + 3]) for i in range(n - 2))
        total = sum(shingles.values())
        hashes = [(xxhash.xxh64_intdigest(s.encode(), 42), k) for s, k in shingles.items()]
        plain = sum(1 << b for b in range(64) if 2 * sum(k for h, k in hashes if h >> b & 1) > total)
        assert simhash.fingerprint(" ".join(words)) == plain

"""Removal of repeated word windows against plain loops; symbols against their promise."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import blobs, recompression


def plain(rows, width):
    """Rows of ``(id, text)``; every window is looked up."""
    docs = [(recompression.LAST if i is None else i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    seen: dict = {}
    for n, (i, words) in enumerate(docs):
        for s in range(len(words) - width + 1):
            seen.setdefault(tuple(words[s : s + width]), []).append((i, n, s))
    found = []
    for n, (i, words) in enumerate(docs):
        gone = set()
        for s in range(len(words) - width + 1):
            if any(j < i or (m == n and at < s) for j, m, at in seen[tuple(words[s : s + width])]):
                gone.update(range(s, s + width))
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        found.append((rows[n][0], len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return found


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows, width=20, parts=3):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, n_words int")
    got = [tuple(r) for r in recompression.deduplicate(df.repartition(parts), width=width).collect()]
    want = [(recompression.LAST if i is None else i, *r) for i, *r in plain(rows, width)]
    got = [(recompression.LAST if i is None else i, *r) for i, *r in got]
    assert sorted(got) == sorted(want)


def corpus(seed, n_docs, words, shared):
    """Documents of few different words with passages, runs and repeated pairs in common."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 90))] for _ in range(shared)]
    passages += [["a"] * 45, ["x", "y"] * 25, ["p", "q", "q"] * 12]
    rows = []
    for i in range(n_docs):
        out = []
        for _ in range(rng.randint(0, 6)):
            out += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(out)))
    return rows


@pytest.mark.parametrize("words", [3, 40, 5000])
def test_as_plain_loops(spark, words):
    rows = corpus(words, 150, words, 12)
    rows += [(500 + i, rows[7][1]) for i in range(20)] + [(700 + i, rows[7][1][:300] + f" end {i}") for i in range(20)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (None, rows[9][1]), (-1, None), (-2, ""), (-3, " \t ")]
    check(spark, rows)


def test_long_documents_in_blocks_of_their_own(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 900)) for _ in range(60_000))
    rows = [(1, long), (2, long[: len(long) // 2]), (3, "new " + long[1000:9000] + " words"), *((i + 10, t) for i, t in corpus(6, 40, 300, 4))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in recompression.deduplicate(df.repartition(8), with_text=True).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed >= got[2].n_words - 1  # its last word may be cut
    assert got[3].kept_text.split()[0] == "new" and got[3].kept_text.split()[-1] == "words"
    assert sum(s.end - s.start for s in got[3].removed) == got[3].n_removed > 1000


def test_other_widths(spark):
    for width in (2, 7):
        check(spark, corpus(width, 40, 30, 5), width)
    with pytest.raises(ValueError):
        recompression.deduplicate(spark.createDataFrame([], "doc_id long, text string"), width=1)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert recompression.deduplicate(none, with_text=True).collect() == []
    check(spark, [(1, None)])


def test_carried_columns_and_spans(spark):
    text = " ".join(f"t{i}" for i in range(50))
    df = spark.createDataFrame([(1, text, "s"), (2, f"x {text} y", "t")], "doc_id long, text string, n_words string")
    df = df.withColumnRenamed("n_words", "kind")
    rows = recompression.deduplicate(df, with_text=True, carry=["kind"]).orderBy("doc_id").collect()
    assert [r.kind for r in rows] == ["s", "t"] and rows[1].kept_text == "x y"
    assert [(s.start, s.end) for s in rows[1].removed] == [(1, 51)] and rows[0].removed == []


def block_of(texts):
    words = sorted({w for t in texts for w in t}) or []
    codes = np.array([words.index(w) for t in texts for w in t], np.uint32)
    import zstandard

    squeezed = zstandard.ZstdCompressor().compress(" ".join(words).encode())
    row = {"ids": list(range(len(texts))), "lengths": [len(t) for t in texts], "words": squeezed, "codes": blobs.pack(codes)}
    return recompression.Block(row)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([2, 5, 60]))
def test_equal_windows_have_equal_anchors_and_names(seed, words):
    """Wherever a window stands, its anchor, the anchor's place and the window's name are the same."""
    rng = random.Random(seed)
    part = [f"v{rng.randrange(words)}" for _ in range(rng.randint(20, 70))]
    pad = lambda: [f"v{rng.randrange(words)}" for _ in range(rng.randint(0, 15))]
    texts = [pad() + part + pad() for _ in range(4)] + [["v0"] * 50, ["v0", "v1"] * 30]
    block = block_of(texts)
    found = block.parse(20)
    rows = np.arange(len(found.window))
    names = list(zip(*(x.tolist() for x in block.window_names(found.window, 20, rows))))
    flat = [w for t in texts for w in t]
    by_text: dict = {}
    for r, s in enumerate(found.window.tolist()):
        what = (names[r], int(found.anchor_key[found.anchor[r]]), int(block.at[0][r]) - s, int(block.best[r]))
        by_text.setdefault(tuple(flat[s : s + 20]), set()).add(what)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v))[0] for v in by_text.values()}) == len(by_text)


def test_long_symbols_of_copies_are_shared():
    rng = random.Random(1)
    part = [f"v{rng.randrange(400)}" for _ in range(3000)]
    block = block_of([part, ["other"] * 3 + part + ["end"]])
    one, _, start, end, doc = block.parse(20).long
    shared = {n for n, d in zip(one.tolist(), doc.tolist()) if d == 0} & {n for n, d in zip(one.tolist(), doc.tolist()) if d == 1}
    spans = [(e - s) for n, s, e, d in zip(one.tolist(), start, end, doc) if d == 1 and n in shared]
    assert sum(spans) > 3000 and max(spans) >= 160

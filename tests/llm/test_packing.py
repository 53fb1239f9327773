"""Packing: exact round trip, no padding, and the encoder's two ways."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import packing
from sluice.llm.queries import tokenizer_files

TEXTS = [None, "", "one", "a b\n\n c  d", "Ünïcode ćafé – 漢字 😀", "<|endoftext|> x", "word " * 3000, "same", "same", "z" * 5000]


def check(rows, docs, size):
    import tokenizers

    exact = tokenizers.Tokenizer.from_file(tokenizer_files()["tokenizer"])
    ids = [np.array(exact.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for _, t in docs]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == {d for d, _ in docs}
    for (doc_id, _), want in zip(docs, ids, strict=True):
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want))
            assert r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("size", [16, 1024])
def test_round_trip(spark, size):
    rng = random.Random(size)
    docs = list(enumerate(TEXTS + [" ".join(["tok"] * rng.randrange(40)) for _ in range(300)]))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, sequence_id string")
    rows = packing.pack(df.repartition(3), **tokenizer_files(), sequence=size, max_open=7).collect()
    check(rows, docs, size)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, **tokenizer_files()).count() == 0


def test_null_id(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    rows = packing.pack(df, **tokenizer_files()).collect()
    assert sum(r.length for r in rows) == 8 and {r.doc_id for r in rows} == {None}


def test_least_squares_level():
    packer = packing.Packer(8, 100, 0)
    for n, levels in ((3, [3]), (3, [6]), (5, [5, 6]), (2, [5])):
        packer.add(n, np.zeros(n, "<u4"))
        assert np.flatnonzero(packer.levels).tolist() == levels
    assert len(packer.out) == 3


def test_quick_ids_are_exact():
    import random as r

    spec = tokenizer_files()
    spec = {"tokenizer": packing._read(spec["tokenizer"]), "ranks": packing._read(spec["ranks"]), "pattern": spec["pattern"]}
    encoder = packing.Encoder(spec)
    rng = r.Random(1)
    letters = [chr(i) for i in range(0x250)] + list("   \n\t'sre'llAZ09..") * 12
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(1, 60)))
        want = encoder.exact.encode(text, add_special_tokens=False).ids + [0]
        assert encoder(text, 0).tolist() == want

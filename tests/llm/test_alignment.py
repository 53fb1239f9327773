"""Alignment of two tokenizers against plain loops over the tokens of every text."""

import hashlib
from collections import Counter

import public_tokenizers as public
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sluice.llm import alignment
from sluice.llm.queries import tokenizer_files

FILES = tokenizer_files() | {"model": public.path("piece_bpe_32k.model")}
ODD = "unbelievable 東京タワー 🎉🎉 Ελλάδα\tx  y\n\n<|endoftext|> <s></s><unk> <0x41> \x00 été"
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, ODD),
    (3, None),
    (4, ""),
    (5, "a▁b"),  # B gives a space back
    (5, "The quick brown fox"),  # the id again
    (None, "The quick brown fox"),
    (6, " "),
    (7, "  leading and trailing  "),
    (8, "word " * 3000 + ODD * 50 + "x" * 5000),
]


def plain(rows):
    """The contract, token by token."""
    a_tok = Tokenizer.from_file(FILES["tokenizer"])
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=FILES["model"])
    letters = {v: k for k, v in bytes_to_letters().items()}
    encoded = []
    for doc_id, text in rows:
        a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        of_a = [bytes(letters[c] for c in a_tok.id_to_token(i)) for i in a]
        of_b = [bytes([i - 3]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        raw = (" " + text).encode() if text else b""
        if b"".join(of_a) != raw or b"".join(of_b) != raw:
            a, b, of_a, of_b = [], [], [], []
        encoded.append((doc_id, a, b, stops(of_a), stops(of_b)))
    pairs = Counter()
    for _, a, b, ea, eb in encoded:
        at = {e: i for i, e in enumerate(eb)}
        pairs.update((a[i], b[at[e]]) for i, e in enumerate(ea) if e in at)
    best = {}
    for (_, y), n in pairs.items():
        best[y] = max(best.get(y, 0), n)
    found = []
    for doc_id, a, b, ea, eb in encoded:
        common = sorted(set(ea) & set(eb))
        linked = [(a[ea.index(e)], b[eb.index(e)]) for e in common] if len(common) < 500 else None
        if linked is None:
            pa_, pb_ = {e: x for e, x in zip(ea, a)}, {e: x for e, x in zip(eb, b)}
            linked = [(pa_[e], pb_[e]) for e in common]
        text, lo = [], 0
        for e in common:
            left = ",".join(str(x) for x, end in zip(a, ea) if lo < end <= e) if len(common) < 500 else None
            right = ",".join(str(x) for x, end in zip(b, eb) if lo < end <= e) if len(common) < 500 else None
            text.append((left, right))
            lo = e
        digest = hashlib.sha256(";".join(f"{x}|{y}" for x, y in text).encode()).hexdigest() if common else ""
        n_best = sum(pairs[p] == best[p[1]] for p in linked)
        digest = digest if len(common) < 500 else None
        found.append((doc_id, len(a), len(b), len(common), len(linked), n_best, sum(pairs[p] for p in linked), digest))
    return found, pairs


def stops(tokens):
    total, found = 0, []
    for t in tokens:
        total += len(t)
        found.append(total)
    return found


def bytes_to_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, a string, count_n int").repartition(3)


def key(row):
    return tuple((x is None, x) for x in row)


def test_summary_is_that_of_plain_loops(spark, docs):
    want, _ = plain(TEXTS)
    got = [tuple(r) for r in alignment.align(docs, **FILES).collect()]
    long = {w[:7] for w in want if w[7] is None}
    assert len(long) == 1
    got = [g[:7] + (None if g[:7] in long else g[7],) for g in got]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_without_ranks_all_goes_through_tokenizers(spark, docs):
    some = {k: v for k, v in FILES.items() if k not in ("ranks", "pattern")}
    a, b = (sorted(map(tuple, alignment.align(docs, **f).collect()), key=key) for f in (FILES, some))
    assert a == b


def test_given_tables(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows.sort(key=lambda r: len(r[1] or ""))
    rows = rows[:120]
    want, pairs = plain(rows)
    encoded = alignment.encode(spark.createDataFrame(rows, "doc_id long, text string"), **FILES)
    got = {r.doc_id: tuple(r) for r in encoded.summary().collect()}
    assert len(got) == len(want)
    for w in want:
        assert got[w[0]][:7] == w[:7] and w[7] in (None, got[w[0]][7])
    counts = {(r.a_id, r.b_id): r.n for r in encoded.pair_counts().collect()}
    assert counts == pairs


def test_groups_spell_the_text(spark, docs):
    encoded = alignment.encode(docs.where("doc_id IN (1, 2, 7, 8)"), **FILES)
    vocabularies = alignment.Vocabularies({**{k: None for k in ("ranks", "pattern")}, **read_spec()})
    a, b = vocabularies.a.to_pylist(), vocabularies.b.to_pylist()
    texts = dict(TEXTS)
    ids = {r.doc_id: r for r in encoded.tokens().collect()}
    assert {d: b"".join(a[i] for i in r.a).decode() for d, r in ids.items()} == {d: " " + texts[d] for d in (1, 2, 7, 8)}
    found = {}
    for g in encoded.groups().collect():
        spelt = b"".join(a[i] for i in g.a)
        assert spelt == b"".join(b[i] for i in g.b) and g.end - g.start == len(spelt)
        found.setdefault(g.doc_id, {})[g.group] = (g.start, spelt)
    for doc_id, groups in found.items():
        parts = [groups[i] for i in range(len(groups))]
        assert b"".join(p for _, p in parts).decode() == " " + texts[doc_id]
        assert [s for s, _ in parts] == [0, *stops([p for _, p in parts])[:-1]]


def read_spec():
    with open(FILES["tokenizer"], encoding="utf-8") as f, open(FILES["model"], "rb") as m:
        return {"tokenizer": f.read(), "model": m.read()}


def test_pairs_are_bounded_by_the_vocabularies():
    v = alignment.Vocabularies({"ranks": None, "pattern": None, **read_spec()})
    assert alignment.most_pairs(v.a.to_pylist(), v.b.to_pylist()) < 1_000_000
    assert alignment.most_pairs([b"ab", b"b"], [b"b", b"b", b"cab"]) == 6


def test_links_hold_every_pair_that_ends_together():
    sizes = pa.array([0, 1, 2], pa.int64())
    a, b = (pa.array(x, pa.list_(pa.int32())) for x in ([[1, 2], [], [2, 0]], [[2, 1], [], [1, 1]]))
    found = alignment.links(alignment.ends(a, sizes), alignment.ends(b, sizes))
    assert list(zip(*(found[c].to_pylist() for c in ("doc", "a", "b")))) == [(0, 2, 1), (2, 2, 1), (2, 0, 1)]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(none, **FILES).collect() == []
    assert alignment.encode(none, **FILES).groups().collect() == []

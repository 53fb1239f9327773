"""Removal of repeated strings against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from sluice.llm import anchors, blobs, suffixes


def brute(rows, width=50):
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: suffixes.LAST if r[0] is None else r[0]):
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            first.setdefault(data[i : i + width], suffixes.LAST if doc_id is None else doc_id)
    found = []
    for doc_id, text in rows:
        data, own = (text or "").encode(), suffixes.LAST if doc_id is None else doc_id
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < own:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        found.append((str(doc_id), len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return sorted(found)


def fixture(seed=1, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdéü", k=rng.randrange(2, 8))) for _ in range(60)]
    shared = [" ".join(rng.choices(words, k=rng.randrange(5, 40))) for _ in range(10)]
    rows = [(9000, None), (9001, ""), (9002, "x" * 49), (9003, "x" * 50), (9004, "x" * 700), (9005, "ab" * 300), (9006, "abba" * 80), (9007, "\0" * 130)]
    rows += [(9008, "\0" * 60 + "q" * 60), (9009, "é" * 25), (9010, "aé" + "é" * 40)]
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            part = rng.choice([rng.choice(shared), " ".join(rng.choices(words, k=rng.randrange(1, 30)))])
            if rng.random() < 0.5:
                at = rng.randrange(len(part))
                part = part[:at] + rng.choice("xyz") + part[at + rng.randrange(2) :]
            parts.append(part)
        rows.append((rng.randrange(10**6), rng.choice([" ", "", "\n"]).join(parts)))
    rows += [(rows[-1][0], rows[-1][1]), (rows[-2][0], rows[-3][1]), (None, rows[20][1]), (None, shared[0] * 3), (-5, shared[1])]
    rng.shuffle(rows)
    return rows


def found(df, **options):
    rows = suffixes.deduplicate(df, with_text=True, **options).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) for r in rows)


@pytest.mark.parametrize("max_group, block_bytes", [(4096, 1 << 23), (4096, 3000), (2, 1 << 23)])
def test_against_all_windows(spark, monkeypatch, max_group, block_bytes):
    rows = fixture(max_group)
    monkeypatch.setattr(blobs, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(anchors, "SEGMENT", 1000)
    df = spark.createDataFrame([(i, t, "e", i) for i, t in rows], "doc_id long, text string, block string, gram long")
    df = df.repartition(1 if block_bytes < 10_000 else 4)
    if block_bytes < 10_000:  # several blocks in a task
        df = df.repartition(7)
    assert found(df, max_group=max_group) == brute(rows)


def test_carried_columns(spark):
    df = spark.createDataFrame([(2, "a" * 60, "de", None), (1, "a" * 60, None, 3)], "doc_id long, text string, lang string, n int")
    rows = suffixes.deduplicate(df, carry=["lang", "n"]).orderBy("doc_id").collect()
    assert [(r.doc_id, r.lang, r.n, r.n_removed) for r in rows] == [(1, None, 3, 0), (2, "de", None, 60)]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert suffixes.deduplicate(df, carry=["lang"]).count() == 0


def test_anchors_are_equal_for_equal_windows(monkeypatch):
    rng = random.Random(3)
    data = "".join(rng.choices("ab", weights=[9, 1], k=900)).encode()
    ends = np.array([0, 200, 200, 230, 900])
    for segment in (1 << 22, 64):
        monkeypatch.setattr(anchors, "SEGMENT", segment)
        runs = anchors.runs(np.frombuffer(data, np.uint8), ends, 50)
        place = {}
        windows = 0
        for anchor, first, last in zip(runs.anchor, runs.first, runs.last, strict=True):
            for p in range(first, last + 1):
                windows += 1
                assert place.setdefault(data[p : p + 50], anchor - p) == anchor - p
        assert windows == (200 - 49) + (670 - 49)


def test_intervals_by_definition():
    rng = random.Random(5)
    texts = sorted("".join(rng.choices("ab", k=8)) for _ in range(40))
    ids = [rng.randrange(9) for _ in texts]
    before = [rng.choice([-1, 97, 97, 98]) for _ in texts]

    def prefix(a, b):
        return next((i for i in range(8) if a[i] != b[i]), 8)

    common = [0] + [prefix(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    want = set()
    for length in range(2, 9):
        for head in {t[:length] for t in texts}:
            at = [i for i, t in enumerate(texts) if t.startswith(head)]
            if len(at) > 1 and min(common[i] for i in at[1:]) == length:
                preceding = {before[i] for i in at}
                if len(preceding) > 1 or -1 in preceding:
                    want.add((at[0], at[-1], length, min(ids[i] for i in at)))
    got = suffixes.intervals(np.array(common), np.array(ids), np.array(before), 2)
    assert len(got) == len(set(got)) and set(got) == want


def test_small_segments_and_blocks(monkeypatch):
    """The steps one after another in this process, where segments and blocks can be made small."""
    import types

    import pandas as pd
    import pyarrow as pa

    rows = fixture(9, 60)
    monkeypatch.setattr(anchors, "SEGMENT", 300)
    monkeypatch.setattr(blobs, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(suffixes, "BATCH", 10)
    monkeypatch.setattr(suffixes, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 3)))
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "_text": pa.array([r[1] for r in rows], pa.string())}
    )
    blocks = pa.Table.from_batches(suffixes._encode(iter([batch])))
    assert len(blocks) > 10
    asked = pa.Table.from_batches(suffixes._ask(50, 40, 4)(iter(blocks.to_batches()))).to_pandas()
    replies = pd.concat([suffixes._state(frame.reset_index(drop=True)) for _, frame in asked.groupby("bucket")])
    parts = []
    for i, number in enumerate(blocks.column("block").to_pylist()):
        mine = pa.Table.from_pandas(replies[replies["block"] == number], preserve_index=False)
        parts.append(suffixes._sort_out(50, 40)(blocks.slice(i, 1), mine))
    parts = pa.concat_tables(parts)
    contexts = parts.filter(pa.compute.is_valid(parts.column("gram"))).sort_by("gram")
    scanned = pa.Table.from_batches(suffixes._scan(50)(iter(contexts.to_batches(max_chunksize=7))))
    told = parts.filter(pa.compute.is_valid(parts.column("spans"))).select(["block", "spans"])
    spans = pa.concat_tables([told, scanned])
    for c in ("start", "end"):
        spans = spans.append_column(c, pa.nulls(len(spans), pa.int64()))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())]
    )
    out = []
    for i, number in enumerate(blocks.column("block").to_pylist()):
        mine = spans.filter(pa.compute.equal(spans.column("block"), number))
        out += suffixes._cut(schema, True)(blocks.slice(i, 1), mine).to_pylist()
    assert sorted((str(r["doc_id"]), *list(r.values())[1:]) for r in out) == brute(rows)


def test_only_short_texts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b" * 49), (4, "b" * 49)], "doc_id long, text string")
    assert found(df) == brute([(1, "a"), (2, None), (3, "b" * 49), (4, "b" * 49)])


def test_contexts_without_repeats(spark):
    """Anchor strings are shared, windows are not."""
    shared = "".join(chr(97 + i * 7 % 26) for i in range(40))
    rows = [(i, f"{'xyzw'[i] * 30}{shared}{'pqrs'[i] * 30}") for i in range(4)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)

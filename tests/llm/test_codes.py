"""Codes of vectors against plain loops; trees against comparing everything."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import anchors_tree, codes

SCHEMA = "vec_id long, embedding array<double>, label string, code string, block int"


def plain(rows, parts, entries, rounds, scale=4096):
    used = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in used), default=0) // parts) * parts or parts
    step = width // parts
    whole = [[math.floor(scale * x) for x in r[1]] + [0] * (width - len(r[1])) for r in used]
    order = sorted(range(len(used)), key=lambda i: (used[i][0] is None, used[i][0] or 0, used[i][1]))
    books = [[whole[i][p * step : p * step + step] for i in order[:entries]] for p in range(parts)]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            mine = [[] for _ in books[p]]
            for w in whole:
                x = w[p * step : p * step + step]
                mine[nearest(p, x)[0]].append(x)
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(mine, books[p])]
    found = []
    for r, w in zip(used, whole):
        got = [nearest(p, w[p * step : p * step + step]) for p in range(parts)]
        found.append((r[0], "".join(f"{e:02x}" for e, _ in got), sum(d for _, d in got), r[2]))
    total = {}
    for _, _, error, label in found:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, c, e, total[label], digest) for i, c, e, label in found]


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows, monkeypatch=None, **shape):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in codes.fit(df, **shape).summary().collect()]
    assert sorted(got, key=key) == sorted(plain(rows, **shape), key=key)


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), "ab"[i % 2]) for i in range(60)]
    rows += [(i, rows[0][1], None) for i in range(100, 140)]  # copies, and rows without a label
    rows += [(3, [0.0] * 8, ""), (None, [0.5] * 8, "a"), (None, [0.5] * 8, "c")]
    rows += [(-1, None, "a"), (-2, [None] * 8, "a"), (-3, [math.nan] * 8, "a"), (-4, [math.inf] + [0.0] * 7, None)]
    rows += [(-5, [], "a"), (-6, [1.0, -1e-9], "a")]  # short ones
    check(spark, rows, parts=4, entries=5, rounds=3)
    check(spark, rows[:3], parts=4, entries=5, rounds=3)
    check(spark, [(1, [1.0] * 3, None)] * 3, parts=2, entries=2, rounds=2)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_BYTES", 8 * 16 * 40)
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(6, 16))
    rows = [(i, (middles[i % 6] + 0.05 * rng.normal(size=16)).tolist(), str(i % 3)) for i in range(500)]
    check(spark, rows, parts=8, entries=16, rounds=6)


def test_empty_and_unusable(spark):
    for rows in ([], [(1, None, "a", "x", 1)]):
        assert codes.fit(spark.createDataFrame(rows, SCHEMA)).summary().collect() == []


def test_too_large(spark):
    with pytest.raises(ArithmeticError, match="do not fit"):
        codes.fit(spark.createDataFrame([(1, [1e30], "a", "x", 1)], SCHEMA))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(1, 5), st.integers(1, 9), st.sampled_from([1, 3, 100]))
def test_trees_find_what_comparing_all_finds(seed, n, width, k, span):
    rng = np.random.default_rng(seed)
    points = rng.integers(-span, span + 1, (n, width)) * rng.integers(1, 2000)
    points[rng.random(n) < 0.3] = points[0]  # a third of the points are one
    entries = np.concatenate([points[rng.integers(0, n, k)], rng.integers(-span, span + 1, (1, width))])
    tree = anchors_tree.build(points.astype(np.int64), leaf=4)
    distance = ((points[:, None] - entries[None]) ** 2).sum(2)
    code, error = anchors_tree.assign(tree, entries)
    assert (code == distance.argmin(1)).all() and (error == distance.min(1)).all()
    sums, counts = anchors_tree.totals(tree, entries)
    assert (counts == np.bincount(code, minlength=len(entries))).all()
    assert all((sums[e] == points[code == e].sum(0)).all() for e in range(len(entries)))


def test_balls_hold_their_points_and_lists_shrink():
    rng = np.random.default_rng(3)
    middles = rng.integers(-9000, 9000, (8, 6))
    points = (middles[rng.integers(0, 8, 4000)] + rng.integers(-300, 300, (4000, 6))).astype(np.int64)
    tree = anchors_tree.build(points)
    for i in range(len(tree.first)):
        inside = tree.points[tree.first[i] : tree.last[i]]
        assert np.sqrt(((inside - tree.centre[i]) ** 2).sum(1)).max() <= tree.radius[i] * (1 + 1e-12)
        assert (inside.sum(0) == tree.sums[i]).all()
        if tree.left[i] >= 0:
            assert tree.first[tree.left[i]] == tree.first[i] and tree.last[tree.right[i]] == tree.last[i]
    owned, _, leaves, lists = anchors_tree._frontier(tree, middles)
    assert (tree.last[owned] - tree.first[owned]).sum() > 3000  # whole balls, no points looked at
    assert len(leaves) == 0 or lists.sum(1).mean() < len(middles) / 2

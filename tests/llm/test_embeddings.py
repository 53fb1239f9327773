"""Embedding links against all pairs, and the graph's recall."""

import numpy as np

from sluice.llm import embeddings
from sluice.llm.hnsw import Graph


def brute(rows, least=0.95):
    """(vec_id, n_links, component_id, kept) per row."""
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    n = [0] * len(rows)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for (_, v), g in zip(rows, good, strict=True)]
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                n[i] += 1
                n[j] += 1
                at[root(i)] = root(j)
    low = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            low[root(i)] = min(low.get(root(i), vec_id), vec_id)
    return sorted(str((v, n[i], low.get(root(i)) if good[i] else v, (v == low.get(root(i))) if good[i] else True)) for i, (v, _) in enumerate(rows))


def fixture():
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).astype(np.float32)) for i in range(250)]
    rows += [(1000 + i, rows[3][1] + rng.standard_normal(16).astype(np.float32) * 0.01) for i in range(90)]
    rows += [(2000 + i, rows[i][1] * np.float32(2 + i)) for i in range(20)]
    rows += [(3000 + i, rows[5][1]) for i in range(30)] + [(3000, rows[5][1]), (None, rows[6][1]), (None, rows[7][1] + 9)]
    rows += [(4000 + i, rng.standard_normal(3).astype(np.float32)) for i in range(40)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [nan] + [1.0] * 15]
    return rows + [(5000 + i, v) for i, v in enumerate(odd)] + [(None, None)]


def test_against_all_pairs(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, cid int, v string")
    found = embeddings.near_duplicates(df, min_shards=3).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id, r.kept)) for r in found) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(df).count() == 0


def test_recall_in_one_graph():
    rng = np.random.default_rng(3)
    own = rng.standard_normal((4000, 32))
    own[2000:2600] = own[0] + rng.standard_normal((600, 32)) * 0.02
    own[3000:3400] = own[100:500] + rng.standard_normal((400, 32)) * 0.05
    graph = Graph(embeddings._units(own))
    units = own / np.linalg.norm(own, axis=1, keepdims=True)
    true = {*zip(*np.nonzero(units @ units.T >= 0.95), strict=True)}
    found = {*zip(*embeddings._pairs(graph, own, own, 0.95, 64), strict=True)}
    assert found <= true and len(found) >= 0.99 * len(true)


def test_audit_widens_the_beam(monkeypatch):
    own = np.random.default_rng(4).standard_normal((600, 8))
    graph = Graph(embeddings._units(own))
    asked = []

    def poor(graph, own, queries, least, ef):
        asked.append(ef)
        left = np.arange(10 * ef)
        return left, left

    monkeypatch.setattr(embeddings, "_pairs", poor)
    ef = embeddings.audited(graph, own, -1.0, 0.9, 20)  # all 20 x 600 pairs link
    assert asked == [64, 128, 256, 512] and ef == 1024


def tight_third():
    """A third of the shard in one tight group, 100 isolated pairs, the rest alone."""
    rng = np.random.default_rng(5)
    own = rng.standard_normal((3000, 32))
    own[:1000] = own[0] + rng.standard_normal((1000, 32)) * 0.01
    own[1000:1100] = own[1100:1200] + rng.standard_normal((100, 32)) * 0.02
    return own


def test_audit_sees_lost_pairs(monkeypatch):
    own = tight_third()
    graph = Graph(embeddings._units(own))
    real, asked = embeddings._pairs, []

    def poor(graph, own, queries, least, ef):
        asked.append(ef)
        left, right = real(graph, own, queries, least, ef)
        alike = np.einsum("ij,ij->i", queries[left], own[right])
        alike /= np.linalg.norm(queries[left], axis=1) * np.linalg.norm(own[right], axis=1)
        lost = (right >= 1000) & (right < 1200) & (alike < 1 - 1e-9) if ef < 256 else np.zeros(len(left), bool)
        return left[~lost], right[~lost]

    monkeypatch.setattr(embeddings, "_pairs", poor)
    assert embeddings.audited(graph, own, 0.95, 0.995, 512) >= 256 and {64, 128} <= {*asked}


def test_audit_without_links_asks_moved_rows(monkeypatch):
    own = np.random.default_rng(6).standard_normal((500, 32))
    real = embeddings._pairs

    def poor(graph, own, queries, least, ef):
        left, right = real(graph, own, queries, least, ef)
        found = np.linalg.norm(queries[left] - own[right], axis=1) < 1e-9
        return left[found], right[found]

    monkeypatch.setattr(embeddings, "_pairs", poor)
    assert embeddings.audited(Graph(embeddings._units(own)), own, 0.95, 0.995, 64) >= 500


def test_unreachable_rows_are_found_in_the_end():
    own = np.random.default_rng(7).standard_normal((1500, 16))
    own[1000:1200] = own[500:700] + np.random.default_rng(8).standard_normal((200, 16)) * 0.02
    graph = Graph(embeddings._units(own))
    lost = np.isin(graph.order, np.arange(1000, 1200))
    for links in graph.layers:  # nothing links to these rows, and none is a start
        links[lost[links] & (links >= 0)] = -1
    graph._entry = lambda queries, width=4: np.tile(np.flatnonzero(~lost)[:width], (len(queries), 1))
    units = own / np.linalg.norm(own, axis=1, keepdims=True)
    true = {*zip(*np.nonzero(units @ units.T >= 0.95), strict=True)}
    ef = embeddings.audited(graph, own, 0.95, 0.995, 512)
    assert {*zip(*embeddings._pairs(graph, own, own, 0.95, ef), strict=True)} == true
    assert {*zip(*graph.within(embeddings._units(own), 0.95, len(own)), strict=True)} == true


def test_nearest_of_a_hub_are_linked_back():
    angles = np.concatenate([[0.0], np.linspace(1.5, 0.1, 200)])  # the hub, then ever nearer
    graph = Graph.__new__(Graph)
    graph.sorted, graph.m = np.stack([np.cos(angles), np.sin(angles)], 1).astype(np.float32), 12
    links = np.full((201, 24), -1)
    links[1:, 0] = 0
    graph._link_back(links, np.arange(1, 201))
    assert 200 in links[0]


def test_small_shards_are_asked_through_the_graph(monkeypatch):
    """Shards of the size the given tables have: no row is compared with all others."""
    rng = np.random.default_rng(9)
    for n in (80, 500, 2000):
        own = rng.standard_normal((n, 32))
        own[: n // 4] = own[n // 4 : n // 2] + rng.standard_normal((n // 4, 32)) * 0.02
        graph = Graph(embeddings._units(own))
        units = own / np.linalg.norm(own, axis=1, keepdims=True)
        true = {*zip(*np.nonzero(units @ units.T >= 0.95), strict=True)}
        assert embeddings.audited(graph, own, 0.95, 0.995, 512) == 64
        compared = []
        monkeypatch.setattr(graph, "every", lambda queries, least, real=graph.every: compared.append(len(queries)) or real(queries, least))
        assert {*zip(*embeddings._pairs(graph, own, own, 0.95, 64), strict=True)} == true
        assert sum(compared) == 0


def test_graphs_of_twenty_thousand(spark):
    """A tight group of a third and isolated pairs, over several shards, against blocks of all pairs."""
    rng = np.random.default_rng(10)
    n, group, pairs = 20_000, 6_600, 800
    own = rng.standard_normal((n, 32))
    own[:group] = own[0] + rng.standard_normal((group, 32)) * 0.02
    own[group : group + pairs] = own[group + pairs : group + 2 * pairs] + rng.standard_normal((pairs, 32)) * 0.02
    own = own.astype(np.float32)
    units = own.astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    links = np.concatenate([(units[at : at + 1000] @ units.T >= 0.95).sum(1) - 1 for at in range(0, n, 1000)])
    low = np.arange(n)
    low[:group] = 0
    low[group + pairs : group + 2 * pairs] -= pairs
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(own.tolist())], "vec_id long, embedding array<float>")
    found = sorted(embeddings.near_duplicates(rows).collect())
    assert [(r.vec_id, r.n_links, r.component_id) for r in found] == [*zip(range(n), links.tolist(), low.tolist(), strict=True)]

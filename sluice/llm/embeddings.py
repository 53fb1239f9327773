"""Near-duplicate embeddings: a navigable graph per shard, every shard queried.

Equal vectors are one class. Classes are dealt to shards by hash (``shard_bytes``
of vectors at most in one, ``min_shards`` at least; by default one for 2,048 classes,
eight at most, so that a shard is worth a graph), each of which becomes a
hierarchical small-world graph. Every class queries every shard: its beam is
widened while it is full of vectors at the threshold, and a shard's first beam
is widened until an audit against brute force finds ``recall`` of the links of
its vectors, row by row: ``audit_rows`` with few links to others (sampled until
so many are found), as many with more, and as many moved copies. Rows whose first beam is full,
and shards that fail their audit, are asked with wider beams; where those would cost more than
comparing all rows, all are compared for them. Pairs found are verified by cosine in double
precision. Tasks hand on counts and spanning forests, never pairs, and
components are joined by Spark.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing, nor do vectors of different lengths with each other. Ids may be
null or repeat: the result has a row for every row, repeated rows link with
each other, and a null id is never the smallest. An empty table gives no rows;
vectors of any length are compared whole. Other columns are left out.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import components, keep, ready
from sluice.llm.hnsw import FIRST, Graph

MARGIN = 1e-4  # what single precision may lose before the exact check
QUERIES, SPREAD = 8192, 16  # small inputs are still asked in blocks of so many, up to so many blocks
SHARDS, SHARD_CLASSES = 8, 2048  # small inputs have a shard for so many classes, up to so many shards
LOW, FLOOR = 0.02, 0.9  # all audited rows but this share have at least this share of their links
CELLS = 1 << 23  # similarities worked out at a time


def usable(v: str) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(v).isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _doubles(vectors) -> np.ndarray:
    """Rows scaled so that squares neither overflow nor vanish."""
    found = np.stack([np.asarray(v, np.float64) for v in vectors])
    return found / np.abs(found).max(1, keepdims=True)


def _units(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def verified(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether the cosine of row and row, in double precision, reaches ``least``."""
    dots = np.einsum("ij,ij->i", a, b)
    return dots / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)) >= least


def _sure(own: np.ndarray, queries: np.ndarray, left: np.ndarray, right: np.ndarray, least: float):
    good = np.zeros(len(left), bool)
    for at in range(0, len(left), 65536):
        part = slice(at, at + 65536)
        good[part] = verified(queries[left[part]], own[right[part]], least)
    return left[good], right[good]


def _pairs(graph: Graph, own: np.ndarray, queries: np.ndarray, least: float, ef: int) -> tuple[np.ndarray, np.ndarray]:
    return _sure(own, queries, *graph.within(_units(queries), least - MARGIN, ef), least)


def _blocks(n: int, own: np.ndarray):
    step = max(1, CELLS // len(own))
    return [slice(at, at + step) for at in range(0, n, step)]


def _sampled(own: np.ndarray, units: np.ndarray, least: float, rows: int) -> np.ndarray:
    """Rows with another link: ``rows`` with fewer links than the first beam has places, unless the shard has no more, and as many with more."""
    some = np.random.default_rng(0).permutation(len(own))
    few, many = np.zeros(0, int), np.zeros(0, int)
    for part in _blocks(len(own), own):
        at = some[part]
        left, right = _sure(own, own[at], *np.nonzero(units[at] @ units.T >= least - MARGIN), least)
        links = np.bincount(left[at[left] != right], minlength=len(at))
        few = np.concatenate([few, at[(links > 0) & (links < FIRST)]])[:rows]
        many = np.concatenate([many, at[links >= FIRST]])[:rows]
        if len(few) == rows:
            break
    return np.concatenate([few, many])


def _moved(own: np.ndarray, least: float, rows: int) -> np.ndarray:
    """Some rows moved nearly as far as a link goes: what classes of other shards ask for."""
    rng = np.random.default_rng(1)
    units = own[rng.permutation(len(own))[:rows]]
    units = units / np.linalg.norm(units, axis=1, keepdims=True)
    aside = rng.standard_normal(units.shape)
    aside -= np.einsum("ij,ij->i", aside, units)[:, None] * units
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-30)
    near = min(1.0, 0.9 * least + 0.1)
    return near * units + np.sqrt(1 - near * near) * aside


def _recalls(graph: Graph, own: np.ndarray, units: np.ndarray, asked: np.ndarray, selves: np.ndarray, least: float, ef: int):
    """For each query with links other than its own row (-1 for none): how many, and the share found."""
    links, shares = [], []
    for part in _blocks(len(asked), own):
        queries, self_ = asked[part], selves[part]
        left, right = _sure(own, queries, *np.nonzero(_units(queries) @ units.T >= least - MARGIN), least)
        other = self_[left] != right
        left, right = left[other], right[other]
        got_left, got_right = _pairs(graph, own, queries, least, ef)
        got = np.isin(left * len(own) + right, got_left * len(own) + got_right)
        n = np.bincount(left, minlength=len(queries))
        hit = np.bincount(left, got, minlength=len(queries))
        links.append(n[n > 0])
        shares.append(hit[n > 0] / n[n > 0])
    return np.concatenate(links or [np.zeros(0, int)]), np.concatenate(shares or [np.zeros(0)])


def audited(graph: Graph, own: np.ndarray, least: float, recall: float, rows: int) -> int:
    """The first beam width at which the audit passes, or the shard's size: then all rows are compared.

    Rows count alike whatever their number of links, and those with few links and
    those with more must pass each for themselves: ``recall`` in the mean, and all
    but ``LOW`` of them with at least ``FLOOR`` of their links.
    """
    units = _units(own)
    linked = _sampled(own, units, least, rows)
    asked = np.concatenate([own[linked], _moved(own, least, rows)])
    selves = np.concatenate([linked, np.full(len(asked) - len(linked), -1)])

    def passes(ef: int) -> bool:
        links, shares = _recalls(graph, own, units, asked, selves, least, ef)
        parts = [shares[links < FIRST], shares[links >= FIRST]]
        return all(p.mean() >= recall and np.quantile(p, LOW, method="lower") >= FLOOR for p in parts if len(p))

    ef = FIRST
    while ef < len(own) and not passes(ef):
        ef *= 2
    return ef


def _build(least: float, recall: float, audit_rows: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cid")
        own = _doubles(frame["v"])
        graph = Graph(_units(own))
        held = io.BytesIO()
        layers = {f"layer{i}": layer.astype(np.int32) for i, layer in enumerate(graph.layers)}
        np.savez(held, own=own, cid=frame["cid"].to_numpy(), n=frame["n"].to_numpy(), order=graph.order, **layers)
        ef = audited(graph, own, least, recall, audit_rows)
        first = frame.iloc[0]
        return pd.DataFrame({"dim": [first["dim"]], "shard": [first["shard"]], "ef": [ef], "graph": [held.getvalue()]})

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each class among the pairs that isn't its component's smallest: it and that one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _query(least: float):
    def run(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"cid": [], "links": [], "other": []}, dtype="Int64")
        if not len(queries) or not len(shard):
            return none
        held = np.load(io.BytesIO(shard["graph"].iloc[0]))
        own, cid, n = held["own"], held["cid"], held["n"]
        graph = Graph.__new__(Graph)
        graph.order = held["order"]
        graph.sorted = _units(own)[graph.order]
        graph.layers = [held[f"layer{i}"] for i in range(len([k for k in held if k.startswith("layer")]))]
        left, right = _pairs(graph, own, _doubles(queries["v"]), least, int(shard["ef"].iloc[0]))
        asked = queries["cid"].to_numpy()
        other = asked[left] != cid[right]
        left, right = left[other], right[other]
        if not len(left):
            return none
        links = np.bincount(left, n[right], len(asked)).astype(np.int64)
        some = np.flatnonzero(links)
        a, b = _forest(asked[left], cid[right])
        return pd.DataFrame(
            {
                "cid": np.concatenate([asked[some], a]),
                "links": np.concatenate([links[some], np.zeros(len(a), np.int64)]),
                "other": pd.array([None] * len(some) + b.tolist(), dtype="Int64"),
            }
        )

    return run


def near_duplicates(
    df: DataFrame,
    *,
    least: float = 0.95,
    recall: float = 0.995,
    audit_rows: int = 512,
    shard_bytes: int = 64 << 20,
    min_shards: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    ready(df)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    grouped = rows.where(usable("v")).groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = keep(grouped.select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("cid")), "vectors")
    size = classes.agg(F.count("*").alias("n"), F.sum("dim").alias("floats")).first()
    parts = -(-4 * (size.floats or 0) // shard_bytes)
    shards = max(1, parts, min(SHARDS, size.n // SHARD_CLASSES) if min_shards is None else min_shards)
    # A block of queries is as large as a shard, so neither is copied much more than the other.
    blocks = max(1, parts, min(SPREAD, -(-size.n // QUERIES)))
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("cid"), F.lit(shards)).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("cid", F.lit("block")), F.lit(blocks)).cast("int")
    )
    graphs = dealt.select("dim", "shard", "cid", "n", "v").groupBy("dim", "shard")
    graphs = keep(graphs.applyInPandas(_build(least, recall, audit_rows), "dim int, shard int, ef int, graph binary"), "graphs")

    asking = dealt.select("dim", "block", "cid", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    asked = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    at = ["dim", "shard", "block"]
    found = asking.groupBy(*at).cogroup(asked.groupBy(*at)).applyInPandas(_query(least), "cid long, links long, other long")
    found = keep(found, "vector-links")
    links = found.where("other IS NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.where("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b")))

    joined = joined.select(F.col("node").alias("cid"), F.col("component").alias("centre"))
    centred = classes.join(joined, "cid", "left").withColumn("centre", F.coalesce("centre", "cid"))
    firsts = centred.groupBy("centre").agg(F.min("first").alias("component_id"))
    named = (
        centred.join(firsts, "centre")
        .join(links, "cid", "left")
        .select("v", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    # A class links its own rows; a row without a class is its own component.
    return rows.join(named.withColumn("linked", F.lit(True)), "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        F.when(F.col("linked"), F.col("vec_id").eqNullSafe(F.col("component_id"))).otherwise(True).alias("kept"),
    )

"""Metric trees built from the middle out, and nearest entries found on them.

A *ball* is a point (its centroid), a radius that reaches all its points, their
number and their sum. The anchors hierarchy starts in the middle: about the
square root of n anchors are chosen one after another, each the point farthest
from its own anchor, which takes over the points nearer to it; only points
beyond half the distance between two anchors need to be looked at. The anchors'
balls are joined two by two, the tightest pair first, up to the root, and
opened by the same method down to leaves.

To assign points to entries of a codebook, every ball inherits the list of
entries that may be nearest to some point of its parent and strikes out those
that are farther from its centre than the nearest one by more than twice its
radius. A ball with one entry left is wholly owned: its sum and number count
for that entry and its points are not looked at. Leaves compare their points
with what is left of the list, in whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 32
#: Strikes are made only beyond this share of the distances, so that rounding never decides.
MARGIN = 1e-9


@dataclass
class Tree:
    """Balls in arrays; the points of ball ``i`` are ``points[first[i]:last[i]]``."""

    order: np.ndarray  # where each point came from
    points: np.ndarray  # whole numbers, in the order of the leaves
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray  # -1 for leaves
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of the rows of ``points`` (int64); the root is ball 0."""
    real = points.astype(np.float64)
    root = _open(real, np.arange(len(points)), leaf)
    order: list[np.ndarray] = []
    rows: list[list[int]] = []
    at = 0
    # Depth first, with children numbered when they are met.
    stack = [(root, -1, 0)]
    while stack:
        node, parent, side = stack.pop()
        number = len(rows)
        if parent >= 0:
            rows[parent][2 + side] = number
        n = node[0]
        rows.append([at, at + n, -1, -1])
        if len(node) == 2:
            order.append(node[1])
            at += n
        else:
            stack.append((node[2], number, 1))
            stack.append((node[1], number, 0))
    order = np.concatenate(order)
    sorted_points = points[order]
    first, last, left, right = np.array(rows, np.int64).reshape(-1, 4).T
    total = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(sorted_points, axis=0, out=total[1:])
    sums = total[last] - total[first]
    centre = sums / (last - first)[:, None]
    radius = np.empty(len(first))
    real = sorted_points.astype(np.float64)
    for i, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
        d = real[a:b] - centre[i]
        radius[i] = np.sqrt(np.einsum("ij,ij->i", d, d).max())
    return Tree(order, sorted_points, first, last, left, right, centre, radius, sums)


def _open(points: np.ndarray, members: np.ndarray, leaf: int) -> tuple:
    """A ball as ``(n, members)`` for a leaf or ``(n, left, right)``."""
    if len(members) <= leaf:
        return len(members), members
    groups, centres, radii = anchors(points[members])
    if len(groups) == 1:  # all points are equal
        return len(members), members
    return _join([_open(points, members[g], leaf) for g in groups], centres, radii)


def anchors(points: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """About the square root of n anchors: the points each owns, the anchors, and how far they reach."""
    n = len(points)
    pivots = [points[0]]
    distance = np.sqrt(((points - pivots[0]) ** 2).sum(1))
    owner = np.zeros(n, np.int64)
    for k in range(1, int(np.ceil(np.sqrt(n)))):
        far = int(np.argmax(distance))
        if distance[far] == 0:
            break
        between = np.sqrt(((np.array(pivots) - points[far]) ** 2).sum(1))
        near = np.flatnonzero(distance > between[owner] / 2)  # others cannot be nearer to the new anchor
        new = np.sqrt(((points[near] - points[far]) ** 2).sum(1))
        moved = new < distance[near]
        owner[near[moved]], distance[near[moved]] = k, new[moved]
        pivots.append(points[far])
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(pivots)))
    radii = np.zeros(len(pivots))
    np.maximum.at(radii, owner, distance)
    return np.split(order, cuts), np.array(pivots), radii


def _join(nodes: list, centres: np.ndarray, radii: np.ndarray) -> tuple:
    """Joins balls two by two, the pair with the smallest common ball first."""
    centres, radii = centres.copy(), radii.copy()
    k = len(nodes)

    def reach(i: int) -> np.ndarray:
        """Radius of the ball around ball i and each other."""
        d = np.sqrt(((centres - centres[i]) ** 2).sum(1))
        return np.maximum((d + radii + radii[i]) / 2, np.maximum(radii, radii[i]))

    common = np.array([reach(i) for i in range(k)])
    np.fill_diagonal(common, np.inf)
    alive = np.ones(k, bool)
    for _ in range(k - 1):
        i, j = divmod(int(np.argmin(common)), k)
        a, b = nodes[i][0], nodes[j][0]
        r = common[i, j]
        centre = (centres[i] * a + centres[j] * b) / (a + b)
        # Around the new centre the common ball may have to be wider.
        r = max(r, *(np.sqrt(((centre - centres[x]) ** 2).sum()) + radii[x] for x in (i, j)))
        nodes[i] = (a + b, nodes[i], nodes[j])
        centres[i], radii[i] = centre, r
        alive[j] = False
        row = np.where(alive, reach(i), np.inf)
        row[i] = np.inf
        common[i], common[:, i] = row, row
        common[j], common[:, j] = np.inf, np.inf
    return nodes[int(np.flatnonzero(alive)[0])]


def _frontier(tree: Tree, entries: np.ndarray):
    """Owned balls ``(ball, entry)`` and the leaves left with ``(ball, list of entries as a mask)``."""
    real = entries.astype(np.float64)
    balls = np.zeros(min(1, len(tree.first)), np.int64)
    listed = np.ones((len(balls), len(entries)), bool)
    owned, owners, leaves, lists = [], [], [], []
    while len(balls):
        gap = tree.centre[balls][:, None, :] - real[None]
        distance = np.where(listed, np.sqrt(np.einsum("ijk,ijk->ij", gap, gap)), np.inf)
        nearest = distance.min(1, keepdims=True)
        # Entries left out were farther than another one from every point of a ball around this one.
        listed &= distance * (1 - MARGIN) <= (nearest + 2 * tree.radius[balls][:, None]) * (1 + MARGIN)
        one = listed.sum(1) == 1
        owned.append(balls[one])
        owners.append(listed[one].argmax(1))
        rest, listed = balls[~one], listed[~one]
        leaf = tree.left[rest] < 0
        leaves.append(rest[leaf])
        lists.append(listed[leaf])
        inner, listed = rest[~leaf], listed[~leaf]
        balls = np.concatenate([tree.left[inner], tree.right[inner]])
        listed = np.concatenate([listed, listed])
    join = lambda parts, empty: np.concatenate(parts) if parts else empty
    none = np.zeros(0, np.int64)
    return join(owned, none), join(owners, none), join(leaves, none), join(lists, np.zeros((0, len(entries)), bool))


def _members(tree: Tree, balls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the balls' points, and for each the position of its ball in ``balls``."""
    n = tree.last[balls] - tree.first[balls]
    of = np.repeat(np.arange(len(balls)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + tree.first[balls][of], of


def _compare(tree: Tree, leaves: np.ndarray, lists: np.ndarray, entries: np.ndarray):
    """The nearest listed entry of the leaves' points, the lower index among equals."""
    at, of = _members(tree, leaves)
    row, entry = np.nonzero(lists[of])
    gap = tree.points[at[row]] - entries[entry]
    distance = np.full((len(at), len(entries)), np.iinfo(np.int64).max)
    distance[row, entry] = np.einsum("ij,ij->i", gap, gap)
    return at, distance.argmin(1)


def totals(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the points nearest to each entry."""
    sums, counts = np.zeros((len(entries), tree.points.shape[1]), np.int64), np.zeros(len(entries), np.int64)
    owned, owners, leaves, lists = _frontier(tree, entries)
    np.add.at(sums, owners, tree.sums[owned])
    np.add.at(counts, owners, tree.last[owned] - tree.first[owned])
    at, nearest = _compare(tree, leaves, lists, entries)
    np.add.at(sums, nearest, tree.points[at])
    np.add.at(counts, nearest, 1)
    return sums, counts


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of every point, in the points' own order."""
    found = np.empty(len(tree.points), np.int64)
    owned, owners, leaves, lists = _frontier(tree, entries)
    at, of = _members(tree, owned)
    found[at] = owners[of]
    at, nearest = _compare(tree, leaves, lists, entries)
    found[at] = nearest
    gap = tree.points - entries[found]
    code, error = np.empty_like(found), np.empty_like(found)
    code[tree.order], error[tree.order] = found, np.einsum("ij,ij->i", gap, gap)
    return code, error

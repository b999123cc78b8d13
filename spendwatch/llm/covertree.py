"""Cover trees over the parts of a block of integer vectors, and exact nearest entries by whole subtrees.

A tree's root covers all points of a part. The children of a node are a net of its points: the node's own centre first, then
any point farther than half the node's radius from the centres so far; every point belongs to the first centre that covers it. Points
are kept in tree order, so a node is a run of points whose first is its centre. A node carries its true radius, and the
cumulative sum of its points.

Assignment goes from the roots down. By the triangle inequality all points of a node with radius r have the nearest entry of
its centre if the second nearest is more than 2 r farther away; its count and sum are then added at once. Only nodes that are
not sure go on to their children, and at the leaves points are compared exactly, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np

#: Points of a node that is not split.
LEAF = 16
#: Components up to this are exact in double products.
_EXACT = 1 << 20


def runs(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one range after the other."""
    size = end - start
    return np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())


@dataclass
class Forest:
    """One tree a part. ``points`` (parts x n, width) in tree order; ``row`` is each one's vector of the block."""

    points: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray
    sums: np.ndarray

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f.name), TYPES[f.name]).tobytes() for f in fields(self)]

    @staticmethod
    def unpacked(parts: list[bytes], width: int) -> Forest:
        made = {f.name: np.frombuffer(b, TYPES[f.name]) for f, b in zip(fields(Forest), parts)}
        for name in ("points", "sums"):
            made[name] = made[name].reshape(-1, width)
        return Forest(**made)


#: Stored types; a block has fewer than 2^16 vectors, and components stay within 2^26.
TYPES = {
    "points": np.int32, "row": np.uint16, "start": np.int32, "end": np.int32,
    "radius": np.float64, "child": np.int32, "children": np.int32, "sums": np.int64,
}


def grown(parts: np.ndarray) -> Forest:
    """The trees of ``parts`` (parts, n, width), all split level by level together."""
    count, n, width = parts.shape
    flat = parts.reshape(count * n, width).astype(np.float64)
    order = np.arange(count * n)
    start = [np.arange(count) * n]
    end = [start[0] + n]
    root = flat[start[0]].repeat(n, axis=0)
    radius = [np.sqrt(((flat - root) ** 2).sum(axis=1).reshape(count, n).max(axis=1))]
    child, children = [], []
    made = count
    while True:
        s, e, r = start[-1], end[-1], radius[-1]
        split = (e - s > LEAF) & (r > 0)
        first, many = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
        child.append(first)
        children.append(many)
        if not split.any():
            break
        place = runs(s[split], e[split])
        group = np.repeat(np.arange(split.sum()), (e - s)[split])
        limit = (r[split] / 2) ** 2
        idx = order[place]
        at = flat[idx]
        owner = np.empty(len(idx), np.int64)
        far = np.empty(len(idx))
        centres: list[np.ndarray] = []
        nodes = 0
        left = np.arange(len(idx))
        while len(left):
            g = group[left]
            head = np.concatenate(([True], g[1:] != g[:-1]))
            which = np.cumsum(head) - 1
            x = at[left]
            d = ((x - x[head][which]) ** 2).sum(axis=1)
            near = d <= limit[g]
            owner[left[near]] = nodes + which[near]
            far[left[near]] = d[near]
            centres.append(g[head])
            nodes += int(head.sum())
            left = left[~near]
        parent = np.concatenate(centres)
        rank = np.empty(nodes, np.int64)
        rank[np.argsort(parent, kind="stable")] = np.arange(nodes)
        owner = rank[owner]
        by = np.argsort(owner, kind="stable")
        order[place] = idx[by]
        size = np.bincount(owner, minlength=nodes)
        head = np.concatenate(([0], np.cumsum(size)[:-1]))
        many[split] = np.bincount(parent, minlength=split.sum())
        first[split] = made + np.concatenate(([0], np.cumsum(many[split])[:-1]))
        start.append(place[head])
        end.append(place[head] + size)
        radius.append(np.sqrt(np.maximum.reduceat(far[by], head)))
        made += nodes
    s, e = np.concatenate(start), np.concatenate(end)
    points = parts.reshape(count * n, width)[order]
    total = np.concatenate((np.zeros((1, width), np.int64), np.cumsum(points, axis=0, dtype=np.int64)))
    return Forest(points, order % n, s, e, np.concatenate(radius), np.concatenate(child), np.concatenate(children), total[e] - total[s])


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of points to entries."""
    most = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if most <= _EXACT else np.int64
    x, book = x.astype(kind), book.astype(kind)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)[None, :]


def decided(forest: Forest, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(part, entries, nodes, None) of subtrees assigned as a whole, and (part, entries, places, squared distances) of single points."""
    count = len(books)
    n = len(forest.points) // count
    front = np.arange(count)
    while len(front):
        onward = []
        part = forest.start[front] // n
        for p in range(count):
            nodes = front[part == p]
            if not len(nodes):
                continue
            d = distances(forest.points[forest.start[nodes]], books[p])
            best = d.argmin(axis=1)
            if len(books[p]) > 1:
                two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
                r = forest.radius[nodes]
                sure = two[:, 1] - two[:, 0] > 2 * r + 1e-9 * (1 + two[:, 1] + r)
            else:
                sure = np.ones(len(nodes), bool)
            if sure.any():
                yield p, best[sure], nodes[sure], None
            open_nodes = nodes[~sure]
            inner = forest.children[open_nodes] > 0
            leaves, inner = open_nodes[~inner], open_nodes[inner]
            if len(leaves):
                places = runs(forest.start[leaves], forest.end[leaves])
                exact = distances(forest.points[places], books[p])
                nearest = exact.argmin(axis=1)
                yield p, nearest, places, exact[np.arange(len(places)), nearest]
            onward.append(runs(forest.child[inner], forest.child[inner] + forest.children[inner]))
        front = np.concatenate(onward) if onward else np.empty(0, np.int64)


def totals(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (parts, entries) and sums (parts, entries, width) of the points nearest to each entry."""
    counts = np.zeros(books.shape[:2], np.int64)
    sums = np.zeros(books.shape, np.int64)
    for p, entries, which, exact in decided(forest, books):
        if exact is None:
            np.add.at(counts[p], entries, (forest.end - forest.start)[which])
            np.add.at(sums[p], entries, forest.sums[which])
        else:
            np.add.at(counts[p], entries, 1)
            np.add.at(sums[p], entries, forest.points[which].astype(np.int64))
    return counts, sums


def codes(forest: Forest, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (n, parts) of every vector's parts, and the squared distances summed over the parts."""
    count = len(books)
    n = len(forest.points) // count
    found = np.zeros((n, count), np.uint8)
    error = np.zeros(n, np.int64)
    for p, entries, which, exact in decided(forest, books):
        if exact is None:
            size = (forest.end - forest.start)[which]
            places = runs(forest.start[which], forest.end[which])
            entries = np.repeat(entries, size)
            gap = forest.points[places].astype(np.int64) - books[p][entries]
            exact = (gap * gap).sum(axis=1)
        else:
            places = which
        found[forest.row[places], p] = entries
        # a part holds a vector once, so no place is added to twice
        error[forest.row[places]] += exact.astype(np.int64)
    return found, error

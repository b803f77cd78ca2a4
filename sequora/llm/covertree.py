"""Cover trees of blocks of vectors, kept as tables of nodes, and dual traversal of two of them.

Each level of a tree halves the radius of the level above: a node's children are a net of its
points (no two of the net within the halved radius, every point within it of one), and the node's
own point is among them. Levels that would have one child are passed over. Every point is a leaf
of radius 0; points are numbered so that those below a node form a range.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FEW = 8  # nodes of so few points have these as children at once, or none of their own unless they are well within their level's radius
PAIRS = 60_000  # pairs of nodes whose distances are taken at a time
CELLS = 4_000_000  # cells of a distance matrix at a time
TILE = 512, 1024  # rows and columns of a matrix of bounds at a time: what stays in a core's cache
LOW = 23  # directions that bounds on inner products take
LOW_SLACK = 1e-5  # bounds on inner products of unit vectors are this exact in single precision, with much to spare


@dataclass
class Tree:
    """x: points in leaf order. Nodes 0..n-1 are the points, then inner nodes; the root is node `root`."""

    x: np.ndarray
    parent: np.ndarray
    point: np.ndarray
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    given: np.ndarray | None = None  # the points as given, where x has them in another form
    low: np.ndarray | None = None  # short vectors whose inner products are at least those of the points

    def __post_init__(self):
        n = len(self.parent)
        self.root = int(np.flatnonzero(self.parent < 0)[0])
        below = np.argsort(self.parent, kind="stable")
        below = below[self.parent[below] >= 0]
        self.kids = below
        self.n_kids = np.bincount(self.parent[below], minlength=n)
        self.first = np.cumsum(self.n_kids) - self.n_kids
        self.norm = np.einsum("ij,ij->i", self.x, self.x)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y)[None, :] - 2 * (x @ y.T)
    return np.maximum(d, 0)


def shorten(a: Tree, b: Tree) -> None:
    """Give both trees of unit vectors short vectors: parts along the LOW directions that hold most of them, and the length of the rest.

    By Cauchy and Schwarz no inner product of points is above that of their short vectors.
    """
    if a.x.shape[1] <= 2 * LOW:
        return
    _, axes = np.linalg.eigh(a.x.T @ a.x + (0 if a is b else b.x.T @ b.x))
    for tree in (a, b):
        low = tree.x @ axes[:, -LOW:]
        rest = np.sqrt(np.maximum(tree.norm - np.einsum("ij,ij->i", low, low), 0))
        tree.low = np.ascontiguousarray(np.c_[low, rest].astype(np.float32))


def _open_cells(x: np.ndarray, y: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Cells of x @ y.T that reach the cut of their row; none at all if these aren't few."""
    rows, columns, left, found = *TILE, len(x) * len(y) // 16, []
    cut = cut.astype(np.float32)[:, None]
    for at in range(0, len(x), rows):
        for to in range(0, len(y), columns):
            cells = np.flatnonzero(x[at : at + rows] @ y[to : to + columns].T >= cut[at : at + rows])
            if len(cells):
                left -= len(cells)
                if left < 0:
                    return None
                p, q = np.divmod(cells, min(columns, len(y) - to))
                found.append((p + at, q + to))
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else (np.zeros(0, np.int64),) * 2


def _net(x: np.ndarray, members: np.ndarray, r: float) -> list[np.ndarray]:
    """Groups of members, each led by a point whose distance to the rest of its group is at most r, as exact as x."""
    centers, groups = [], []
    norm = np.einsum("ij,ij->i", x[members], x[members])
    while len(members):
        some = members[:256]
        close = squared(x[some], x[some]) <= r * r
        covered, picked = np.zeros(len(some), bool), []
        for k in range(len(some)):
            if not covered[k]:
                picked.append(k)
                covered |= close[k]
        leaders, half = x[some[picked]], norm[picked] - r * r
        inside, nearest = np.zeros(len(members), bool), np.zeros(len(members), np.int64)
        step = max(1, CELLS // len(picked) // 4)
        for at in range(0, len(members), step):
            d = x[members[at : at + step]] @ (-2 * leaders.T)
            d += half
            d += norm[at : at + step, None]  # squared distances less the square of r
            near = np.flatnonzero((d <= 0).any(1))
            inside[at + near], nearest[at + near] = True, d[near].argmin(1)
            if at < len(some):  # rounding must not part the first from their leaders
                rest = np.flatnonzero(~inside[at : min(at + step, len(some))])
                inside[at + rest], nearest[at + rest] = True, d[rest].argmin(1)
        own = members[inside]
        order = np.argsort(nearest[inside], kind="stable")
        cut = np.searchsorted(nearest[inside][order], np.arange(1, len(picked)))
        for c, g in zip(some[picked].tolist(), np.split(own[order], cut), strict=True):
            centers.append(c)
            groups.append(g)
        members, norm = members[~inside], norm[~inside]
    return [np.r_[c, g[g != c]] for c, g in zip(centers, groups, strict=True)]


def build(x: np.ndarray) -> tuple[np.ndarray, Tree]:
    """The order in which the points become leaves, and the tree over them."""
    n = len(x)
    far = np.sqrt(squared(x[:1], x).max()) if n else 0.0
    longest = np.abs(x).max() if n else 0.0
    single = x.astype(np.float32) if longest < 1e15 else x
    top = 2.0 ** np.ceil(np.log2(far)) if far > 0 else 0.0
    order, inner = [], []  # inner: parent, begin, end, radius
    stack = [(np.arange(n), top, -1)]
    leaf_parent = []
    while stack:
        item = stack.pop()
        if len(item) == 1:  # all points below an inner node have been numbered
            inner[item[0]][2] = len(order)
            continue
        members, r, parent = item
        if len(members) == 1:
            order.append(int(members[0]))
            leaf_parent.append(parent)
            continue
        d = np.sqrt(squared(x[members[:1]], x[members])[0])
        reach, me = float(d.max()), len(inner)
        if parent >= 0 and len(members) <= FEW and reach > r / 2:  # a node would say little of so few: they are children of the node above
            stack += [(members[k : k + 1], 0.0, parent) for k in range(len(members) - 1, -1, -1)]
            continue
        inner.append([parent, len(order), 0, reach])
        stack.append((me,))
        if len(members) <= FEW or reach == 0:
            stack += [(members[k : k + 1], 0.0, me) for k in range(len(members) - 1, -1, -1)]
            continue
        while r / 2 >= reach:
            r /= 2
        r /= 2
        near = d <= r
        near[0] = True
        # which points a group has is free, radii are exact: products in single precision will do unless r is short beside the vectors
        groups = [members[near], *_net(single if r > 0.01 * longest * x.shape[1] ** 0.5 else x, members[~near], r)]
        stack += [(g, r, me) for g in reversed(groups)]
    order = np.array(order, np.int64)
    parent = np.r_[leaf_parent, [i[0] for i in inner]].astype(np.int64)
    parent[parent >= 0] += n
    begin, end = (np.r_[np.arange(n) + k, [i[1 + k] for i in inner]].astype(np.int64) for k in (0, 1))
    radius = np.r_[np.zeros(n), [i[3] for i in inner]]
    point = begin.copy()  # a node's own point is numbered first
    return order, Tree(x[order], parent, point, radius, begin, end)


def dual(a: Tree, b: Tree, decide, least) -> None:
    """Walk pairs of nodes from the roots down.

    decide(i, j, dots) gets nodes of a and of b, pair by pair, and the inner products of their points;
    it deals with pairs that need no further descent and returns a mask of those to descend into.
    least(i, j, by_a) gets two lists of nodes and returns for each i (each j unless by_a) an inner
    product below which decide has no interest in a pair with any of the other list.
    """
    stack = [(np.array([a.root]), np.array([b.root]))]
    if not decide(stack[0][0], stack[0][1], np.einsum("ij,ij->i", a.x[a.point[stack[0][0]]], b.x[b.point[stack[0][1]]]))[0]:
        return
    while stack:
        i, j = stack.pop()
        if len(i) > PAIRS:
            stack.append((i[PAIRS:], j[PAIRS:]))
            i, j = i[:PAIRS], j[:PAIRS]
        # descend on the side of the larger radius; points have no children
        left = (a.n_kids[i] > 0) & ((a.radius[i] >= b.radius[j]) | (b.n_kids[j] == 0))
        for one, two, u, v, swapped in ((a, b, i[left], j[left], False), (b, a, j[~left], i[~left], True)):
            if len(u):
                for p, q in _children(one, two, u, v, decide, least, swapped):
                    stack.append((q, p) if swapped else (p, q))


def _grid(one: Tree, two: Tree, kids, v, decide, least, swapped: bool):
    """Pairs to descend into among all of kids (nodes of one) with all of v (nodes of two)."""
    x, short = one.x[one.point[kids]], one.low is not None and two.low is not None
    step = max(TILE[1] if short else 1, CELLS // len(kids))
    for at in range(0, len(v), step):
        rows = v[at : at + step]
        y = two.x[two.point[rows]]
        cut = least(rows, kids, False) if swapped else least(kids, rows, True)
        few = _open_cells(one.low[one.point[kids]], two.low[two.point[rows]], cut - LOW_SLACK) if short else None
        if few is None:
            dots = x @ y.T
            p, q = np.nonzero(dots >= cut[:, None])
            dots = dots[p, q]
        else:
            p, q = few
            dots = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", x[p[k : k + PAIRS]], y[q[k : k + PAIRS]]) for k in range(0, len(p), PAIRS)]])
            keep = dots >= cut[p]
            dots, p, q = dots[keep], p[keep], q[keep]
        for k in range(0, len(p), 8 * PAIRS):
            pk, qk, some = kids[p[k : k + 8 * PAIRS]], rows[q[k : k + 8 * PAIRS]], dots[k : k + 8 * PAIRS]
            keep = decide(qk, pk, some) if swapped else decide(pk, qk, some)
            if keep.any():
                yield pk[keep], qk[keep]


def _children(one: Tree, two: Tree, u, v, decide, least, swapped: bool):
    """Pairs to descend into among the children of u (nodes of one) with v (nodes of two)."""
    order = np.argsort(u, kind="stable")
    u, v = u[order], v[order]
    cut = np.flatnonzero(np.diff(u)) + 1
    starts, stops = np.r_[0, cut], np.r_[cut, len(u)]
    wide = (one.n_kids[u[starts]] >= 32) & (stops - starts >= 32)
    for s, e in zip(starts[wide].tolist(), stops[wide].tolist(), strict=True):
        # points apart from nodes with a radius, which would widen the bounds of all
        below = one.kids[one.first[u[s]] : one.first[u[s]] + one.n_kids[u[s]]]
        for kids in (below[one.n_kids[below] == 0], below[one.n_kids[below] > 0]):
            for rows in (v[s:e][two.n_kids[v[s:e]] == 0], v[s:e][two.n_kids[v[s:e]] > 0]):
                if len(kids) and len(rows):
                    yield from _grid(one, two, kids, rows, decide, least, swapped)
    rest = np.repeat(~wide, stops - starts)
    u, v = u[rest], v[rest]
    at = 0
    total = np.cumsum(one.n_kids[u])
    while at < len(u):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS)))
        n = one.n_kids[u[at:to]]
        q = np.repeat(v[at:to], n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = one.kids[np.repeat(one.first[u[at:to]], n) + within]
        for k in range(0, len(p), PAIRS):
            pk, qk = p[k : k + PAIRS], q[k : k + PAIRS]
            dots = np.einsum("ij,ij->i", one.x[one.point[pk]], two.x[two.point[qk]])
            keep = decide(qk, pk, dots) if swapped else decide(pk, qk, dots)
            if keep.any():
                yield pk[keep], qk[keep]
        at = to

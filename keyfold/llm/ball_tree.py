"""A ball tree over sparse vectors of whole numbers, for exact inner-product search.

Vectors are cut into the same few groups of terms. A node is a contiguous range of vectors
with their mean and, per group, the largest distance to it. For a query that takes the sum
of some terms, a node holds no larger sum than the mean's plus, group by group, the radius
times the root of the query's terms in it. Bounds are floats widened by more than their
rounding error, scores are sums of 64-bit integers.
"""

from __future__ import annotations

import heapq

import numpy as np

# Directions along which nodes are split; any split is right, a good one prunes more.
_DIRECTIONS = 16
# Widens bounds; far above the rounding error of sums of up to a million numbers.
_MARGIN = 1e-9


class Queries:
    """Sets of term numbers below ``terms``; ``group`` is each term's group.

    A term that one query alone holds is in that query's group, so that a query's bound
    rests on the few terms that it holds.
    """

    def __init__(self, sets: list[list[int]], terms: int):
        self.count, self.terms = len(sets), terms
        self.holds = np.zeros((self.count, terms), bool)
        for k, held in enumerate(sets):
            self.holds[k, held] = True
        users = self.holds.sum(axis=0)
        first = self.holds.argmax(axis=0) if self.count else np.zeros(terms, int)
        self.group = np.where(users == 1, first, self.count + np.arange(terms) % 8)
        self.groups = self.count + 8
        self.roots = np.zeros((self.groups, self.count))
        for k, held in enumerate(sets):
            self.roots[:, k] = np.sqrt(np.bincount(self.group[held], minlength=self.groups))


class Best:
    """The ``k`` best (score, id) of each query so far, with scores above 0.

    Equal scores go by ascending id; null ids come last.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.least = [1] * queries
        self._kept: list[list[tuple[int, bool, int]]] = [[] for _ in range(queries)]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.least[query])
        if not len(at):
            return
        if len(at) > self.k:
            at = at[np.lexsort((ids[at], null[at], -scores[at]))[: self.k]]
        new = zip((-scores[at]).tolist(), null[at].tolist(), ids[at].tolist())
        kept = self._kept[query] = sorted([*self._kept[query], *new])[: self.k]
        if len(kept) == self.k:
            self.least[query] = -kept[-1][0]

    def rows(self):
        for query, kept in enumerate(self._kept):
            for score, null, doc_id in kept:
                yield query, None if null else doc_id, -score


class BallTree:
    """Over the rows of ``starts, terms, values``: row i holds ``starts[i]:starts[i + 1]``.

    Rows must not be empty. Values must be whole and not negative.
    """

    def __init__(
        self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, queries: Queries, leaf: int = 32
    ):
        self._queries = queries
        sizes = np.diff(starts)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order, bounds = self._split(owner, terms, values, len(sizes), leaf)
        self.order = order
        # rows in the tree's order
        take = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in order])
        self._terms, self._values = terms[take], values[take]
        self._starts = np.concatenate([[0], np.cumsum(sizes[order])])
        self._leaves = bounds
        self._measure(np.repeat(np.arange(len(order)), sizes[order]))

    @staticmethod
    def _split(owner, terms, values, rows, leaf):
        """An order of the rows and its cuts into 2^depth leaves, split where rows spread most."""
        depth = max(0, int(np.ceil(np.log2(max(1, rows / leaf)))))
        signs = np.random.default_rng(11).choice([-1.0, 1.0], (int(terms.max(initial=0)) + 1, _DIRECTIONS))
        places = np.empty((rows, _DIRECTIONS))
        for d in range(_DIRECTIONS):
            places[:, d] = np.bincount(owner, values * signs[terms, d], rows)
        order, bounds = np.arange(rows), [0, rows]
        for _ in range(depth):
            cuts = [0]
            for a, b in zip(bounds, bounds[1:]):
                middle = (a + b) // 2
                if b - a > 1:
                    part = order[a:b]
                    widest = places[part].var(axis=0).argmax()
                    order[a:b] = part[np.argpartition(places[part, widest], middle - a)]
                cuts += [middle, b]
            bounds = cuts
        return order, np.array(bounds)

    def _measure(self, owner: np.ndarray) -> None:
        """Means and radii of all nodes; node i of a level covers 2i and 2i + 1 of the next."""
        queries, leaves = self._queries, len(self._leaves) - 1
        used, local = np.unique(self._terms, return_inverse=True)
        by_group = np.argsort(queries.group[used], kind="stable")
        rank = np.empty_like(by_group)
        rank[by_group] = np.arange(len(used))
        used, local = used[by_group], rank[local]
        groups, first = np.unique(queries.group[used], return_index=True)
        of_term = np.searchsorted(groups, queries.group[used])
        leaf_of = np.searchsorted(self._leaves, np.arange(len(self.order)), "right") - 1
        counts = np.diff(self._leaves).astype(float)
        width = len(used)
        sums = np.bincount(leaf_of[owner] * width + local, self._values.astype(float), leaves * width)
        sums = sums.reshape(leaves, width)

        means = sums / np.maximum(counts, 1)[:, None]
        squares = np.add.reduceat(means**2, first, axis=1)
        value, mean = self._values.astype(float), means[leaf_of[owner], local]
        rows = len(self.order)
        cell = owner * len(groups) + of_term[local]
        moved = np.bincount(cell, value * (value - 2 * mean), rows * len(groups)).reshape(rows, -1)
        scale = np.bincount(cell, value**2, rows * len(groups)).reshape(rows, -1)
        apart = np.maximum(squares[leaf_of] + moved, 0) + _MARGIN * (squares[leaf_of] + scale)
        radii = np.zeros((leaves, len(groups)))
        np.maximum.at(radii, leaf_of, np.sqrt(apart))

        holds = queries.holds[:, used].T.astype(float)
        self._bounds = []
        while True:
            far = radii @ queries.roots[groups]
            self._bounds.insert(0, ((means @ holds + far) * (1 + _MARGIN) + 1).T.tolist())
            if len(means) == 1:
                break
            low, high = sums[0::2], sums[1::2]
            sums, below = low + high, means
            counts = counts[0::2] + counts[1::2]
            means = sums / np.maximum(counts, 1)[:, None]
            # a ball around the new mean that holds both balls
            steps = [
                np.sqrt(np.add.reduceat((below[k::2] - means) ** 2, first, axis=1)) + radii[k::2]
                for k in (0, 1)
            ]
            radii = np.maximum(*steps) * (1 + _MARGIN)

    def search(self, best: Best, ids: np.ndarray, null: np.ndarray) -> int:
        """Offer each query its rows that may be among its best; returns the leaves scored.

        Nodes are opened in order of their bounds, and none whose bound is below what a
        query's list asks for. Equal scores may still win by id, so equal bounds are opened.
        """
        scored, last = 0, len(self._bounds) - 1
        ids, null = ids[self.order], null[self.order]
        for query in range(self._queries.count):
            holds = self._queries.holds[query]
            heap = [(-self._bounds[0][query][0], 0, 0)]
            while heap and -heap[0][0] >= best.least[query]:
                _, level, node = heapq.heappop(heap)
                if level < last:
                    bounds = self._bounds[level + 1][query]
                    for child in (2 * node, 2 * node + 1):
                        if bounds[child] >= best.least[query]:
                            heapq.heappush(heap, (-bounds[child], level + 1, child))
                    continue
                a, b = int(self._leaves[node]), int(self._leaves[node + 1])
                if a == b:
                    continue
                starts = self._starts[a : b + 1]
                part = slice(int(starts[0]), int(starts[-1]))
                taken = np.where(holds[self._terms[part]], self._values[part], 0)
                scores = np.add.reduceat(taken, starts[:-1] - starts[0])
                best.add(query, scores, ids[a:b], null[a:b])
                scored += 1
        return scored

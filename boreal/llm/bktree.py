"""BK-trees over 128-bit sketches, built and searched level by level with numpy for many shards at once.

In a BK-tree each child hangs from its parent by an edge that carries their integer Hamming distance d, and no
two children of a node have the same d. By the triangle inequality a query at distance q from a node needs only
the edges with q - radius <= d <= q + radius.
"""

from __future__ import annotations

import numpy as np

_EDGES = 256  # more than any distance between 128-bit sketches


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distance of sketches, as rows of 64-bit halves."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


class Forest:
    """One BK-tree for each shard: ``shard`` (any integers) and ``bits`` (rows of uint64 halves) of all items, in one batch."""

    def __init__(self, shard: np.ndarray, bits: np.ndarray):
        self.bits = bits
        n = len(bits)
        _, first, group = np.unique(shard, return_index=True, return_inverse=True)
        self.root_of = dict(zip(shard[first].tolist(), first.tolist(), strict=True))
        at = first[group].astype(np.int64)  # the node each item is compared with
        todo = np.flatnonzero(at != np.arange(n))
        edges, children = [], []
        while len(todo):
            node = at[todo]
            slot = node * _EDGES + distance(bits[todo], bits[node])
            used, lead, where = np.unique(slot, return_index=True, return_inverse=True)
            child = todo[lead]  # the first item of a slot becomes the child there, the others descend to it
            edges.append(used)
            children.append(child)
            at[todo] = child[where]
            todo = todo[at[todo] != todo]
        slot = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        child = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(slot)
        self.slot, self.child = slot[order], child[order]

    def search(self, shard: np.ndarray, bits: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, item) positions with a distance within the radius, in the query's own shard."""
        root = np.array([self.root_of.get(s, -1) for s in shard.tolist()], np.int64)
        query = np.flatnonzero(root >= 0)
        node = root[query]
        found_q, found_i = [], []
        while len(query):
            apart = distance(bits[query], self.bits[node])
            hit = apart <= radius
            found_q.append(query[hit])
            found_i.append(node[hit])
            low = np.searchsorted(self.slot, node * _EDGES + np.maximum(apart - radius, 0))
            high = np.searchsorted(self.slot, node * _EDGES + np.minimum(apart + radius, _EDGES - 1), side="right")
            width = high - low
            query = np.repeat(query, width)
            ahead = np.arange(len(query)) - np.repeat(np.cumsum(width) - width, width)
            node = self.child[np.repeat(low, width) + ahead]
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_i)

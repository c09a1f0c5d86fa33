"""Suffix trees of integer strings and constant-time longest common extensions."""

from __future__ import annotations

import numpy as np

_BLOCK = 16


def ukkonen(string: list[int]) -> tuple[list[int], list[int], dict[int, int]]:
    """Nodes of the suffix tree of ``string``, whose last symbol stands nowhere else.

    Built from left to right: after each symbol the tree holds all suffixes read so far, those that
    also stand elsewhere only implicitly. Returns per node the begin and the end in ``string`` of
    the label of the edge that leads to it (node 0 is the root; leaves end with the string), and
    {node * (len(string) + 1) + symbol: child}. Symbols are 0 to len(string).
    """
    size = len(string)
    width = size + 1
    begin, end, link = [0], [0], [0]
    child: dict[int, int] = {}
    find = child.get
    node = at = length = waiting = 0
    for i, symbol in enumerate(string):
        waiting += 1
        unlinked = 0
        while waiting:
            if not length:
                at = i
            key = node * width + string[at]
            below = find(key)
            if below is None:
                child[key] = len(begin)
                begin.append(i)
                end.append(size)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                start = begin[below]
                span = end[below] - start
                if length >= span:
                    at += span
                    length -= span
                    node = below
                    continue
                if string[start + length] == symbol:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                fork = len(begin)
                begin += (start, i)
                end += (start + length, size)
                link += (0, 0)
                child[key] = fork
                child[fork * width + symbol] = fork + 1
                child[fork * width + string[start + length]] = below
                begin[below] = start + length
                if unlinked:
                    link[unlinked] = fork
                unlinked = fork
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - waiting + 1
    return begin, end, child


class _Minimum:
    """Minima of ranges of an array in constant time: whole blocks by doubling, ends by running minima."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // _BLOCK)
        self._flat = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        self._flat[: len(values)] = values
        grid = self._flat.reshape(blocks, _BLOCK)
        self._from_left = np.minimum.accumulate(grid, axis=1).ravel()
        self._from_right = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
        self._levels = [grid.min(axis=1)]
        while 2 ** len(self._levels) <= blocks:
            below, half = self._levels[-1], 2 ** (len(self._levels) - 1)
            self._levels.append(np.minimum(below[:-half], below[half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of first..last (both included) of every query."""
        a, z = first // _BLOCK, last // _BLOCK
        out = np.minimum(self._from_right[first], self._from_left[last])
        inner = z - a - 1
        for level, table in enumerate(self._levels):
            here = np.flatnonzero((inner >= 2**level) & (inner < 2 ** (level + 1)))
            if len(here):
                ends = np.minimum(table[a[here] + 1], table[z[here] - 2**level])
                out[here] = np.minimum(out[here], ends)
        here = np.flatnonzero(a == z)
        if len(here):
            out[here] = self._flat[first[here]]
            for step in range(1, _BLOCK):
                place = np.minimum(first[here] + step, last[here])
                out[here] = np.minimum(out[here], self._flat[place])
        return out


class Extensions:
    """Longest common extensions of the suffixes of an integer string by its suffix tree.

    The tree is walked once in the order of symbols; on the Euler tour the lowest common ancestor
    of two leaves is the shallowest node between them, and its depth is their common prefix.
    """

    def __init__(self, symbols: np.ndarray):
        size = len(symbols)
        # The string's end stands for a symbol below all others.
        begin, end, child = ukkonen([*(symbols + 1).tolist(), 0])
        keys = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        children = below[order].tolist()
        parents = keys[order] // (size + 2)
        limits = np.searchsorted(parents, np.arange(len(begin) + 1)).tolist()
        depth = [0] * len(begin)
        tour: list[int] = []
        leaves: list[int] = []
        places: list[int] = []
        todo = [0]
        while todo:
            node = todo.pop()
            if node < 0:  # back at an inner node between two children
                tour.append(depth[~node])
                continue
            low, high = limits[node], limits[node + 1]
            if low == high:
                leaves.append(size + 1 - depth[node])
                places.append(len(tour))
                tour.append(depth[node])
                continue
            tour.append(depth[node])
            deep = depth[node]
            for k in range(high - 1, low - 1, -1):
                other = children[k]
                depth[other] = deep + end[other] - begin[other]
                todo.append(~node)
                todo.append(other)
        self._size = size
        self._place = np.zeros(size + 1, np.int64)
        self._place[leaves] = places
        #: Position of every suffix in their order, the empty one (first) included.
        self.rank = np.zeros(size + 1, np.int64)
        self.rank[leaves] = np.arange(size + 1)
        self._least = _Minimum(np.array(tour, np.int32))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and at ``b`` (a <> b, 0 to the size)."""
        x, y = self._place[a], self._place[b]
        return self._least(np.minimum(x, y), np.maximum(x, y)).astype(np.int64)

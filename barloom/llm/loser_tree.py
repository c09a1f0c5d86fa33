"""Merging of sorted, front-coded runs of byte strings without comparing known prefixes again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np


def front_code(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Common prefix with the row before (0 for the first), and the rest of every row, back to back.

    ``rows`` is a sorted matrix of bytes, one string of fixed width per row.
    """
    n, width = rows.shape
    common = np.zeros(n, np.int64)
    if n > 1:
        differ = rows[1:] != rows[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    rest = rows[np.arange(width)[None, :] >= common[:, None]]
    return common, rest.tobytes()


def decode(common: Sequence[int], rest: bytes, width: int) -> Iterator[bytes]:
    """The strings of a front-coded run, one after the other."""
    last, at = b"", 0
    for c in common:
        n = width - c
        last = last[:c] + rest[at : at + n]
        at += n
        yield last


def merge(runs: Sequence[tuple[Sequence[int], bytes]], width: int) -> Iterator[tuple[int, int, int]]:
    """Merges front-coded runs: (run, place in the run, common prefix with the string before).

    A tree of losers over the runs' heads. Every head carries its common prefix with the last
    string put out: the longer prefix is the smaller string, so only heads with equal prefixes are
    compared, and those from the first unknown byte on. A run's own front coding gives its next
    head's prefix without a comparison. Equal strings come in the order of the runs.
    """
    k = len(runs)
    size = 1
    while size < k:
        size *= 2
    streams = [decode(c, r, width) for c, r in runs]
    commons = [list(map(int, c)) for c, _ in runs]
    heads: list[bytes | None] = [next(s, None) for s in streams] + [None] * (size - k)
    prefix = [0] * size  # of the heads, with the last string put out
    place = [0] * size
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs' heads; the loser's prefix becomes the one with the winner."""
        x, y = heads[a], heads[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        p, q = prefix[a], prefix[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        while p < width and x[p] == y[p]:
            p += 1
        if p < width and x[p] > y[p] or p == width and a > b:
            prefix[a] = p
            return b, a
        prefix[b] = p
        return a, b

    def build(node: int) -> int:
        if node >= size:
            return node - size
        won, lost = play(build(2 * node), build(2 * node + 1))
        loser[node] = lost
        return won

    winner = build(1) if size > 1 else 0
    while heads[winner] is not None:
        at = place[winner]
        yield winner, at, prefix[winner]
        at += 1
        place[winner] = at
        heads[winner] = following = next(streams[winner], None)
        if following is not None:
            prefix[winner] = commons[winner][at]
        node = (winner + size) >> 1
        while node:
            other = loser[node]
            # The common cases, without a call: one run is at its end, or the prefixes differ.
            if heads[other] is not None:
                p, q = prefix[winner], prefix[other]
                if heads[winner] is None or q > p:
                    loser[node], winner = winner, other
                elif p == q:
                    winner, loser[node] = play(winner, other)
            node >>= 1

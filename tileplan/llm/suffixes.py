"""Repeated substrings of a collection by breadth-first backward extension on its Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def ranks(pieces: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, suffix order by the first ``depth`` symbols at least, first position of each piece).

    Every piece ends with a mark of its own, smaller than any byte, so no comparison passes the end of a piece.
    """
    sizes = np.array([len(p) + 1 for p in pieces], np.int64)
    ends = np.cumsum(sizes) - 1
    many = len(pieces)
    symbols = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + many
    symbols[ends] = np.arange(many)
    n = len(symbols)
    rank = symbols.copy()
    packed, wide = 1, int(symbols.max()) + 1
    while packed < 4 and wide < 1 << 15:  # a few symbols as one number save rounds
        after = np.zeros(n, np.int64)
        after[:-packed] = rank[packed:]
        rank, wide, packed = rank * wide + after, wide * wide, packed * 2
    step = packed
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    while step < depth and rank.max() + 1 < n:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return symbols, np.argsort(rank, kind="stable"), ends + 1 - sizes


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, whether the substring of ``length`` bytes at each of its positions occurs elsewhere in the
    collection, other places of the same piece included. One flag per position that has ``length`` bytes left.

    The interval of a string in the suffix order is extended backwards by all symbols at once, shortest strings first:
    the interval of cX, X of n symbols, ends where the common prefix of two neighbours has n symbols, unless that place
    is known already, in which case the string need not be followed. Common prefixes are so found by increasing value,
    and those still unknown when X has reached ``length`` symbols are ``length`` long at least.
    """
    many = len(pieces)
    symbols, order, first = ranks(pieces, length)
    n = len(symbols)
    transform = symbols[order - 1]
    column = symbols[order]
    back = np.empty(n, np.int64)  # row of the suffix that begins one symbol earlier
    back[np.argsort(transform, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
    high = np.append(low[1:], n)
    known[high] = True
    for _ in range(1, length):
        if not len(low):
            break
        size = high - low
        rows = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        parent = np.repeat(np.arange(len(low)), size)
        real = transform[rows] >= many
        target, parent = back[rows[real]], parent[real]
        if not len(target):
            break
        by = np.argsort(target)
        target, parent = target[by], parent[by]
        head = np.append(True, (target[1:] != target[:-1] + 1) | (parent[1:] != parent[:-1])
                         | (column[target[1:]] != column[target[:-1]]))
        begin = target[head]
        end = target[np.append(head[1:], True)] + 1
        new = ~known[end]
        low, high = begin[new], end[new]
        known[high] = True
    long = ~known[:-1] | ~known[1:]  # shares ``length`` symbols with the row before or after
    flags = np.zeros(n, bool)
    flags[order] = long
    return [flags[a:a + max(0, len(p) - length + 1)] for a, p in zip(first.tolist(), pieces, strict=True)]

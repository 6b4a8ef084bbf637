"""Suffix order of a sequence by induced sorting.

Suffixes that start a rising stretch (S*) are put in order first: their
substrings are sorted by one induction and named, and the sequence of names is
sorted the same way, recursively. A second induction then orders all suffixes.

An induction visits the symbols in order. The suffixes waiting for a symbol form
a first-in-first-out queue, which is what a priority queue of (symbol, rank of
the rest) amounts to, as ranks come in rising order; so all that wait for a
symbol are taken at once and the suffixes that they induce are appended, in
order, by array operations. All queues lie in one file-backed array, each in the
range that the counts of the symbols give it; sequences below IN_MEMORY
symbols keep it in memory. The file is deleted with the array's last use.

Recursion ends where names hardly repeat: there, ranks are doubled until they
are distinct.
"""

from __future__ import annotations

import tempfile

import numpy as np

IN_MEMORY = 1 << 24
#: Inductions cost time for each distinct symbol; with fewer repeats, double ranks.
LEAST_REPEATS = 32


def _array(n: int) -> np.ndarray:
    if n < IN_MEMORY:
        return np.zeros(n, np.int64)
    with tempfile.TemporaryFile() as file:
        file.truncate(8 * n)
        return np.memmap(file, np.int64, "r+", shape=(n,))


def _doubled(text: np.ndarray) -> np.ndarray:
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        rest = np.zeros(n, np.int64)
        rest[:n - step] = rank[step:] + 1
        key = rank * (n + 2) + rest
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ranked[1:] != ranked[:-1]])
        if n == 0 or rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


def _append(queue: np.ndarray, at: np.ndarray, symbols: np.ndarray, items: np.ndarray, way: int) -> None:
    """Put items into the queues of their symbols, in order; `at` holds the next
    free place of each queue and moves by `way`."""
    # Numpy sorts 16-bit keys by radix.
    order = np.argsort(symbols.astype(np.uint16) if len(at) <= 1 << 16 else symbols, kind="stable")
    symbols, items = symbols[order], items[order]
    first = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
    count = np.diff(np.r_[first, len(symbols)])
    within = np.arange(len(symbols)) - np.repeat(first, count)
    queue[at[symbols] + way * within] = items
    at[symbols[first]] += way * count


def _induce(text: np.ndarray, rising: np.ndarray, size: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order of all suffixes from that of the S* suffixes (`seeds`)."""
    n = len(text)
    start = np.cumsum(size) - size
    out = _array(n)
    symbols = np.flatnonzero(size)
    seed_symbol = text[seeds]
    seed_at = np.searchsorted(seed_symbol, np.arange(len(size) + 1))
    # Falling suffixes, from the left; the end of the text comes first of all.
    at = start.copy()
    _append(out, at, text[n - 1:], np.array([n - 1]), 1)
    for c in symbols:
        done = start[c]
        while done < at[c]:
            now = out[done:at[c]]
            done = at[c]
            before = now[now > 0] - 1
            before = before[~rising[before]]
            if len(before):
                _append(out, at, text[before], before, 1)
        own = seeds[seed_at[c]:seed_at[c + 1]]
        before = own[own > 0] - 1
        if len(before):
            _append(out, at, text[before], before, 1)
    falling_end = at
    # Rising suffixes, from the right.
    at = start + size - 1
    for c in symbols[::-1]:
        done = start[c] + size[c] - 1
        while done > at[c]:
            now = out[at[c] + 1:done + 1][::-1]
            done = at[c]
            before = now[now > 0] - 1
            before = before[rising[before]]
            if len(before):
                _append(out, at, text[before], before, -1)
        now = out[start[c]:falling_end[c]][::-1]
        before = now[now > 0] - 1
        before = before[rising[before]]
        if len(before):
            _append(out, at, text[before], before, -1)
    return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in ascending order; the end of the
    sequence sorts before every symbol. Symbols are integers from 0."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    text = text.astype(np.int64)
    size = np.bincount(text)
    if np.count_nonzero(size) * LEAST_REPEATS > n:
        return _doubled(text)
    ends = np.r_[np.flatnonzero(text[1:] != text[:-1]), n - 1]
    up = np.r_[text[ends[:-1]] < text[ends[:-1] + 1], False]
    rising = np.repeat(up, np.diff(np.r_[-1, ends]))
    stars = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if len(stars) < 2:
        return _induce(text, rising, size, stars)
    star = np.zeros(n, bool)
    star[stars] = True
    rough = _induce(text, rising, size, stars[np.argsort(text[stars], kind="stable")])
    ordered = rough[star[rough]]
    # Equal neighbours: S* substrings (up to and with the next S*) of one content.
    until = np.r_[stars[1:] + 1, n]
    end = np.zeros(n, np.int64)
    end[stars] = until
    name = np.cumsum(~_equal(text, ordered, end))
    if name[-1] == len(stars):
        seeds = ordered
    else:
        names = np.zeros(n, np.int64)
        names[ordered] = name
        seeds = stars[suffix_order(names[stars] - 1)]
    return _induce(text, rising, size, seeds)


def _equal(text: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether text[at[i]:end[at[i]]] equals that of i - 1."""
    length = end[at] - at
    same = np.r_[False, length[1:] == length[:-1]]
    last = len(text)
    # The last S* substring runs to the end of the text and equals no other.
    same &= end[at] < last
    same[1:] &= end[at[:-1]] < last
    k = np.flatnonzero(same)
    step = 0
    while len(k):
        k = k[length[k] > step] if step else k
        differ = text[at[k] + step] != text[at[k - 1] + step]
        same[k[differ]] = False
        k = k[~differ]
        step += 1
    return same


def common_prefix(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in
    `order`, up to `most`."""
    out = np.zeros(len(order), np.int64)
    k = np.arange(1, len(order))
    for step in range(most):
        a, b = order[k] + step, order[k - 1] + step
        inside = np.maximum(a, b) < len(text)
        k, a, b = k[inside], a[inside], b[inside]
        k = k[text[a] == text[b]]
        out[k] = step + 1
        if not len(k):
            break
    return out

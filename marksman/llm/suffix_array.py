"""Suffix arrays and common prefixes of byte strings, in numpy.

``suffix_array`` refines as Larsson and Sadakane do: suffixes are sorted by
their first 8 bytes, then groups of equal ones by the rank of the suffix 8, 16,
32, ... places further on; suffixes alone in their group are never touched
again. ``common_prefixes`` is Kasai's recurrence (a suffix shares at least one
byte less with its predecessor than the suffix before it did with its own), run
in many lanes of neighbouring places at once and capped.
"""

from __future__ import annotations

import numpy as np

LANES = 4096


def first_eight(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every place as one big-endian number (zeros past the end)."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data
    out = padded[:n].copy()
    for k in range(1, 8):
        out <<= np.uint64(8)
        out |= padded[k:n + k]
    return out


def _groups(new: np.ndarray) -> np.ndarray:
    """Rank of each sorted place: the place where its group begins."""
    at = np.arange(len(new), dtype=np.int32)
    return np.maximum.accumulate(np.where(new, at, np.int32(0)))


def suffix_array(data: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Starts of all suffixes, sorted by at least their first ``depth`` bytes
    (a suffix that ends sorts as if zeros followed; beyond the depth, by place)."""
    n = len(data)
    words = first_eight(data) if words is None else words
    sa = np.argsort(words, kind="stable")
    key = words[sa]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    start = _groups(new)
    rank = np.empty(n + 1, np.int32)
    rank[sa] = start + 1
    rank[n] = 0  # past the end
    h = 8
    # sorted places that share their group with another
    tied = np.flatnonzero(~new | ~np.append(new[1:], True))
    while h < depth and len(tied):
        group, suffix = start[tied].astype(np.int64), sa[tied]
        beyond = rank[np.minimum(suffix + h, n)]
        order = np.argsort((group << 32) | beyond, kind="stable")
        suffix, beyond, group = suffix[order], beyond[order], group[order]
        sa[tied] = suffix
        first = np.ones(len(tied), bool)
        first[1:] = (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])
        at = np.maximum.accumulate(np.where(first, np.arange(len(tied)), 0))
        start[tied] = tied[at]
        rank[suffix] = start[tied] + 1
        tied = tied[~first | ~np.append(first[1:], True)]
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, cap: int,
                    words: np.ndarray | None = None) -> np.ndarray:
    """For each sorted place the bytes its suffix shares with the one before
    it, at most ``cap`` (0 at the first place)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    words = first_eight(data) if words is None else words
    words = np.append(words, np.zeros(1, np.uint64))
    before = np.empty(n, np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[sa] = np.arange(n)
    rank[n] = -1
    lanes = min(LANES, n)
    length = -(-n // lanes)
    begin = np.arange(lanes, dtype=np.int64) * length
    shared = np.zeros(n, np.int32)
    run = np.zeros(lanes, np.int64)
    for step in range(length):
        place = begin + step
        on = np.flatnonzero(place < n)
        if len(on) < lanes:  # later lanes end earlier
            begin, run, place = begin[on], run[on], place[on]
            lanes = len(on)
        other = before[place]
        # the recurrence needs the predecessor's next suffix to be in front of
        # this one, which ties beyond the sorted depth need not keep
        follows = np.zeros(lanes, bool)
        if step:
            last = before[place - 1]
            follows = (last >= 0) & (rank[last + 1] < rank[place])
        run = np.where(follows & (other >= 0), np.maximum(run - 1, 0), 0)
        live = np.flatnonzero((other >= 0) & (run < cap))
        while len(live):
            p, q, r = place[live], other[live], run[live]
            a, b = p + r, q + r
            x = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
            same = np.full(len(live), 8, np.int64)
            odd = np.flatnonzero(x)
            if len(odd):
                y = x[odd]
                lead = np.zeros(len(odd), np.int64)
                for k in range(1, 8):
                    lead += y < np.uint64(1 << (64 - 8 * k))
                same[odd] = lead
            # no more than what is left of the data
            r = r + np.minimum(same, np.maximum(n - np.maximum(a, b), 0))
            run[live] = np.minimum(r, cap)
            live = live[(same == 8) & (r < cap) & (np.maximum(p, q) + r < n)]
        shared[place] = run
    out = shared[sa].astype(np.int64)
    out[0] = 0
    return out


__all__ = ["common_prefixes", "first_eight", "suffix_array"]

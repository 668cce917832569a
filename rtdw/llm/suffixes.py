"""Repeated strings in a bounded text: suffix order, Burrows-Wheeler transform, intervals."""

from __future__ import annotations

import numpy as np

SYMBOLS = 257


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of a text in order of at least their first ``depth`` symbols.

    Symbols are 0 to 256. Ranks by seven symbols are doubled; rotations whose rank is
    already their own are not sorted again.
    """
    n = len(text)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | np.roll(text, -j).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    known = 7
    while known < depth:
        # Places in the order whose group has more than one member.
        several = ~(new & np.append(new[1:], True))
        places = np.flatnonzero(several)
        if not len(places):
            break
        at = order[places]
        pair = rank[at] * n + rank[(at + known) % n]
        inner = np.argsort(pair, kind="stable")
        order[places] = at[inner]
        pair = pair[inner]
        fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
        new[places] = fresh
        rank[order[places]] = np.maximum.accumulate(np.where(fresh, places, 0))
        known *= 2
    return order


def long_repeats(text: np.ndarray, least: int) -> np.ndarray:
    """Whether the string of ``least`` symbols that begins at each place begins elsewhere too.

    The text is taken as a circle. Strings are extended backwards breadth first on the
    Burrows-Wheeler transform: the interval of rotations that begin with a string gives,
    for each symbol before them, the interval of the longer string. Where an interval ends
    for the first time, neighbours in the order have that string's length, less one, in
    common. So common prefixes come out by increasing length, and the walk stops at
    ``least``: neighbours not yet told apart share at least so many symbols.
    """
    n = len(text)
    order = suffix_order(text, least)
    before = text[order - 1].astype(np.int64)
    by_symbol = np.argsort(before, kind="stable")
    first = np.empty(n, np.int64)  # where a rotation stands once its symbol before is put in front
    first[by_symbol] = np.arange(n)
    told_apart = np.zeros(n + 1, bool)
    told_apart[0] = told_apart[n] = True
    counts = np.bincount(before, minlength=SYMBOLS)
    ends = np.cumsum(counts)
    low, high = (ends - counts)[counts > 0], ends[counts > 0] - 1
    for _ in range(least):
        fresh = ~told_apart[high + 1]
        # The last interval of a level ends at the end of the order, which is no new end,
        # but its strings have still to be extended once.
        fresh |= (high == n - 1) & (low > 0)
        low, high = low[fresh], high[fresh]
        told_apart[high + 1] = True
        if not len(low):
            break
        one = low == high
        single = first[low[one]]
        low, high = low[~one], high[~one]
        sizes = high - low + 1
        offsets = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) + np.repeat(low - offsets, sizes)
        key = np.repeat(np.arange(len(low)), sizes) * SYMBOLS + before[places]
        sort = np.argsort(key, kind="stable")
        ranked = key[sort]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(ranked)) - 1 if len(heads) else heads
        low = np.concatenate([single, first[places[sort[heads]]]])
        high = np.concatenate([single, first[places[sort[tails]]]])
    same = ~told_apart[1:n]
    out = np.zeros(n, bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out

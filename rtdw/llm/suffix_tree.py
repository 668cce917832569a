"""Suffix trees: longest common extensions in constant time, and the order of the suffixes."""

from __future__ import annotations

import numpy as np

BLOCK = 16


class RangeLeast:
    """Least values of ranges in constant time: blocks by themselves, and a sparse table of them."""

    def __init__(self, values: np.ndarray):
        self.values = values
        top = np.iinfo(values.dtype).max
        blocks = np.append(values, np.full(-len(values) % BLOCK, top, values.dtype)).reshape(-1, BLOCK)
        self.before = np.minimum.accumulate(blocks, 1).ravel()
        self.after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self.rows = [blocks.min(1)]
        while 1 << len(self.rows) <= len(blocks):
            half = 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(self.rows[-1][:-half], self.rows[-1][half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least values from ``low`` to ``high``, both included."""
        out = np.minimum(self.after[low], self.before[high])
        first, last = low // BLOCK + 1, high // BLOCK  # whole blocks between
        level = np.frexp(np.maximum(last - first, 1).astype(float))[1] - 1
        for k in np.unique(level[last > first]).tolist():
            at = np.flatnonzero((last > first) & (level == k))
            row = self.rows[k]
            between = np.minimum(row[first[at]], row[last[at] - (1 << k)])
            out[at] = np.minimum(out[at], between)
        inner = np.flatnonzero(first > last)
        if len(inner):
            low, high = low[inner], high[inner]
            own = self.values[low]
            for step in range(1, BLOCK):
                own = np.minimum(own, self.values[np.minimum(low + step, high)])
            out[inner] = own
        return out


class SuffixTree:
    """Ukkonen's suffix tree of a list of symbols (1 and up), with its Euler tour.

    The end of the text is a symbol of its own, smaller than all others. ``ranks`` and
    ``turned_ranks`` (for the reversed order of symbols) tell where each suffix stands among
    all in lexicographic order, a prefix being before what it begins. A tree takes some
    hundred bytes a symbol.
    """

    def __init__(self, symbols: list[int], turned: bool = False):
        self.n = len(symbols)
        self._build([*symbols, 0])
        self._walk()
        self.turned_ranks = self._turned() if turned else None

    def _build(self, text: list[int]) -> None:
        size, width = len(text), max(text) + 1
        start, end, link = [0], [0], [0]
        go: dict[int, int] = {}  # by node and first symbol
        node = edge = length = waiting = 0
        leaves = []
        for i, symbol in enumerate(text):
            waiting += 1
            without_link = 0
            while waiting:
                if not length:
                    edge = i
                key = node * width + text[edge]
                below = go.get(key)
                if below is None:
                    go[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    if without_link:
                        link[without_link] = node
                    without_link = node
                else:
                    begin = start[below]
                    own = min(end[below], i + 1) - begin
                    if length >= own:
                        edge += own
                        length -= own
                        node = below
                        continue
                    if text[begin + length] == symbol:
                        length += 1
                        if without_link:
                            link[without_link] = node
                        break
                    middle = len(start)
                    go[key] = middle
                    go[middle * width + symbol] = middle + 1
                    go[middle * width + text[begin + length]] = below
                    start += (begin, i)
                    end += (begin + length, size)
                    link += (0, 0)
                    leaves.append(middle + 1)
                    start[below] = begin + length
                    if without_link:
                        link[without_link] = middle
                    without_link = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        keys, below = np.fromiter(go.keys(), np.int64, len(go)), np.fromiter(go.values(), np.int64, len(go))
        order = np.argsort(keys)
        self.below = below[order]
        self.first = np.searchsorted(keys[order], np.arange(len(start) + 1) * width).tolist()
        self.has_end = keys[order] % width == 0  # of nodes below: reached by the end of the text
        self.size = np.subtract(end, start).tolist()
        self.suffix = [-1] * len(start)
        for at, leaf in enumerate(leaves):
            self.suffix[leaf] = at

    def _walk(self) -> None:
        first, size, suffix, below = self.first, self.size, self.suffix, self.below.tolist()
        depth = [0] * len(size)
        tour, met, order = [], [0] * (self.n + 1), []
        stack = [0]
        while stack:
            node = stack.pop()
            if node < 0:
                tour.append(~node)
                continue
            own = depth[node]
            at = suffix[node]
            if at >= 0:
                met[at] = len(tour)
                order.append(at)
                tour.append(own)
                continue
            tour.append(own)
            low, high = first[node], first[node + 1]
            for child in reversed(below[low:high]):
                depth[child] = own + size[child]
                stack += (child, ~own)
            stack.pop()
        self.met = np.array(met, np.int64)
        self.tour = RangeLeast(np.array(tour, np.int32))
        self.ranks = np.empty(self.n + 1, np.int64)
        self.ranks[order] = np.arange(self.n + 1)

    def _turned(self) -> np.ndarray:
        first, suffix, below, has_end = self.first, self.suffix, self.below.tolist(), self.has_end.tolist()
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            at = suffix[node]
            if at >= 0:
                order.append(at)
                continue
            low, high = first[node], first[node + 1]
            if has_end[low]:  # the end stays the smallest
                stack += below[low + 1 : high]
                stack.append(below[low])
            else:
                stack += below[low:high]
        ranks = np.empty(self.n + 1, np.int64)
        ranks[order] = np.arange(self.n + 1)
        return ranks

    def common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many symbols the different suffixes ``one`` and ``other`` begin with in common."""
        a, b = self.met[one], self.met[other]
        return self.tour.least(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)

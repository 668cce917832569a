"""Plain versions of the operators, for small tables."""

import re
from collections import Counter

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text, size=5):
    own = words(text)
    return frozenset(tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))) if own else frozenset()


def decontaminated(docs, items, window=10):
    """Per document: words, hit words, item ids."""
    where = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1)) if own else ():
            where.setdefault(tuple(own[i : i + window]), set()).add(item)
    sizes = {len(w) for w in where}
    out = []
    for _, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if ids := where.get(tuple(own[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= ids
        out.append((len(own), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def trimmed(texts, least):
    """Per text: kept bytes, removed bytes, removed runs."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - least + 1):
            if seen[d[i : i + least]] > 1:
                gone[i : i + least] = b"\x01" * least
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out.append((bytes(b for b, g in zip(d, gone, strict=True) if not g), sum(gone), runs))
    return out


def near_classes(texts, threshold=0.8):
    """Per text: index of the first text of its class, links."""
    sets = [shingle_set(t) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(find(i), n) for i, n in enumerate(links)]


def edit_distance(a, b, swaps=True):
    """Levenshtein distance; swapping two neighbours is one edit."""
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                rows[i][j] = i + j
                continue
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if swaps and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]

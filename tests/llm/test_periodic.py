"""Periodic runs against all periods tried one by one."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rtdw.llm.periodic import op13_periodic, periodic_runs, runs_of, runs_of_texts
from rtdw.llm.suffix_tree import SuffixTree
from rtdw.llm.words import texts_of


def plain_runs(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def some_words(rng, most):
    kinds, n = rng.choice([1, 2, 3, 5, 60]), rng.randint(0, most)
    words = [rng.randint(1, kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        start, period = rng.randrange(n), rng.randint(1, n)
        words = [w if i < start else words[min(start + (i - start) % period, n - 1)] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("least", [2, 3, 12])
def test_runs(least):
    rng = random.Random(least)
    for _ in range(1500):
        words = some_words(rng, 45)
        assert [tuple(x) for x in runs_of(words, least).tolist()] == plain_runs(words, least), words


def test_tree():
    rng = random.Random(5)
    for _ in range(300):
        text = [rng.randint(1, 3) for _ in range(rng.randint(1, 40))]
        tree = SuffixTree(text, turned=True)
        suffixes = sorted(range(len(text) + 1), key=lambda i: text[i:])
        assert [int(tree.ranks[i]) for i in suffixes] == list(range(len(text) + 1))
        turned = sorted(range(len(text) + 1), key=lambda i: [-x for x in text[i:]])
        assert [int(tree.turned_ranks[i]) for i in turned] == list(range(len(text) + 1))
        i, j = rng.randrange(len(text) + 1), rng.randrange(len(text) + 1)
        if i != j:
            common = next((k for k, (a, b) in enumerate(zip(text[i:], text[j:], strict=False)) if a != b), min(len(text) - i, len(text) - j))
            assert tree.common(np.array([i]), np.array([j])).tolist() == [common]


def test_texts_and_stretches():
    rng = random.Random(7)
    lists = []
    for _ in range(400):
        words = [f"é{x}" if x % 2 else f"w{x}," for x in some_words(rng, 60) + some_words(rng, 80)]
        lists.append(words)
    texts = [rng.choice([" ", "\n\t", "  "]).join(words) for words in lists]
    owner, start, length, period, *_ = runs_of_texts(texts_of(pa.array(texts)), 12)
    got = [[] for _ in lists]
    for at, *run in zip(owner.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
        got[at].append(tuple(run))
    assert got == [plain_runs(words, 12) for words in lists]


def expected(doc_id, text, digest):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda x: (x[0], x[2])))
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, digest(lines), digest(left))


@pytest.mark.parametrize("odd", [False, True])
def test_query(spark, sf_dir, odd_dir, odd, digest):
    folder = odd_dir if odd else sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    docs = [(a, b) for a, b in docs if b is None or len(b) < 20_000]
    ids = {a for a, _ in docs}
    got = [tuple(r) for r in op13_periodic(spark, folder).collect() if odd or r[0] in ids]
    want = [expected(a, b, digest) for a, b in docs]
    assert not set(map(str, want)) - set(map(str, got))


def test_words_and_collapsed_texts(spark):
    line = "one two three four"
    rows = [(1, f"{line} {line}\n{line} {line} end"), (2, ""), (3, None), (4, " \n "), (5, " a  b　 c ")]
    out = periodic_runs(spark.createDataFrame(rows, "id long, text string"), ["id"]).orderBy("id").collect()
    assert [r["n_words"] for r in out] == [17, 0, 0, 0, 3]
    assert [tuple(x) for x in out[0]["runs"]] == [(0, 16, 4)]
    assert [r["collapsed"] for r in out] == [f"{line} end", "", "", "", "a  b　 c"]

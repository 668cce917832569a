"""Decontamination, near duplicates, repeats and packing against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rtdw.llm import decontamination, jaccard, packing, repeats, suffixes
from rtdw.llm.components import components
from rtdw.llm.queries import QUERIES

from . import brute


def documents(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["odd_dir", "sf_dir"])
def test_decontamination(spark, request, which, digest):
    folder = request.getfixturevalue(which)
    docs = documents(spark, folder)
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    want = Counter(
        (doc_id, n, hit, len(ids), digest(",".join(ids)), hit > 0)
        for (doc_id, _), (n, hit, ids) in zip(docs, brute.decontaminated(docs, items), strict=True)
    )
    assert Counter(tuple(r) for r in QUERIES["op5_decontamination"](spark, folder).collect()) == want
    assert any(key[-1] for key in want)


def test_blocks_of_items_give_the_same(spark, odd_dir, monkeypatch):
    plain = Counter(map(tuple, QUERIES["op5_decontamination"](spark, odd_dir).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    assert Counter(map(tuple, QUERIES["op5_decontamination"](spark, odd_dir).collect())) == plain


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha beta gamma y"), (2, "alpha z beta gamma"), (3, "alpha beta z z z z gamma")], "key long, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    found = lambda slop: {
        r["key"]: r["n_hit"] for r in decontamination.decontaminate(docs, items, slop=slop).collect() if r["contaminated"]
    }
    assert found(0) == {1: 3}
    assert found(1) == {1: 3, 2: 4}
    assert set(found(4)) == {1, 2, 3}


def test_proximity_at_the_ends_of_documents(spark):
    rows = [(1, "gamma alpha beta"), (2, "gamma alpha beta"), (3, "gamma alpha beta")]
    docs = spark.createDataFrame(rows, "key long, text string").coalesce(1)
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    found = decontamination.decontaminate(docs, items, slop=3).collect()
    assert {r["key"]: r["n_hit"] for r in found if r["contaminated"]} == {1: 3, 2: 3, 3: 3}


@pytest.mark.parametrize("which", ["odd_dir", "sf_dir"])
@pytest.mark.parametrize("block", [256, 2])
def test_near_classes(spark, request, which, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    folder = request.getfixturevalue(which)
    docs = sorted(documents(spark, folder), key=lambda d: (d[0] is None, d[0] or 0))
    found = brute.near_classes([t for _, t in docs])
    want = Counter((doc_id, docs[first][0], links) for (doc_id, _), (first, links) in zip(docs, found, strict=True))
    got = Counter(tuple(r)[:3] for r in QUERIES["op4_jaccard"](spark, folder).collect())
    assert got == want


def test_one_document_of_each_class_stays(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    kept = jaccard.near_unique(spark, docs, odd_dir)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 1 and not {2, 3, 12} & ids.keys()  # copies and a near copy of 1, a copy of 11
    assert ids[22] == 2  # two texts, one of them repeated
    assert {6, 7, 9, 10} <= ids.keys()  # without words: linked with none


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= jaccard.MOST_HASHES


def test_components(spark):
    rng = random.Random(3)
    edges = [(f"{a:03d}", f"{b:03d}") for a, b in ((rng.randrange(200), rng.randrange(200)) for _ in range(150))]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


def test_long_repeats_of_random_texts():
    rng = np.random.default_rng(0)
    for case in range(150):
        n, least = int(rng.integers(2, 100)), int(rng.integers(1, 20))
        text = rng.integers(0, rng.integers(1, 5), n).astype(np.int64)
        if case % 3 == 0 and n > 40:
            text[n // 2 : n // 2 + 15] = text[3:18]
        strings = [tuple(np.roll(text, -i)[:least]) for i in range(n)]
        times = Counter(strings)
        assert suffixes.long_repeats(text, least).tolist() == [times[s] > 1 for s in strings]


@pytest.mark.parametrize("shards", [(1 << 20, 4 << 20), (600, 1 << 20), (600, 3000), (1 << 20, 0)])
def test_repeats(spark, odd_dir, digest, shards, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shards[0])
    monkeypatch.setattr(repeats, "ANCHOR_BYTES", shards[1])
    docs = documents(spark, odd_dir)
    want = Counter(
        (doc_id, len((text or "").encode()), gone, runs, digest(kept))
        for (doc_id, text), (kept, gone, runs) in zip(docs, brute.trimmed([t for _, t in docs], 400), strict=True)
    )
    assert Counter(map(tuple, QUERIES["op8_repeats"](spark, odd_dir).collect())) == want
    assert sum(key[2] > 0 for key in want) > 6


def test_trimmed_documents_keep_their_columns(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    out = repeats.trimmed_documents(spark, docs, odd_dir)
    assert out.schema.names == docs.schema.names and out.count() == docs.count()
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


@pytest.mark.parametrize("which", ["odd_dir", "sf_dir"])
def test_packing(spark, request, which):
    import public_tokenizers
    from tokenizers import Tokenizer

    folder = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text in documents(spark, folder):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    rows = QUERIES["op7_packing"](spark, folder).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_plans_of_hard_lengths_are_near_the_bound():
    rng = random.Random(1)
    for _ in range(20):
        counts = Counter(rng.choice([rng.randint(1, 100), rng.randint(20, 60), 100]) for _ in range(400))
        plan = packing.plan_packing(dict(counts), 100)
        used = Counter()
        for pattern, times in plan:
            assert sum(pattern) <= 100
            for length in pattern:
                used[length] += times
        assert used == counts
        sequences = sum(times for _, times in plan)
        large = sum(n for length, n in counts.items() if length > 50)
        assert sequences <= max(large, -(-sum(k * n for k, n in counts.items()) // 100)) * 1.03 + 1


def test_all_lengths_are_tried_in_a_filling():
    lengths = [500, *range(990, 998)]
    counts = dict.fromkeys(lengths, 1) | {500: 2}
    assert packing.best_filling(1000, lengths, counts) == [500, 500]


def test_plans_are_never_longer_than_best_fit_decreasing():
    def best_fit_decreasing(counts, capacity):
        spaces = []
        for length in sorted(Counter(counts).elements(), reverse=True):
            fits = [(space, i) for i, space in enumerate(spaces) if space >= length]
            if fits:
                spaces[min(fits)[1]] -= length
            else:
                spaces.append(capacity - length)
        return len(spaces)

    rng = random.Random(4)
    cases = [({209: 300, 999: 200, 777: 100, 203: 400}, 2048)]
    cases += [(Counter(rng.randint(20, 60) for _ in range(120)), 100) for _ in range(10)]
    for counts, capacity in cases:
        plan = packing.plan_packing(dict(counts), capacity)
        used = Counter()
        for pattern, times in plan:
            assert times > 0 and sum(pattern) <= capacity
            used.update({x: n * times for x, n in Counter(pattern).items()})
        assert used == Counter(counts)
        sequences, decreasing = sum(times for _, times in plan), best_fit_decreasing(counts, capacity)
        parts = packing.best_fit_decreasing(counts, capacity)
        assert sum(times for _, times in parts) == decreasing
        assert packing.least_sequences(counts, capacity) <= sequences <= decreasing


def test_short_plans_are_the_shortest():
    def shortest(lengths, spaces, capacity):
        if not lengths:
            return len(spaces)
        first, rest = lengths[0], lengths[1:]
        tried = [
            shortest(rest, [*spaces[:i], space - first, *spaces[i + 1 :]], capacity)
            for i, space in enumerate(spaces) if space >= first and space not in spaces[:i]
        ]
        return min([*tried, shortest(rest, [*spaces, capacity - first], capacity)])

    rng = random.Random(7)
    for _ in range(40):
        lengths = sorted((rng.randint(4, 14) for _ in range(9)), reverse=True)
        plan = packing.plan_packing(dict(Counter(lengths)), 24)
        assert sum(times for _, times in plan) == shortest(lengths, [], 24)


def test_the_cached_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["<|endoftext|> It'S don't “x” é É foo\tbar <|ENDOFTEXT|> ΣΑΣ İx\r\n 4.5%%.", "", " ", "\n\n", "a  b\n", "x" * 5000]
    plain = [[*e.ids, 0] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    own = packing.Encoder(path)
    assert [x.tolist() for x in own.encode(texts)] == plain == [x.tolist() for x in own.encode(texts)]

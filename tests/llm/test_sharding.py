"""Shards: near-equal sizes, gapless slots, equal texts together."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rtdw.llm.sharding import SHARDS, document_shards, levels, op12_sharding, shard_rows, write_shards


def check_places(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= shard < SHARDS for shard in slots)


def test_documents(spark, sf_dir):
    rows = op12_sharding(spark, sf_dir).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    held, where = Counter(), defaultdict(set)
    for r in rows:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "bytes")
        held[r["shard"]] += r["size"]
        where[text].add(r["shard"])
    check_places(rows)
    mean = sum(held.values()) / SHARDS
    total = Counter()
    for text in texts.values():
        total[text] += len(text) + 8
    assert all(len(shards) == 1 for text, shards in where.items() if total[text] <= mean / 4)
    largest = max(len(text) + 8 for text in texts.values())
    assert max(held.values()) - min(held.values()) <= max(largest, mean / 10)


def test_hot_key_long_rows_and_repeated_rows(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") < 2500, F.lit(7)).when(F.col("id") < 2600, F.lit(8)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") == 5999, F.lit(40_000)).otherwise(F.lit(100) + F.col("id") % 50).alias("s"),
        F.lit(1).alias("t"),
    ).repartition(3)
    out = shard_rows(rows, F.xxhash64("k"), F.col("s"), F.col("t")).collect()
    assert len(out) == 6000
    check_places(out)
    held = Counter()
    for r in out:
        held[r["shard"]] += r["s"]
    mean = (sum(held.values()) - 40_000) / (SHARDS - 1)  # one row is more than a shard
    rest = sorted(held.values())[:-1]
    assert max(held.values()) == 40_000 and rest[0] > 0.95 * mean and rest[-1] < 1.05 * mean
    assert len({r["shard"] for r in out if r["k"] == 7}) > 5


def test_levels():
    dealt, before = levels([(1, 100), (2, 10)], 60, 3)
    assert dealt[0] != dealt[1]
    room = [b - a for a, b in zip(before, [*before[1:], 60], strict=True)]
    held = [0, 0, 0]
    held[dealt[0]] += 100
    held[dealt[1]] += 10
    assert sorted(a + b for a, b in zip(room, held, strict=True)) == [35, 35, 100]
    assert levels([], 0, 2) == ([], [0, 0])


@pytest.mark.parametrize("shards", [1, 5])
def test_written_shards_read_back(spark, odd_dir, tmp_path, shards):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    out = document_shards(docs, ["doc_id", "source"], shards=shards)
    write_shards(out, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(str, back.select(*out.columns).collect())) == Counter(map(str, out.collect()))
    assert back.count() == docs.count()

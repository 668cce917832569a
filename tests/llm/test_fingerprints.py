import random

from pyspark.sql import functions as F

from rtdw.llm import simhash
from rtdw.llm.order import with_next
from rtdw.llm.queries import QUERIES


def test_edited_texts_and_likeness(spark, sf_dir, digest):
    docs = sorted(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect(), reverse=True
    )
    rows = {r["doc_id"]: r for r in QUERIES["op1_fingerprints"](spark, sf_dir).collect()}
    prints = {}
    for i, (doc_id, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)]["text"]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert (rows[doc_id]["n_chars"], rows[doc_id]["edited_sha256"]) == (len(text), digest(edited))
        assert prints.setdefault(text, rows[doc_id]["fingerprint"]) == rows[doc_id]["fingerprint"]
        bits = bin(int(rows[doc_id]["fingerprint"], 16) ^ int(rows[doc_id]["edited_fingerprint"], 16)).count("1")
        assert rows[doc_id]["near_edited"] == 1 - bits / simhash.BITS
    closer = sum(r["near_edited"] > r["near_next"] for r in rows.values())
    assert closer > 0.95 * len(rows)


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(5)
    numbers = [rng.getrandbits(128) for _ in range(60)]
    for base in numbers[:30]:
        for flips in range(6):
            near = base
            for bit in rng.sample(range(128), flips):
                near ^= 1 << bit
            numbers.append(near)
    numbers = list(dict.fromkeys(numbers))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(n >> 64), signed(n & ((1 << 64) - 1))) for n in numbers]
    df = spark.createDataFrame(rows, "part0 long, part1 long")
    want = {
        (i, j) for i, a in enumerate(numbers) for j, b in enumerate(numbers) if bin(a ^ b).count("1") <= 3
    }
    at = {row: i for i, row in enumerate(rows)}
    for blocks in (4, 6):
        found = simhash.within_radius(df, df, 3, blocks).collect()
        pairs = [(at[r["part0"], r["part1"]], at[r["near0"], r["near1"]]) for r in found]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == want


def test_next_rows_cross_ranges_and_wrap(spark):
    ids = [5, -3, 90, 17, 17, 2**40, 8] + list(range(1000, 1400))
    df = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)], "id long, t string")
    out = with_next(df, "id", F.xxhash64("t"), {"t": "after", "id": "next"}).collect()
    assert len(out) == len(ids)
    order = sorted(ids, reverse=True)
    assert sorted((r["id"], r["next"]) for r in out) == sorted(zip(order, order[1:] + order[:1], strict=True))
    one = with_next(df.limit(1), "id", F.xxhash64("t"), {"t": "after"}).collect()
    assert [(r["t"], r["after"]) for r in one] == [("t0", "t0")]


def test_no_python_on_the_way(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = simhash.fingerprints(docs, ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

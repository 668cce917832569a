"""Dictionary words of Han text against a plain version."""

import random
import re
from collections import Counter

import pytest

from rtdw.operators import segment

TOKEN = re.compile("[一-鿿\U00020000-\U0002a6df]+|[a-z0-9]+")


def plain_words(text, dictionary, longest=segment.LONGEST):
    out = []
    for token in TOKEN.findall((text or "").lower()):
        at = 0
        while at < len(token):
            size = len(token) if token[0] < "一" else 1
            for n in range(2, longest + 1) if size == 1 else ():
                if token[at : at + n] in dictionary and at + n <= len(token):
                    size = n
            out.append(token[at : at + size])
            at += size
    return out


def found(spark, lines, dictionary, **options):
    df = spark.createDataFrame(lines, "id long, t string")
    words = spark.createDataFrame([(w,) for w in dictionary], "word string")
    got = segment.dictionary_words(df, "t", words, **options)
    assert got.columns == ["id", "t", "word"]
    return Counter((r["id"], r["word"]) for r in got.collect())


def wanted(lines, dictionary, **options):
    return Counter((i, w) for i, t in lines for w in plain_words(t, dictionary, **options))


@pytest.mark.parametrize(
    "dictionary", [["苹果", "手机", "苹果手机", "机壳", "𠀀字", "苹果"], ["果手", "机壳红"], ["红"], []]
)
def test_words_of_lines(spark, dictionary):
    lines = [
        (1, "苹果手机壳 Pro,红 a7"), (2, "苹果手机壳 Pro,红 a7"), (2, "果手机壳红"), (3, None), (4, ""), (5, "--"),
        (6, "𠀀字𠀀"), (None, "手机"), (7, "红"), (8, "苹果" * 500 + "机"),
    ]
    assert found(spark, lines, dictionary) == wanted(lines, dictionary)


def test_overlapping_words_of_random_runs(spark):
    rng = random.Random(5)
    run = lambda low, high: "".join(rng.choices("天地人日", k=rng.randint(low, high)))
    dictionary = sorted({run(1, 6) for _ in range(60)})
    lines = [(i, run(1, 60) + rng.choice(["", " x ", ","]) + run(0, 60)) for i in range(200)]
    assert found(spark, lines, dictionary) == wanted(lines, dictionary)
    assert found(spark, lines, dictionary, longest=3) == wanted(lines, dictionary, longest=3)


def test_no_lines(spark):
    assert not found(spark, [], ["苹果"])


def test_counted_dictionary(spark):
    df = spark.createDataFrame([("苹果 手机 A",), ("苹果,红 手机壳",), (None,)], "t string")
    assert [r[0] for r in segment.counted_dictionary(df, "t", support=2).collect()] == ["苹果"]
    assert {r[0] for r in segment.counted_dictionary(df, "t", support=1, longest=2).collect()} == {"苹果", "手机"}


def test_small_dictionaries_cut_runs_without_a_shuffle(spark):
    lines = [(1, "苹果手机壳 x"), (2, "壳" * 300 + "苹果手机" * 300), (3, None)]
    dictionary = ["苹果", "手机", "苹果手机", "机壳", "a b"]
    df = spark.createDataFrame(lines, "id long, t string")
    words = spark.createDataFrame([(w,) for w in dictionary], "word string")
    got = segment.dictionary_words(df, "t", words)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert Counter((r["id"], r["word"]) for r in got.collect()) == wanted(lines, dictionary)
    assert segment.listed_words(words, limit=3) is None
    assert found(spark, lines, dictionary, max_listed=3) == wanted(lines, dictionary)


def test_random_runs_by_the_join(spark):
    rng = random.Random(6)
    run = lambda low, high: "".join(rng.choices("天地人日", k=rng.randint(low, high)))
    dictionary = sorted({run(2, 6) for _ in range(60)})
    lines = [(i, run(1, 60) + rng.choice(["", " x ", ","]) + run(0, 600)) for i in range(100)]
    want = wanted(lines, dictionary)
    assert found(spark, lines, dictionary) == want == found(spark, lines, dictionary, max_listed=1)


def test_large_dictionaries_go_along_too(spark):
    """Above 200,000 words the pieces of all places were joined, with hundreds of times the text on disk."""
    rng = random.Random(7)
    letters = [chr(0x4E00 + 37 * i) for i in range(90)] + ["𠀀", "𪛖"]
    dictionary = set()
    while len(dictionary) < 200_001:
        dictionary.add("".join(rng.choices(letters, k=rng.choice((2, 3, 3, 4, 8)))))
    dictionary = sorted(dictionary)
    lines = [(i, "".join(rng.choices(dictionary, k=9)) + rng.choice(letters) + " a1 ") for i in range(300)]
    df = spark.createDataFrame(lines, "id long, t string")
    got = segment.dictionary_words(df, "t", spark.createDataFrame([(w,) for w in dictionary], "word string"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    known = set(dictionary)
    assert Counter((r["id"], r["word"]) for r in got.collect()) == wanted(lines, known)
    assert segment.listed_pattern(["天", "天地", "天地人", "日月山", "日月水"]) == "天(?:地(?:人)?)?|日(?:月(?:山|水))"

import hashlib
import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["key", "text_key", "score", "kept", "k1", "n", "label", "root", "bucket", "set", "hashes", "x", "row", "size", "shard",
           "runs", "id", "component"]


def words(seed, count):
    rng = random.Random(seed)
    parts = ["an", "er", "on", "the", "ou", "tion", "ing", "re", "ha", "st", "in", "le"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(count))


def sample_documents():
    """Copies, near copies, shared passages, nulls, empty and very long texts, repeated rows."""
    base, passage = words(1, 200), words(2, 120)
    near = base.split()
    near[7] = "changed"
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, words(3, 150) + " " + passage),
        (5, passage + " " + words(4, 90)), (6, None), (7, ""), (8, "Ä ß 漢字 \U0001F600 été"),
        (9, "..."), (10, "..."), (11, "one two"), (12, "one two"), (13, words(5, 6000)),
        (20, "a" * 3000), (21, "ab" * 900), (22, words(6, 60)), (22, words(6, 60)), (22, words(7, 60)),
        (None, words(8, 40)), (None, None), (40, words(9, 400)), (60, words(9, 395) + " other end"),
    ]
    out = []
    for i, (doc_id, text) in enumerate(rows):
        lang = [None, "en", "fr"][i % 3]
        out.append((doc_id, text, lang, f"src{i % 2}" if i % 5 else None, None if text is None else len(text)))
    return out


def write(spark, rows, schema, path, clashes):
    df = spark.createDataFrame(rows, schema)
    for name in clashes:
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS {name}")
    df.repartition(2).write.parquet(str(path))


def make_tables(spark, folder, documents, clashes=()):
    labels = [(i, i % 2, (i // 2) % 2) for i in range(1, 40)] + [(None, 1, 0), (1, None, None), (2, 0, 1)]
    pages = [
        (1, "http://a/1", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://a/3", None), (4, "http://a/\n4", ""),
        (4, "http://a/4", ""), (None, "u", "<p>x</p>"), (9, "http://a/9", "é" * 50_000), (8, "u", "only"),
    ]
    bench = [(1, words(3, 150)), (2, "one two"), (3, None), (4, "..."), (None, words(9, 30)), (2, "one two"), (5, words(5, 30))]
    talks = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"), (1, 2, "user", "bye"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (3, 0, "system", None), (3, None, None, "x"),
        (4, 5, "assistant", "é\U0001F600"), (None, 0, "user", "lost"), (5, 0, "user", "q"), (5, 1, "assistant", None),
        (5, 2, "user", "w"), (5, 3, "assistant", "last"),
    ]
    nan, inf = float("nan"), float("inf")
    vectors = [(i, [((i * 7) % 11) / 4, ((i * 5) % 13) / 8 - 1, i / 3], i % 2) for i in range(30)]
    vectors += [
        (1, [1.5, 2.0, -0.25], 0), (1, [1.5, 2.0, -0.25], 0), (40, None, 1), (41, [1.0, None, 2.0], 1),
        (42, [1.0, nan, 2.0], 1), (43, [inf, 0.0, 1.0], None), (None, [0.5, -0.0, 0.25], None), (44, [2.0], 1), (45, [], 0),
        (46, [1e20, 0.0, 0.0], 0),
    ]
    if not documents:
        labels, pages, bench, talks, vectors = [], [], [], [], []
    write(spark, documents, DOCUMENTS, folder / "documents.parquet", clashes)
    write(spark, labels, "doc_id long, quality int, toxic int", folder / "labels.parquet", clashes)
    write(spark, pages, "page_id long, url string, html string", folder / "pages.parquet", clashes)
    write(spark, bench, "item_id long, text string", folder / "benchmark.parquet", clashes)
    write(spark, talks, "conv_id long, turn long, role string, text string", folder / "conversations.parquet", clashes)
    write(spark, vectors, "vec_id long, embedding array<float>, label int", folder / "embeddings.parquet", clashes)
    return str(folder)


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    return make_tables(spark, tmp_path_factory.mktemp("odd"), sample_documents())


@pytest.fixture(scope="session")
def clash_dir(spark, tmp_path_factory):
    return make_tables(spark, tmp_path_factory.mktemp("clash"), sample_documents(), CLASHES)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return make_tables(spark, tmp_path_factory.mktemp("empty"), [])


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="session")
def digest():
    return sha

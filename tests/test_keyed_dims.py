"""The keyed dimension store: touched buckets only, each batch once, seq before arrival."""

import random

import pytest

from rtdw.session import fresh_dir, listed_files, publish_text
from rtdw.sinks import keyed_dims
from rtdw.sinks.keyed_dims import KeyedDimension
from rtdw.streaming import jobs

from test_jobs import CONFIG, change, write


def changes(spark, rows):
    """Rows of (after, type, seq)."""
    return spark.createDataFrame(rows, "after map<string,string>, type string, seq bigint")


def rows_of(frame):
    return {r["id"]: tuple(r)[1:] for r in frame.collect()}


@pytest.fixture
def store(spark):
    return KeyedDimension(spark, fresh_dir(spark, "keyed"), ["id", "name", "level"], buckets=16)


def test_changes_in_any_order_give_the_newest(spark, store):
    rng = random.Random(3)
    log = []
    for seq in range(300):
        image = {"id": str(rng.randrange(40)), "name": f"n{seq}"}
        if rng.random() < 0.4:
            image["level"] = None if rng.random() < 0.2 else f"l{seq}"
        log.append((image, rng.choice(["insert", "update", "update", "delete"]), seq))
    want = {}
    for image, kind, _ in log:
        if kind != "delete":
            want.setdefault(image["id"], {}).update(image)
    rng.shuffle(log)
    for batch in range(3):
        assert store.apply(changes(spark, log[batch * 100 : batch * 100 + 100]), batch)
    assert rows_of(store.read()) == {k: (v["name"], v.get("level")) for k, v in want.items()}


def test_a_repeated_batch_is_not_applied_again(spark, store):
    assert store.apply(changes(spark, [({"id": "1", "name": "a"}, "insert", 1)]), 0)
    before = listed_files(spark, store.root)
    assert not store.apply(changes(spark, [({"id": "1", "name": "b"}, "update", 2)]), 0)
    assert listed_files(spark, store.root) == before and rows_of(store.read()) == {"1": ("a", None)}


def test_a_batch_that_fails_is_not_seen(spark, store, monkeypatch):
    store.load(spark.createDataFrame([("1", "a", "x")], "id string, name string, level string"))

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(keyed_dims, "publish_text", fail)
    with pytest.raises(OSError):
        store.apply(changes(spark, [({"id": "1", "name": "b"}, "update", 2)]), 0)
    assert rows_of(store.read()) == {"1": ("a", "x")}
    monkeypatch.setattr(keyed_dims, "publish_text", publish_text)
    assert store.apply(changes(spark, [({"id": "1", "name": "b"}, "update", 2)]), 0)
    assert rows_of(store.read()) == {"1": ("b", "x")}


def test_only_touched_buckets_are_written_and_read(spark, store):
    rows = spark.range(1000).selectExpr("cast(id as string) id", "concat('n', id) name", "'x' level")
    store.load(rows)
    before = store.version()["folders"]
    assert len(before) == 16
    few = [({"id": str(k), "name": "new"}, "update", 1) for k in (5, 6)]
    store.apply(changes(spark, few), 0)
    after = store.version()["folders"]
    touched = {b for b in after if after[b] != before[b]}
    assert 1 <= len(touched) <= 2
    assert rows_of(store.read()) == {str(k): ("new" if k in (5, 6) else f"n{k}", "x") for k in range(1000)}

    one = store.lookup_one("7")
    assert rows_of(one) == {"7": ("n7", "x")}
    assert len({f.rpartition("/")[0] for f in one.inputFiles()}) == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,7)" in plan and "level" in plan
    assert rows_of(store.lookup_one("absent")) == {}

    keys = spark.createDataFrame([(5,), (7,), (7,), (None,), (5000,)], "user long")
    some = store.lookup(keys, "user")
    assert rows_of(some) == {"5": ("new", "x"), "7": ("n7", "x")} and some.count() == 2
    assert len({f.rpartition("/")[0] for f in some.inputFiles()}) <= 3


def test_vacuum_keeps_what_versions_name(spark, store):
    for n in range(5):
        store.apply(changes(spark, [({"id": str(k), "name": f"{n}"}, "update", n) for k in range(n, 40)]), n)
    want = rows_of(store.read())
    store.vacuum()
    assert rows_of(store.read()) == want and sorted(store._manifests()) == [3, 4]
    files = [path for path, _ in listed_files(spark, store.root) if path.endswith(".parquet")]
    assert len(files) <= 2 * 16


def test_empty_tables_and_batches(spark, store):
    assert rows_of(store.read()) == {}
    store.apply(changes(spark, [({"name": "no key"}, "insert", 1), ({"id": "1"}, "delete", 2)]), 0)
    assert rows_of(store.read()) == {} and rows_of(store.lookup_one("1")) == {}


def test_columns_that_a_batch_does_not_know_stay(spark, store):
    store.apply(changes(spark, [({"id": "1", "name": "a", "level": "x"}, "insert", 1)]), 0)
    narrow = KeyedDimension(spark, store.root, ["id", "name", "phone"])
    narrow.apply(changes(spark, [({"id": "1", "name": "b", "phone": "5"}, "update", 2)]), 1)
    assert rows_of(narrow.read()) == {"1": ("b", "5")} and rows_of(store.read()) == {"1": ("b", "x")}


def test_jobs_keep_the_same_dimensions(spark, tmp_path):
    lines = [
        change("user_info", 1, id=1, name="a", birthday="2000-01-01", gender="F"),
        change("user_info", 2, id=2, name="b", birthday="2000-01-02", gender="M"),
    ]
    got = []
    for keyed in (False, True):
        root = tmp_path / str(keyed)
        root.mkdir()
        w = jobs.Warehouse(spark, str(root), every=None, keyed_dims=keyed)
        write(root, jobs.CONFIG_LOG, 1, CONFIG)
        for part, rows in enumerate((lines, [change("user_info", 3, id=2, name="b", gender="F")])):
            write(root, jobs.DB_LOG, part, rows)
            jobs.start_db_routing(w, compact_every=1).awaitTermination()
        got.append(sorted(map(tuple, w.dimension("user").collect())))
    assert got[0] == got[1] and len(got[0]) == 2

"""Streaming forms over several micro-batches and restarts give what stored tables give."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rtdw.functions.times import millis_to_ts
from rtdw.operators import events, logs, stats
from rtdw.operators import visits as stored_visits
from rtdw.plans import standin
from rtdw.session import fresh_dir, session_settings, shared_dir
from rtdw.streaming import keyed, visits
from rtdw.streaming.run import start_table

TIMEOUT = "6 hours"
END = 4_000_000_000_000


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return standin.log_records(standin.table(spark, sf_dir, "events")).selectExpr(
        "event_id", "common", "page", "ts", "common.mid as mid", "common.is_new as is_new"
    ).where("page is not null").cache()


def feed(spark, pages, tmp_path_factory, run):
    """Run a streaming form over four time-ordered files, restarted for each; last comes a
    row far ahead that moves the watermark past everything."""
    root = tmp_path_factory.mktemp("feed")
    far = pages.limit(1).selectExpr(
        "-1L as event_id", "named_struct('mid', 'far', 'is_new', '0', 'vc', 'v', 'ch', 'c', 'ar', 'a') as common",
        "page", f"{END} as ts", "'far' as mid", "'0' as is_new")
    quarter = F.ntile(4).over(standin_window())
    parts = pages.withColumn("part", quarter).collect()
    source, out, checkpoint = (fresh_dir(spark, n) for n in ("in", "out", "checkpoint"))
    for part in (1, 2, 3, 4, 5):
        rows = far if part == 5 else spark.createDataFrame(
            [r for r in parts if r["part"] == part],
            pages.schema.simpleString()[7:-1] + ", part: int").drop("part")
        rows.coalesce(1).write.mode("append").parquet(f"{source}")
        stream = spark.readStream.schema(rows.schema).parquet(source)
        with session_settings(spark, {"spark.sql.shuffle.partitions": "2"}):
            start_table(run(stream), out, checkpoint, every=None).awaitTermination()
    return spark.read.parquet(out)


def standin_window():
    from pyspark.sql import Window

    return Window.orderBy("ts", "event_id")


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or ("event_id",))).collect())


def test_new_visitor(spark, pages, tmp_path_factory):
    rows = ("event_id", "mid", "ts", "is_new")
    got = feed(spark, pages, tmp_path_factory, lambda s: keyed.fix_new_visitor(
        s.select(*rows), order=("ts", "event_id")))
    want = logs.fix_new_visitor(pages.select(*rows))
    assert ids(got.where("event_id >= 0"), *rows) == ids(want, *rows)


def test_new_visitors_of_many_devices_share_state_keys(spark, pages, tmp_path_factory):
    """A key of the state holds all devices of a part, also rows without a device."""
    rows = ("event_id", "mid", "ts", "is_new")
    some = pages.withColumn("mid", F.expr("nullif(mid, '1')"))
    keys = []

    def run(s, parts):
        out = keyed.first_flags(s.select(*rows).where("is_new = '1'"), order=("ts", "event_id"), parts=parts)
        keys.append(out._jdf.queryExecution().analyzed().toString())
        return out

    one, many = (feed(spark, some, tmp_path_factory, lambda s, n=n: run(s, n)) for n in (1, 64))
    want = ids(logs.fix_new_visitor(some.where("is_new = '1'").select(*rows)), *rows[::2], "is_new")
    assert ids(one, *rows[::2], "is_new") == ids(many, *rows[::2], "is_new") == want
    assert all("__part" in plan for plan in keys)
    assert one.where("mid is null").count() > 1


def test_unique_visit(spark, pages, tmp_path_factory):
    got = feed(spark, pages, tmp_path_factory, lambda s: visits.unique_visits(s).select("mid", "ts"))
    day = F.to_date(millis_to_ts("ts")).cast("string")
    want = stored_visits.unique_visits(pages, tiebreak=("event_id",))
    assert ids(got.where("mid <> 'far'"), "mid", day) == ids(want, "mid", day)


def test_bounce(spark, pages, tmp_path_factory):
    got = feed(spark, pages, tmp_path_factory, lambda s: keyed.bounces(
        s.selectExpr("mid", "ts", "page.last_page_id is null as entry",
                     "lpad(event_id, 9, '0') as tie", "cast(event_id as string) as value"), TIMEOUT))
    want = stored_visits.bounces(pages, tiebreak=("event_id",), timeout=TIMEOUT)
    assert ids(got, F.col("value").cast("bigint")) == ids(want)


def test_bounces_of_many_devices_share_state_keys(spark, pages, tmp_path_factory):
    """A key of the state holds all devices of a part, also rows without a device."""
    keys = []

    def run(s, parts):
        rows = s.selectExpr(
            "nullif(mid, '1') as mid", "ts", "page.last_page_id is null as entry",
            "lpad(event_id, 9, '0') as tie", "cast(event_id as string) as value")
        out = keyed.bounces(rows, TIMEOUT, parts=parts)
        keys.append(out._jdf.queryExecution().analyzed().toString())
        return out

    one = feed(spark, pages, tmp_path_factory, lambda s: run(s, 1))
    many = feed(spark, pages, tmp_path_factory, lambda s: run(s, 50))
    unnamed = pages.withColumn("common", F.expr("named_struct('mid', nullif(common.mid, '1'))"))
    want = ids(stored_visits.bounces(unnamed, tiebreak=("event_id",), timeout=TIMEOUT))
    value = F.col("value").cast("bigint")
    assert ids(one, value) == want == ids(many, value) and len(want) > 20
    assert all("part" in text for text in keys)


def test_expiring_visits_of_many_devices_share_state_keys(spark, pages, tmp_path_factory):
    """One entry per device in few keys of the state; each counts once a day over several micro-batches."""
    named = pages.select("event_id", "common", "page", "ts", "mid", "is_new")
    # In processing time a run without new input would never be the last.
    with session_settings(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
        out = feed(spark, named, tmp_path_factory, lambda s: visits.unique_visits_with_expiry(
            s.selectExpr("*", "cast(event_id as string) as value"), ttl="1 day", parts=3))
    want = stored_visits.unique_visits(pages, tiebreak=("event_id",))
    day = F.to_date(millis_to_ts("ts")).cast("string")
    assert ids(out.where("mid <> 'far'"), "mid", "day") == ids(want, "mid", day)
    checkpoint, stored = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "in")
    named.selectExpr("*", "cast(event_id as string) as value").write.parquet(stored)
    stream = spark.readStream.schema(spark.read.parquet(stored).schema).parquet(stored)
    with session_settings(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
        kept = visits.unique_visits_with_expiry(stream, parts=3)
        start_table(kept, fresh_dir(spark, "out"), checkpoint, every=None).awaitTermination()
    state = visits.stored_state(spark, checkpoint, "last")
    newest = want.groupBy("mid").agg(F.max(day).alias("day"))
    assert ids(state, "user_map_key.mid", "user_map_value.value.day") == ids(newest, "mid", "day")
    assert state.select("key").distinct().count() <= 3 < newest.count()


def test_visitor_windows(spark, pages, tmp_path_factory):
    columns = ("stt", "vc", "ch", "ar", "is_new", "pv_ct", "sv_ct", "dur_sum", "ts")
    got = feed(spark, pages, tmp_path_factory,
               lambda s: stats.visitor_stats(events.page_views(s), "1 hour"))
    want = stats.visitor_stats(events.page_views(pages), "1 hour")
    assert ids(got, *columns) == ids(want, *columns)


def test_order_sketches_take_state_partitions_by_the_size_of_their_input(spark, sf_dir, monkeypatch):
    from rtdw.plans import stream_queries
    from rtdw.streaming import run

    dealt = []

    def spy(spark, stream, purpose, partitions=None):
        bounded = spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage")
        dealt.append((purpose, partitions, bounded))
        return run.run_to_table(spark, stream, purpose, partitions)

    monkeypatch.setattr(run, "PARTITION_BYTES", 1 << 14)
    monkeypatch.setattr(stream_queries, "run_to_table", spy)
    rows = stream_queries.stream_order_sketches(spark, sf_dir).collect()
    assert dealt == [("order-sketches", 8, "true")]
    assert rows and all(r["near"] and r["bounded"] for r in rows)


@pytest.mark.parametrize("name", ["stream_payment_wide", "stream_product_stats"])
def test_runs_by_shares_take_disk_for_one_share_and_return_the_same(spark, sf_dir, monkeypatch, name):
    from rtdw.plans import stream_queries
    from rtdw.streaming import run

    runs = []

    def spy(spark, stream, purpose, partitions=None):
        open_runs = [x for x in os.listdir(f"{shared_dir(spark)}/rtdw") if "-checkpoint-" in x and x not in before]
        folder = run.run_to_folder(spark, stream, purpose, partitions)
        runs.append((purpose, len(open_runs), folder))
        return folder

    query = getattr(stream_queries, name)
    want = Counter(tuple(r) for r in query(spark, sf_dir).collect())
    before = set(os.listdir(f"{shared_dir(spark)}/rtdw"))
    monkeypatch.setattr(stream_queries, "run_to_folder", spy)
    monkeypatch.setattr(run, "RUN_BYTES", 1 << 16)
    got = query(spark, sf_dir)
    purposes = Counter(purpose for purpose, _, _ in runs)
    assert purposes["order-wide"] == purposes["payment"] == 3 and len(runs) == (6 if name == "stream_payment_wide" else 9)
    assert not any(kept for _, kept, _ in runs)
    gone = {purpose for purpose, _, folder in runs if not os.path.exists(folder)}
    assert gone == ({"order-wide"} if name == "stream_payment_wide" else {"order-wide", "payment"})
    assert Counter(tuple(r) for r in got.collect()) == want and want


def test_scratch_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))

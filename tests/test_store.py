"""The dimension store, snapshots as streams, days of a zone, and bounded bounce state."""

import glob
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from rtdw.operators import stats
from rtdw.operators import visits as stored_visits
from rtdw.session import fresh_dir, session_settings
from rtdw.sinks.dims import DimensionStore, create_tables
from rtdw.sources.changes import stream_snapshot_then_changes
from rtdw.streaming import jobs, run, visits
from rtdw.streaming.keyed import EntryTimeout
from rtdw.streaming.run import run_to_table, start_table


def batch(spark, rows):
    kind = "sink_table string, after map<string,string>, type string, seq bigint"
    return spark.createDataFrame([("T", {"id": i, "name": n}, "insert", s) for i, n, s in rows], kind)


def names(store):
    return {r["id"]: r["name"] for r in store.read("T", ["id", "name"]).collect()}


def test_only_finished_states_are_read(spark):
    store = DimensionStore(spark, fresh_dir(spark, "dims"))
    assert names(store) == {}
    store.append(batch(spark, [("1", "a", 1), ("2", "b", 2)]), 0)
    store.compact("T", ["id", "name"], 0)
    store.append(batch(spark, [("2", "c", 3)]), 1)
    half = f"{store.root}/base/T/upto=1"
    spark.createDataFrame([("1", "lost")], "id string, name string").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(half)
    assert names(store) == {"1": "a", "2": "c"}


def test_old_states_and_changes_go(spark):
    store = DimensionStore(spark, fresh_dir(spark, "dims"))
    for n in range(6):
        store.append(batch(spark, [(str(n), f"n{n}", n)]), n)
        if n % 2:
            store.compact("T", ["id", "name"], n)
            store.vacuum(["T"])
    assert sorted(store._finished("base/T", "upto")) == [3, 5]
    assert sorted(store._finished("changes", "batch")) == [4, 5]
    assert names(store) == {str(n): f"n{n}" for n in range(6)}


def test_tables_get_the_columns_of_all_rows(spark):
    kind = (
        "source_table string, operate_type string, sink_type string, sink_table string, "
        "sink_columns string, sink_pk string, sink_extend string"
    )
    rows = [("u", "insert", "hbase", "DIM_ALL", "id,name,level", "id", None),
            ("u", "update", "hbase", "DIM_ALL", "id,phone", "id", None),
            ("o", "insert", "kafka", "fact", "id", "id", None)]
    spark.sql("CREATE DATABASE IF NOT EXISTS united")
    create_tables(spark, spark.createDataFrame(rows, kind), "united")
    assert spark.table("united.DIM_ALL").columns == ["id", "level", "name", "phone"]


def test_snapshot_then_changes_as_a_stream(spark, tmp_path):
    line = '{"database":"shop","tableName":"%s","before":{},"after":{"id":"%d"},"type":"insert","seq":%d}'
    (tmp_path / "a.txt").write_text("\n".join([line % ("user_info", 7, 1), line % ("other", 8, 2)]))
    snapshot = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, name string")
    stream = stream_snapshot_then_changes(spark, snapshot, str(tmp_path), "shop", "user_info")
    got = run_to_table(spark, stream, "snapshot").collect()
    assert sorted((r["after"]["id"], r["type"]) for r in got) == [("1", "read"), ("2", "read"), ("7", "insert")]


def test_days_of_a_zone(spark):
    hour = 3_600_000
    rows = [("m", "p", 1_700_000_000_000 // (24 * hour) * 24 * hour + h * hour) for h in (-2, -1, 1, 7, 15, 17, 23, 25)]
    kind = "mid string, last string, ts long"
    for zone, days in (("UTC", 3), ("Asia/Shanghai", 2)):
        with session_settings(spark, {"spark.sql.session.timeZone": zone}):
            pages = spark.createDataFrame(rows, kind).select(
                F.struct("mid").alias("common"), F.struct(F.col("last").alias("last_page_id")).alias("page"), "ts"
            )
            path = fresh_dir(spark, "pages")
            pages.write.parquet(path)
            stored = stored_visits.unique_visits(pages).count()
            stream = visits.unique_visits(spark.readStream.schema(pages.schema).parquet(path)).select("ts")
            assert run_to_table(spark, stream, "days").count() == stored == days


class Handle:
    """A list state and timers in memory."""

    def __init__(self):
        self.rows, self.timers = [], []

    def getListState(self, name, schema):
        return self

    def appendList(self, rows):
        self.rows += rows

    def put(self, rows):
        self.rows = rows

    def get(self):
        return iter(self.rows)

    def clear(self):
        self.rows = []

    def registerTimer(self, at):
        self.timers.append(at)


class Times:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_bounce_state_is_bounded():
    handle, rule = Handle(), EntryTimeout(10_000)
    rule.init(handle)
    out, most = [], 0
    for n in range(1001):
        frame = pd.DataFrame({"ts": [n * 1000], "tie": [str(n)], "entry": [n == 0], "value": [f"v{n}"]})
        list(rule.handleInputRows(("m",), iter([frame]), Times(0)))
        watermark = n * 1000 - 2000
        while due := [t for t in handle.timers if t <= watermark]:
            handle.timers = [t for t in handle.timers if t > watermark]
            out += [f for _ in due[:1] for f in rule.handleExpiredTimer(("m",), Times(watermark), None)]
        most = max(most, len(handle.rows))
    assert not out and most <= 16 and handle.timers
    assert all(row[3] is None for row in handle.rows)


def test_lateness_grows_with_the_layers(spark):
    live, once = jobs.Warehouse(spark, "x"), jobs.Warehouse(spark, "x", every=None)
    assert jobs.chain_lateness(live, 2, 16) == "36 seconds"
    assert jobs.chain_lateness(once, 2, 16) == "16 seconds"
    assert jobs.chain_lateness(jobs.Warehouse(spark, "x", every="2 minutes"), 1, 6) == "246 seconds"


def test_late_orders_are_counted(spark):
    """An order of second 1 that comes a micro-batch after pages of second 14."""
    source, out, checkpoint = (fresh_dir(spark, n) for n in ("in", "out", "checkpoint"))
    kind = "ts long, sku_id long, order_id long, paid_order_id long, refund_order_id long, display_ct long"
    money = "0L as click_ct, 0L as favor_ct, 0L as cart_ct, 1L as order_sku_num, 5.0 as order_amount, 0.0 as payment_amount, 0.0 as refund_amount, 0L as comment_ct, 0L as good_comment_ct"
    base = 1_700_000_000_000
    lateness = jobs.chain_lateness(jobs.Warehouse(spark, "x"), 4, 6)
    for n, (second, order) in enumerate([(14, None), (1, 7), (10_000, None), (20_000, None)]):
        rows = spark.createDataFrame([(base + second * 1000, 1, order, None, None, 0)], kind).selectExpr("*", *money.split(", "))
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        start_table(stats.product_measures(stream, lateness=lateness), out, checkpoint, every=None).awaitTermination()
    got = {r["stt"]: r["order_ct"] for r in spark.read.parquet(out).collect()}
    assert sum(got.values()) == 1


def test_partitions_of_the_state_grow_with_the_input(spark, tmp_path):
    small, large = tmp_path / "small.parquet", tmp_path / "large"
    small.write_bytes(b"x")
    large.mkdir()
    (large / "part").write_bytes(bytes(10 * run.PARTITION_BYTES + 1))
    assert run.state_partitions(spark, str(small)) == 4
    assert run.state_partitions(spark, str(small), str(large)) == 11
    source = fresh_dir(spark, "source")
    spark.range(50).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source).dropDuplicates()
    assert run_to_table(spark, stream, "parts", partitions=7).count() == 50
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_shares_of_the_keys_hold_each_row_once(spark, tmp_path):
    rows = spark.sql("SELECT if(id % 5 = 0, null, id) AS key, id FROM range(500)")
    shares = [{r["id"] for r in run.in_share(rows, "key", n, 3).collect()} for n in range(3)]
    assert sorted(x for share in shares for x in share) == list(range(500)) and all(len(x) > 80 for x in shares)
    assert run.in_share(rows, "key", 0, 1).count() == 500
    (tmp_path / "part").write_bytes(b"x" * 10)
    assert run.run_shares(spark, str(tmp_path)) == 1 == run.run_shares(spark, str(tmp_path / "none"))


def test_runs_reserve_no_disk_for_their_state(spark):
    """Each store took 4 MB, however little it held."""
    base = os.environ.get("SPARK_LOCAL_DIRS") or tempfile.gettempdir()
    stores = lambda: set(glob.glob(f"{base}/spark-*/StateStoreId*"))
    source, before = fresh_dir(spark, "source"), stores()
    spark.range(50).write.parquet(source)
    run_to_table(spark, spark.readStream.schema("id long").parquet(source).dropDuplicates(), "few", partitions=8)
    files = [f"{d}/{x}" for top in stores() - before for d, _, names in os.walk(top) for x in names]
    assert sum(os.lstat(f).st_blocks * 512 for f in files) < 8 << 20

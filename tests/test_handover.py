"""Logs that grow and roll, and topics handed over batch by batch: each record once."""

import os

import pytest
from pyspark.sql import functions as F

from rtdw import schemas
from rtdw.operators import stats, visits
from rtdw.plans import standin
from rtdw.session import fresh_dir, session_settings
from rtdw.sources import growing, handover, topics
from rtdw.streaming import jobs, keyed
from rtdw.streaming.run import run_to_table, start_batches, start_table


@pytest.fixture()
def log(spark, tmp_path):
    folder = tmp_path / "log"
    (folder / "host1").mkdir(parents=True)

    def read(**options):
        stream = growing.read_growing(spark, str(folder), **options)
        start_table(stream, str(tmp_path / "out"), str(tmp_path / "check"), every=None).awaitTermination()
        out = spark.read.schema("value string").parquet(str(tmp_path / "out"))
        return sorted(r["value"] for r in out.collect())

    return folder / "host1", read


def test_appended_and_rolled_log(log):
    folder, read = log
    now, rolled = folder / "app.log", folder / "app.2024-01-01.log"
    now.write_text("a\nb\nhal")
    assert read() == ["a", "b"]
    with now.open("a") as file:
        file.write("f\n\nc\r\n")
    assert read() == ["", "a", "b", "c", "half"]
    with now.open("a") as file:
        file.write("é漢\nlast without an end")
    os.rename(now, rolled)
    now.write_text("n1\nn2\n")
    whole = ["", "a", "b", "c", "half", "last without an end", "n1", "n2", "é漢"]
    assert read() == whole
    assert read() == whole
    now.unlink()
    (folder / "other.log").write_text("o1\n")
    assert read() == sorted([*whole, "o1"])


def test_logs_that_begin_alike(log):
    folder, read = log
    (folder / "one.log").write_text("start\n1\n")
    (folder / "two.log").write_text("start\n2\n")
    with pytest.raises(Exception, match="headlines"):
        read()
    assert read(headlines=2) == ["1", "2", "start", "start"]


def test_parts_of_a_file(log, monkeypatch):
    folder, read = log
    lines = [f"{'x' * (i % 7)}{i}" for i in range(200)]
    (folder / "app.log").write_text("\n".join(lines) + "\n")
    monkeypatch.setattr(growing, "SLICE_BYTES", 5)
    assert read() == sorted(lines)


@pytest.mark.parametrize("end", ["", "\n"])
def test_every_cut_of_lines(tmp_path, end):
    import pyarrow.fs

    from rtdw.sources import lines as own

    path = tmp_path / "x"
    path.write_bytes(("ab\n\ncd é\nxyz" + end).encode())
    size = path.stat().st_size
    store, name = own.opened_store(f"file:{path}")
    assert isinstance(store, pyarrow.fs.LocalFileSystem)
    for step in range(1, size + 1):
        got = []
        for begin, stop in own.slices(0, size, step):
            with store.open_input_file(name) as file:
                for batch in own.read_lines(file, begin, stop, 0, size):
                    got += batch.column("value").to_pylist()
        assert got == ["ab", "", "cd é", "xyz"], step


def test_log_job_on_a_growing_log(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path), every=None, growing_logs=True)
    folder = tmp_path / jobs.APP_LOG
    folder.mkdir()
    line = '{"common":{"mid":"m%d","is_new":"0"},"page":{"page_id":"home"},"ts":%d}\n'
    (folder / "app.log").write_text(line % (1, 1) + (line % (2, 2))[:9])
    jobs.start_log_split(w).awaitTermination()
    with (folder / "app.log").open("a") as file:
        file.write((line % (2, 2))[9:])
    os.rename(folder / "app.log", folder / "app.2024-01-01.log")
    (folder / "app.log").write_text(line % (3, 3))
    jobs.start_log_split(w).awaitTermination()
    out = spark.read.schema("value string, topic string").text(w.path(jobs.LOGS))
    mids = out.selectExpr("get_json_object(value, '$.common.mid') as mid", "topic").collect()
    assert sorted(map(tuple, mids)) == [(f"m{i}", "dwd_page_log") for i in (1, 2, 3)]


def test_batches_are_read_once(spark, tmp_path):
    path = str(tmp_path / "topic")
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "value string, topic string")

    def read(topic):
        stream = handover.read_delivered(spark, path, topic)
        start_table(stream, f"{tmp_path}/{topic}", f"{tmp_path}/check-{topic}", every=None).awaitTermination()
        return sorted(r["value"] for r in spark.read.schema("value string").parquet(f"{tmp_path}/{topic}").collect())

    assert read("x") == []  # before anything is written
    rows.write.partitionBy("topic").text(f"{path}/batch=0/attempt=failed")
    assert read("x") == []
    assert handover.deliver_batch(rows, path, 0)
    assert read("x") == ["a", "b"]
    assert not handover.deliver_batch(rows, path, 0)  # repeated after it was published
    assert handover.deliver_batch(rows.where("false"), path, 1)
    assert handover.deliver_batch(rows, path, 2)
    assert read("x") == ["a", "a", "b", "b"] and read("y") == ["c", "c"]
    assert sorted(r["value"] for r in handover.delivered(spark, path).collect()) == ["a", "a", "b", "b", "c", "c"]
    assert spark.read.text(path).count() == 6, "failed attempts are gone"


@pytest.mark.parametrize("fail", ["before", "after"])
def test_job_that_fails_within_a_batch(spark, tmp_path, fail):
    """Order wide fails once around its delivery; its reader has run meanwhile."""
    path = f"{tmp_path}/{jobs.ORDER_WIDE}"
    columns = "province_id, province_name, province_area_code, province_iso_code, province_3166_2_code".split(", ")
    orders = spark.createDataFrame(
        [(i, 1, "p", "a", "b", "c", "10.00", f"2024-01-01 00:00:0{i}") for i in range(4)]
        + [(99, 1, "p", "a", "b", "c", "1.00", "2030-01-01 00:00:00")],
        ["order_id", *columns, "split_total_amount", "create_time"],
    )
    source, broken = fresh_dir(spark, "orders"), {"now": True}
    orders.write.parquet(source)

    def process(batch, batch_id):
        rows = batch.select(F.to_json(F.struct("*")).alias("value"))
        if fail == "before" and broken["now"]:
            rows.write.text(f"{path}/batch={batch_id}/attempt=broken")
            raise OSError("lost")
        handover.deliver_batch(rows, path, batch_id)
        if broken["now"]:
            raise OSError("lost")

    def write():
        stream = spark.readStream.schema(orders.schema).parquet(source)
        start_batches(stream, process, f"{tmp_path}/check", every=None).awaitTermination()

    def province():
        wide = topics.records(handover.read_delivered(spark, path), schemas.ORDER_WIDE)
        start_table(
            stats.province_stats(wide, "1 day"), f"{tmp_path}/stats", f"{tmp_path}/check-stats", every=None
        ).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        write()
    province()
    broken["now"] = False
    write()
    province()
    out = spark.read.schema(schemas.PROVINCE_STATS).parquet(f"{tmp_path}/stats").where("stt < '2025'").collect()
    assert [(r["order_count"], float(r["order_amount"])) for r in out] == [(4, 40.0)]


def test_bounces_of_a_hot_device(spark, sf_dir):
    """Half of all rows are one device's; the state is kept by time slice."""
    pages = standin.page_log(standin.table(spark, sf_dir, "events")).selectExpr(
        "event_id", "named_struct('mid', if(event_id % 2 = 0, 'hot', common.mid)) as common", "page", "ts"
    )
    pages = pages.unionByName(pages.limit(3).selectExpr("-event_id as event_id", "common", "page", "cast(null as bigint) as ts"))
    source = fresh_dir(spark, "pages")
    pages.selectExpr(
        "common.mid as mid", "ts", "page.last_page_id is null as entry",
        "lpad(event_id, 20, '0') as tie", "cast(event_id as string) as value",
    ).unionByName(spark.createDataFrame(
        [("far", 4_000_000_000_000, True, "", "far")], "mid string, ts long, entry boolean, tie string, value string"
    )).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    timeout = "2 hours"
    with session_settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        got = run_to_table(spark, keyed.bounces(stream, timeout, slice_length="5 hours"), "hot")
    want = visits.bounces(pages, tiebreak=("event_id",), timeout=timeout)
    assert sorted(int(r["value"]) for r in got.collect()) == sorted(r["event_id"] for r in want.collect())
    assert got.where("mid = 'hot'").count() > 20
    plan = keyed.bounces(stream, timeout)._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and "slice" in plan


def test_lateness_of_any_interval(spark):
    def lateness(every):
        return jobs.chain_lateness(jobs.Warehouse(spark, "x", every=every), 2, 16)

    assert lateness(None) == "16 seconds"
    assert lateness("500 milliseconds") == "18 seconds"
    assert lateness("125 milliseconds") == "16500 milliseconds"
    assert lateness("1 minute") == "256 seconds"
    assert lateness("1 day") == f"{16 + 4 * 86_400} seconds"

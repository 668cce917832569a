"""Changelog, config as state, sums by day, sliced stream joins."""

import contextlib
import io
from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from rtdw.operators import routing
from rtdw.operators.joins import interval_join
from rtdw.schemas import CHANGE
from rtdw.session import fresh_dir, session_settings
from rtdw.sinks import olap
from rtdw.streaming import changelog, config, jobs
from rtdw.streaming.run import start_table


def change(table, kind, seq, row, key="1"):
    image = {"id": key, **row}
    gone = kind == "delete"
    return ("shop", table, image if gone else {}, {} if gone else image, kind, seq)


def steps(spark, tmp_path, run, batches):
    """Give a stream the batches one after another, with a restart for each; all that comes out."""
    source, out = fresh_dir(spark, "steps"), str(tmp_path / "out")
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(source)
        stream = run(spark.readStream.schema(CHANGE).parquet(source))
        start_table(stream, out, str(tmp_path / "check"), every=None).awaitTermination()
        seen.append(spark.read.schema(stream.schema).parquet(out).collect())
    return seen


def test_changelog(spark, tmp_path):
    got = steps(spark, tmp_path, changelog.changelog, [
        [change("u", "insert", 5, {"a": "5"}), change("u", "update", 7, {"a": "7"}), change("u", "delete", 3, {}, "2")],
        [change("u", "update", 6, {"a": "6"}), change("u", "update", 7, {"a": "7"}), change("u", "insert", 2, {"a": "x"}, "2")],
        [change("u", "delete", 9, {"a": "7"}), change("u", "insert", 4, {"a": "y"}, "2")],
    ])
    rows = [sorted((r["kind"], r["key"], r["seq"], r["after"].get("a")) for r in part) for part in got]
    first = [("+I", "1", 5, "5"), ("+U", "1", 7, "7"), ("-U", "1", 7, "5")]
    assert rows[0] == first and rows[1] == first, "late and repeated changes give nothing"
    assert rows[2] == sorted([*first, ("-D", "1", 9, "7"), ("+I", "2", 4, "y")])
    live = changelog.fold_changelog(spark.read.schema(
        "kind string, tableName string, key string, seq bigint, after map<string,string>"
    ).parquet(str(tmp_path / "out"))).collect()
    assert [(r["key"], r["after"]) for r in live] == [("2", {"id": "2", "a": "y"})]


def setting(table, kind, sink, columns, seq):
    return ("shop", "table_process", {}, {
        "source_table": table, "operate_type": kind, "sink_type": sink, "sink_table": f"to_{table}",
        "sink_columns": columns, "sink_pk": "id",
    }, "insert", seq)


def test_records_before_their_config(spark, tmp_path):
    def run(stream):
        of_config = F.col("tableName") == "table_process"
        return config.route_with_state(stream.where(~of_config), stream.where(of_config), parts=3)

    got = steps(spark, tmp_path, run, [
        [change("o", "insert", i, {"a": str(i), "b": "x"}) for i in range(6)] + [change("p", "insert", 1, {"a": "p"})],
        [setting("o", "insert", "kafka", "id,a", 1), setting("p", "insert", "file", "id", 1)],
        [change("o", "insert", 6, {"a": "6"}), change("o", "update", 7, {"a": "7"}), change("p", "insert", 2, {"a": "q"})],
        [setting("o", "insert", "kafka", "id,a", 1), setting("o", "insert", "hbase", "id", 3),
         change("o", "insert", 8, {"a": "8"})],
    ])
    rows = [sorted((r["tableName"], r["seq"], r["sink_type"], r["after"].get("a"), len(r["after"])) for r in part) for part in got]
    early = [("o", i, "kafka", str(i), 2) for i in range(6)]
    assert rows[0] == [] and rows[1] == early
    assert rows[2] == [*early, ("o", 6, "kafka", "6", 2)]
    assert rows[3] == [*rows[2], ("o", 8, "hbase", None, 1)]
    assert {r["sink_table"] for r in got[3]} == {"to_o"}
    columns = routing.route(spark.createDataFrame([], CHANGE), routing.latest_config(
        routing.config_rows(spark.createDataFrame([], CHANGE)))).columns
    assert sorted(columns) == sorted(got[3][0].asDict())


class State:
    """A value and a list of the state, in memory; keeps how many rows each call handed over."""

    def __init__(self):
        self.value, self.rows, self.sizes = None, [], []

    def getValueState(self, name, schema):
        return State()

    def getListState(self, name, schema, ttlDurationMs=None):
        return State()

    def exists(self):
        return self.value is not None or bool(self.rows)

    def get(self):
        return self.value if self.value is not None else iter(self.rows)

    def update(self, value):
        self.value = value

    def appendList(self, rows):
        self.sizes.append(len(rows))
        self.rows += rows

    def clear(self):
        self.rows = []


def test_early_records_are_not_held_in_memory():
    """Neither on arrival nor when the config is there; a config in the last batch counts for all."""
    rule, names = config.Routing(None), ("sink_type", "sink_table", "sink_columns", "sink_pk")
    rule.init(State())
    empty = dict.fromkeys(names)
    number = 50

    def batches(settings):
        for n in range(number):
            yield pd.DataFrame({"is_config": False, "seq": range(n * 1000, n * 1000 + 1000), "database": "d",
                                "after": "{}", **empty})
        for seq in settings:
            yield pd.DataFrame([{"is_config": True, "seq": seq, "database": None, "after": None,
                                 **dict.fromkeys(names, f"c{seq}"), "sink_type": "kafka"}])

    assert not list(rule.handleInputRows(("t", "insert"), batches([]), None))
    assert len(rule.waiting.rows) == number * 1000 and max(rule.waiting.sizes) <= 1000
    out = list(rule.handleInputRows(("t", "insert"), batches([2, 1]), None))
    assert max(len(x) for x in out) <= config.HELD and not rule.waiting.rows
    rows = pd.concat(out)
    assert sorted(rows["seq"]) == sorted([*range(number * 1000)] * 2) and set(rows["sink_table"]) == {"c2"}


def test_gmv_reads_one_day(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path))
    path = w.path(jobs.GMV_BY_DAY)
    for batch in (0, 1, 1):  # the last one is repeated
        rows = [(20240101, 10 + batch), (20240102, 5)]
        df = spark.createDataFrame(rows, "day int, gmv int").withColumn("gmv", F.col("gmv").cast("decimal(26,2)"))
        olap.write_by_day(df, path, batch)
    got = jobs.gmv(w, date(2024, 1, 1))
    assert got.first()[0] == 21 and jobs.gmv(w, date(2030, 1, 1)).first()[0] is None
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain("formatted")
    line = next(x for x in out.getvalue().splitlines() if "PartitionFilters" in x)
    assert "day" in line and "20240101" in line
    read = olap.read_by_day(spark, path, "gmv decimal(26,2)").where("day = 20240101")
    files = {r[0] for r in read.select(F.input_file_name()).collect()}
    assert files and all("day=20240101" in f for f in files)


def test_stream_join_of_a_hot_key(spark, tmp_path):
    """The slice is part of the key, and the state is cleared as the watermark moves on."""
    source = fresh_dir(spark, "join")
    schema = "key string, id long, at timestamp"
    stored = spark.range(400).selectExpr("'hot' as key", "id", "timestamp_seconds(1700000000 + id * 7) as at")
    far = spark.sql("SELECT 'far' as key, -1L as id, timestamp'2030-01-01' as at")

    def joined(left, right):
        pairs = interval_join(left, right, "key", "key", "at", "at", "-20 seconds", "10 seconds", "60 seconds")
        return pairs.selectExpr("l.id as l", "r.id as r")

    with session_settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        for rows in (stored, far):
            rows.coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(schema).parquet(source)
            left, right = (stream.withWatermark("at", "2 seconds") for _ in range(2))
            query = start_table(joined(left, right), str(tmp_path / "out"), str(tmp_path / "check"), every=None)
            query.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.schema("l long, r long").parquet(str(tmp_path / "out")).collect())
    want = sorted(tuple(r) for r in joined(stored, stored).collect())
    assert got[0] == (-1, -1) and got[1:] == want and len(want) > 400
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] <= 8, "only the last row's slices are left"
    text = joined(left, right)._jdf.queryExecution().analyzed().toString()
    assert "__slice" in text

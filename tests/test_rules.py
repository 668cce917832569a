"""Each rule at its boundaries, on a few rows."""

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rtdw import schemas
from rtdw.functions import codes, names, text, times
from rtdw.operators import cdc, events, joins, logs, parse, routing, stats, visits, wide


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


# Parsing and splitting


def test_dirty_is_anything_but_one_object(spark):
    good = ['{"common":{"mid":"m"}}', "{}", ' {"a": [1, {"b": null}]} ']
    bad = ["{bad", '"text"', "[1]", "[{}]", "null", "7", "", '{"a":1} tail', '{"a":1}{"a":2}',
           '{"a":1},{"a":2}']
    clean, dirty = parse.split_dirty(lines(spark, *good, *bad))
    assert values(clean, "value") == sorted((t,) for t in good)
    assert values(dirty, "value") == sorted((t,) for t in bad)


def test_record_without_device_is_dirty(spark):
    log = logs.read_log(lines(spark, '{"common":{"mid":"m"}}', '{"common":{}}', '{"ts":1}'))
    assert [r["dirty"] for r in log.orderBy("value").collect()] == [False, True, True]


def test_log_split(spark):
    start = '{"common":{"mid":"m"},"start":{"entry":"icon","t":[1,2]},"displays":[{"item":"9"}],"ts":1}'
    shown = (
        '{"common":{"mid":"m"},"page":{"page_id":"home"},'
        '"displays":[{"item":"3","item_type":"sku_id"},{"item":"4","page_id":"x"}],"ts":2}'
    )
    empty = '{"common":{"mid":"m"},"page":{"page_id":"home"},"displays":[],"start":null,"ts":3}'
    rows = logs.split_topics(logs.read_log(lines(spark, start, shown, empty, "{broken")))
    got = {}
    for topic, value in values(rows, "topic", "value"):
        got.setdefault(topic, []).append(value)
    assert [json.loads(v) for v in got[logs.START_TOPIC]] == [{"entry": "icon", "t": [1, 2]}]
    assert sorted(got[logs.PAGE_TOPIC]) == sorted([shown, empty])
    assert sorted(json.dumps(json.loads(v), sort_keys=True) for v in got[logs.DISPLAY_TOPIC]) == [
        '{"item": "3", "item_type": "sku_id", "page_id": "home"}',
        '{"item": "4", "page_id": "home"}',
    ]
    assert got[logs.DIRTY_TOPIC] == ["{broken"]


def test_flag_is_changed_in_the_text_only_where_it_is_a_key(spark):
    line = '{"common":{"mid":"m","is_new":"1"},"page":{"item":"say \\"is_new\\":\\"1\\""},"x":[1.50]}'
    out = lines(spark, line).select(logs.with_flag(F.col("value"), F.lit("0"))).first()[0]
    assert out == line.replace('"is_new":"1"', '"is_new":"0"', 1)
    kept = lines(spark, line).select(logs.with_flag(F.col("value"), F.lit("1"))).first()[0]
    assert kept == line


def test_flag_of_common_only_and_as_a_number(spark):
    cases = {
        '{"page":{"is_new":"1"},"common":{"mid":"m","is_new": 1}}':
            '{"page":{"is_new":"1"},"common":{"mid":"m","is_new": "0"}}',
        '{"common":{"is_new":"1"},"page":{"is_new":"1"}}': '{"common":{"is_new":"0"},"page":{"is_new":"1"}}',
        '{"common":{"is_new":10}}': '{"common":{"is_new":10}}',
        '{"common":{"mid":"m"},"page":{"is_new":1}}': '{"common":{"mid":"m"},"page":{"is_new":1}}',
    }
    for line, want in cases.items():
        assert lines(spark, line).select(logs.with_flag(F.col("value"), F.lit("0"))).first()[0] == want


def test_one_flag_stays_for_missing_times_and_equal_lines(spark):
    rows = [("a", None, "x"), ("a", 5, "y"), ("b", 3, "z"), ("b", 3, "z"), ("b", 3, "z"), ("c", None, "q"), ("c", None, "q")]
    df = spark.createDataFrame([(*r, "1") for r in rows], "mid string, ts long, line_id string, is_new string")
    fixed = logs.fix_new_visitor(df, order=("ts", "line_id")).collect()
    kept = sorted((r["mid"], r["ts"] is None) for r in fixed if r["is_new"] == "1")
    assert len(fixed) == len(rows) and kept == [("a", True), ("b", False), ("c", True)]


def test_new_visitor(spark):
    rows = [("m1", f, i) for i, f in enumerate("1101")] + [("m2", f, i) for i, f in enumerate("011")]
    df = spark.createDataFrame(rows, "mid string, is_new string, ts bigint")
    fixed = logs.fix_new_visitor(df, order=("ts",))
    got = {m: "".join(r[2] for r in values(fixed, "mid", "ts", "is_new") if r[0] == m)
           for m in ("m1", "m2")}
    assert got == {"m1": "1000", "m2": "010"}


# Visits


def pages(spark, rows):
    """rows: (mid, ts, last_page_id, id)"""
    return spark.createDataFrame(
        [((m,), (last,), ts, i) for m, ts, last, i in rows],
        "common struct<mid string>, page struct<last_page_id string>, ts bigint, id int",
    )


def test_unique_visit(spark):
    day = times.duration_ms("1 day")
    df = pages(spark, [("m", 1, None, 0), ("m", 2, "A", 1), ("m", 3, "B", 2), ("m", day + 5, "A", 3)])
    assert values(visits.unique_visits(df), "id") == [(1,), (3,)]
    assert values(visits.unique_visits(df, visits="entry"), "id") == [(0,)]
    assert values(visits.unique_visits(df, visits="all"), "id") == [(0,), (3,)]


@pytest.mark.parametrize(
    "rows, bounced",
    [
        ([(0, None), (9_999, None)], [0, 1]),
        ([(0, None), (9_999, "A")], []),
        ([(0, None), (10_000, "A")], [0]),
        ([(0, None), (1_000, None), (2_000, None), (3_000, "A")], [0, 1]),
        ([(0, "A"), (5_000, None)], [1]),
    ],
)
@pytest.mark.parametrize("start", [0, 295_000, 290_001, 299_999, 300_000])
def test_bounce(spark, rows, bounced, start):
    """The start shifts the case over the edge of a time slice."""
    df = pages(spark, [("m", start + ts, last, i) for i, (ts, last) in enumerate(rows)])
    assert values(visits.bounces(df), "id") == [(i,) for i in bounced]


# Joins


def order(spark, *rows):
    return spark.createDataFrame(rows, "id bigint, create_time string").select(
        *[
            F.col(f.name) if f.name in ("id", "create_time") else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.ORDER_INFO
        ]
    )


def detail(spark, *rows):
    return spark.createDataFrame(rows, "id bigint, order_id bigint, create_time string").select(
        *[
            F.col(f.name)
            if f.name in ("id", "order_id", "create_time")
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.ORDER_DETAIL
        ]
    )


def test_order_interval(spark):
    orders = order(spark, (1, "2024-01-01 00:00:10"), (2, "2024-01-01 00:00:10"))
    details = detail(
        spark,
        (1, 1, "2024-01-01 00:00:08"),
        (2, 1, "2024-01-01 00:00:12"),
        (3, 1, "2024-01-01 00:00:07"),
        (4, 1, "2024-01-01 00:00:13"),
    )
    got = wide.order_wide(orders, details)
    assert got.columns == schemas.ORDER_WIDE.fieldNames()
    assert values(got, "detail_id", "order_id", "create_date", "create_hour") == [
        (1, 1, "2024-01-01", "00"), (2, 1, "2024-01-01", "00")]


def test_interval_join_slices_do_not_lose_or_double_rows(spark):
    left = spark.range(0, 400).selectExpr("id % 3 as k", "timestamp_millis(id * 700) as t", "id as a")
    right = spark.range(0, 400).selectExpr("id % 3 as k", "timestamp_millis(id * 900) as t", "id as b")
    for length in ("1 second", "5 seconds", "1 hour", None):
        joined = joins.interval_join(
            left, right, "k", "k", "t", "t", "-3 seconds", "2 seconds", length
        )
        want = sorted(
            (a, b)
            for a in range(400)
            for b in range(400)
            if a % 3 == b % 3 and -3000 <= b * 900 - a * 700 <= 2000
        )
        assert values(joined, "l.a", "r.b") == want


def test_payment_interval_and_merge(spark):
    paid_at = "2024-01-01 01:00:00"
    made = {1: "2024-01-01 00:45:00", 2: paid_at, 3: "2024-01-01 00:44:59", 4: "2024-01-01 01:00:01"}
    payments = spark.createDataFrame(
        [(i + 10, i, 7, Decimal("5.00"), "s", "1101", paid_at, None) for i in made],
        schemas.PAYMENT_INFO,
    )
    orders = wide.as_record(
        spark.createDataFrame(list(made.items()), "oid bigint, made string"),
        schemas.ORDER_WIDE,
        {"order_id": "oid", "user_id": "99", "total_amount": "8.00", "create_time": "made"},
    )
    got = wide.payment_wide(payments, orders)
    assert got.columns == schemas.PAYMENT_WIDE.fieldNames()
    assert values(
        got, "order_id", "payment_id", "user_id", "total_amount", "payment_create_time",
        "order_create_time",
    ) == [
        (1, 11, 7, Decimal("5.00"), paid_at, made[1]),
        (2, 12, 7, Decimal("5.00"), paid_at, paid_at),
    ]


def test_enrich(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "fk bigint, name string")
    dim = spark.createDataFrame([("1", "one")], "id string, title string")
    inner = joins.enrich(facts, dim, "fk", {"title": "title"})
    assert values(inner, "fk", "name", "title") == [(1, "x", "one")]
    left = joins.enrich(facts, dim, "fk", {"name": "title"}, how="left")
    assert left.columns == ["fk", "name"]
    assert sorted(left.collect(), key=str) == [(1, "one"), (2, None), (None, None)]


def test_lookup_gives_each_row_once(spark):
    dim = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, t string")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k bigint")
    assert values(joins.lookup(dim, keys, "k"), "id", "t") == [("1", "a")]


def test_merge_wide(spark):
    this = spark.createDataFrame([(1, None, "a", None)], "detail_id bigint, user_id bigint, sku_name string, split_total_amount double")
    other = spark.createDataFrame([(1, 5, "b", 2.0)], this.schema)
    assert values(wide.merge_wide(this, other), "*") == [(1, 5, "a", None)]


# Statistics


def ts_text(seconds):
    return f"2024-01-01 00:00:{seconds:02d}"


def product(spark, **streams):
    empty_page = spark.createDataFrame([], schemas.PAGE_LOG)
    typed = {
        "favor_info": schemas.FAVOR_INFO, "order_wide": schemas.ORDER_WIDE,
        "payment_wide": schemas.PAYMENT_WIDE, "refund_info": schemas.REFUND_INFO,
        "cart_info": schemas.CART_INFO, "comment_info": schemas.COMMENT_INFO,
    }
    given = {n: streams.get(n, spark.createDataFrame([], s)) for n, s in typed.items()}
    return events.product_events(streams.get("pages", empty_page), **given)


def test_one_order_with_two_details_counts_once(spark):
    details = wide.as_record(
        spark.createDataFrame([(2,), (3,)], "n bigint"),
        schemas.ORDER_WIDE,
        {"order_id": "1", "sku_id": "7", "sku_num": "n", "split_total_amount": "10.40",
         "create_time": f"'{ts_text(3)}'"},
    )
    got = stats.product_measures(product(spark, order_wide=details))
    assert values(got, "sku_id", "order_ct", "order_sku_num", "order_amount", "paid_order_ct") == [
        (7, 1, 5, Decimal("20.80"), 0)]


def test_only_a_click(spark):
    page = spark.createDataFrame(
        [(("m", "1", "v", "c", "a"), ("good_detail", None, "7", "sku_id", 5),
          [("7", "sku_id"), ("8", "activity_id")], 1_000)],
        schemas.PAGE_LOG,
    )
    row = stats.product_measures(product(spark, pages=page)).first().asDict()
    assert (row.pop("sku_id"), row.pop("click_ct"), row.pop("display_ct")) == (7, 1, 1)
    assert (row.pop("stt"), row.pop("edt"), row.pop("ts")) == (
        "1970-01-01 00:00:00", "1970-01-01 00:00:10", 1_000)
    assert all(v == 0 for v in row.values()), row


def test_comments_and_refunds(spark):
    comments = spark.createDataFrame(
        [(7, "1201", ts_text(1)), (7, "1203", ts_text(2)), (7, None, ts_text(3))],
        schemas.COMMENT_INFO,
    )
    refunds = spark.createDataFrame(
        [(1, 7, Decimal("1.50"), ts_text(1)), (1, 7, Decimal("1.50"), ts_text(2)),
         (2, 7, None, ts_text(3))],
        schemas.REFUND_INFO,
    )
    got = stats.product_measures(product(spark, comment_info=comments, refund_info=refunds))
    assert values(got, "comment_ct", "good_comment_ct", "refund_order_ct", "refund_amount") == [
        (3, 1, 2, Decimal("3.00"))]


def test_windows_are_half_open(spark):
    rows = [(("m", "1", "v", "c", "a"), ("p", None, None, None, d), None, ts)
            for ts, d in ((9_999, 1), (10_000, None), (19_999, 2))]
    unified = events.page_views(spark.createDataFrame(rows, schemas.PAGE_LOG))
    got = stats.visitor_stats(unified)
    assert got.columns == schemas.VISITOR_STATS.fieldNames()
    assert values(got, "stt", "pv_ct", "sv_ct", "dur_sum", "ts") == [
        ("1970-01-01 00:00:00", 1, 1, 1, 9_999), ("1970-01-01 00:00:10", 2, 2, 2, 10_000)]


def test_province_counts_distinct_orders(spark):
    rows = wide.as_record(
        spark.createDataFrame([(1, "10.40"), (1, "10.40"), (2, "0.20")], "o bigint, a string"),
        schemas.ORDER_WIDE,
        {"order_id": "o", "province_id": "3", "split_total_amount": "a",
         "create_time": f"'{ts_text(9)}'"},
    )
    got = stats.province_stats(rows)
    assert got.columns == schemas.PROVINCE_STATS.fieldNames()
    assert values(got, "stt", "province_id", "order_amount", "order_count") == [
        ("2024-01-01 00:00:00", 3, Decimal("21.00"), 2)]
    single = wide.province_row(rows)
    assert single.columns == schemas.PROVINCE_STATS.fieldNames()[2:9]
    assert {r["order_count"] for r in single.collect()} == {1}


def test_distinct_orders_exact_and_approximate(spark):
    rows = events.product_event(
        spark.range(0, 60).selectExpr("id % 2 as s", "id % 10 as o"),
        sku_id="s", order_id="o", ts="0")
    exact = stats.distinct_orders(rows, "sku_id", "order_id", "10 seconds")
    near = stats.distinct_orders(rows, "sku_id", "order_id", "10 seconds", approximate=0.01)
    assert values(exact, "sku_id", "order_ct") == values(near, "sku_id", "order_ct") == [(0, 5), (1, 5)]


def test_keywords(spark):
    rows = [({"item_type": "keyword", "item": item}, 1_000) for item in ("Red red-Shoe 42", None, "", "--")]
    rows.append(({"item_type": "sku_id", "item": "red"}, 1_000))
    df = spark.createDataFrame(rows, "page map<string,string>, ts bigint").withColumn(
        "rt", times.millis_to_second("ts"))
    got = stats.keyword_stats(df)
    assert got.columns == schemas.KEYWORD_STATS.fieldNames()
    assert values(got, "keyword", "ct", "source") == [
        ("42", 1, "search"), ("red", 2, "search"), ("shoe", 1, "search")]


def test_words_in_han_text(spark):
    df = spark.createDataFrame([("苹果手机 Pro,红 a",), ("Été 7x",), (None,)], "t string")
    got = [r[0] for r in df.select(text.words("t")).collect()]
    assert got == [["苹果", "果手", "手机", "pro", "红", "a"], ["été", "7x"], None]
    text.register_split_function(spark)
    lateral = spark.sql("SELECT w.word FROM {t}, LATERAL split_words(t) AS w", t=df)
    assert sorted(r[0] for r in lateral.collect()) == sorted(got[0] + got[1])


def test_gmv(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", Decimal("1.10")), ("2024-01-01 23:59:50", Decimal("2.20")),
         ("2024-01-02 00:00:00", Decimal("4.00"))],
        "stt string, order_amount decimal(26,2)",
    )
    assert stats.gmv(df, date(2024, 1, 1)).first()[0] == Decimal("3.30")
    assert stats.gmv(df).first()[0] is None
    assert values(stats.gmv_by_day(df), "day", "gmv") == [
        (20240101, Decimal("3.30")), (20240102, Decimal("4.00"))]


# Change records


def change(table, kind, after=None, before=None, seq=0):
    return ("shop", table, before or {}, after or {}, kind, seq)


def test_normalise(spark):
    raw = spark.createDataFrame(
        [("srv.shop.user_info", "c", None, {"id": "1"}, 1), ("srv.shop.user_info", "CREATE", None, {"id": "2"}, 2),
         ("srv.shop.user_info", "d", {"id": "1"}, None, 3), ("srv.shop.user_info", "READ", None, {"id": "3"}, 4),
         ("srv.shop.user_info", "r", None, {"id": "4"}, 5), ("srv.shop.user_info", "u", {"id": "2"}, {"id": "2"}, 6)],
        schemas.RAW_CHANGE,
    )
    got = cdc.normalise(raw).orderBy("seq").collect()
    assert [r["type"] for r in got] == ["insert", "insert", "delete", "read", "read", "update"]
    assert {(r["database"], r["tableName"]) for r in got} == {("shop", "user_info")}
    assert got[0]["before"] == {} and got[2]["after"] == {}


def test_deletes_are_dropped_and_missing_types_pass(spark):
    df = spark.createDataFrame(
        [change("t", k) for k in ("insert", "delete", None)], schemas.CHANGE)
    assert sorted(str(r["type"]) for r in cdc.drop_deletes(df).collect()) == ["None", "insert"]


def test_fold(spark):
    df = spark.createDataFrame(
        [change("t", "insert", {"id": "1", "n": "a"}, seq=1),
         change("t", "update", {"id": "1", "n": "b"}, {"id": "1", "n": "a"}, 2),
         change("t", "delete", None, {"id": "1"}, 3),
         change("t", "insert", {"id": "2", "n": "c"}, seq=4)],
        schemas.CHANGE,
    )
    row = schemas.struct("id bigint, n string")
    assert values(cdc.typed_rows(cdc.fold(df), row), "*") == [(2, "c")]
    snapshot = spark.createDataFrame([("1", "old"), ("5", "kept")], "id string, n string")
    both = cdc.snapshot_plus_changes(snapshot, df, "shop", "t")
    assert values(cdc.typed_rows(both, row), "*") == [(2, "c"), (5, "kept")]


def test_upsert_touches_named_columns_only(spark):
    stored = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, n string, m string")
    df = spark.createDataFrame(
        [change("t", "insert", {"id": "3", "n": "c", "m": "z"}, seq=1),
         change("t", "update", {"id": "3", "n": "d"}, seq=2),
         change("t", "update", {"id": "1", "n": None}, seq=3),
         change("t", "delete", None, {"id": "2"}, seq=4)],
        schemas.CHANGE,
    )
    got = {r["id"]: (r["n"], r["m"]) for r in cdc.upsert(stored, df).collect()}
    assert got == {"1": (None, "x"), "2": ("b", "y"), "3": ("d", "z")}


def config(spark, *rows):
    return spark.createDataFrame(rows, schemas.TABLE_PROCESS)


def test_routing(spark):
    cfg = config(
        spark,
        ("order_info", "insert", "kafka", "dwd_order_info", "id,name", "id", None),
        ("user_info", "insert", "hbase", "DIM_USER_INFO", "id", "id", None),
        ("log_info", "insert", "file", "x", "id", "id", None),
    )
    image = {"id": "1", "name": "n", "names": "no"}
    df = spark.createDataFrame(
        [change("order_info", "insert", image), change("user_info", "insert", image),
         change("log_info", "insert", image), change("other", "insert", image),
         change("order_info", "delete", None, image), change("order_info", None, image)],
        schemas.CHANGE,
    )
    routed = routing.route(cdc.drop_deletes(df), cfg)
    assert [(t, json.loads(v)) for t, v in values(routing.facts(routed), "topic", "value")] == [
        ("dwd_order_info", {"id": "1", "name": "n"})]
    assert [(r["sink_table"], r["after"]) for r in routing.dimensions(routed).collect()] == [
        ("DIM_USER_INFO", {"id": "1"})]


def test_config_keeps_newest_and_ignores_deletes(spark):
    row = {"source_table": "t", "operate_type": "insert", "sink_type": "kafka"}
    df = spark.createDataFrame(
        [change("table_process", "insert", {**row, "sink_table": "a"}, seq=1),
         change("table_process", "update", {**row, "sink_table": "b"}, seq=2),
         change("table_process", "delete", None, row, seq=3)],
        schemas.CHANGE,
    )
    assert values(routing.latest_config(routing.config_rows(df)), "sink_table") == [("b",)]


# Scalars


def test_age(spark):
    df = spark.createDataFrame(
        [("2023-01-02",), ("2023-01-01",), ("2022-01-01",), ("2024-06-01",), (None,)], "b string")
    got = [r[0] for r in df.select(times.age_years("b", "2024-01-01")).collect()]
    assert got == [0, 1, 2, 0, None]


def test_times(spark):
    row = spark.createDataFrame([(1_700_000_000_123,)], "ts bigint").select(
        times.millis_to_text("ts"), times.ts_to_text("timestamp_millis(ts)"),
        times.text_to_millis("'2023-11-14 22:13:20'"), times.day_number("timestamp_millis(ts)"),
        times.millis_to_day("ts"), F.date_format(times.millis_to_second("ts"), "ss.SSS"),
    ).first()
    assert tuple(row) == (
        "2023-11-14 22:13:20", "2023-11-14 22:13:20", 1_700_000_000_000, 20231114,
        date(2023, 11, 14), "20.000")
    assert times.duration_ms("-15 minutes") == -900_000
    with pytest.raises(ValueError):
        times.duration_ms("soon")


def test_names_and_codes(spark):
    df = spark.createDataFrame([("1002",), ("9",)], "order_status string")
    assert values(codes.with_label(df, "order_status", "order_status", "label"), "*")[0] == ("1002", "paid")
    assert names.camel_columns(df.withColumn("sku_id_x", F.lit(1))).columns == ["orderStatus", "skuIdX"]
    assert codes.code_table(spark).count() == sum(len(c) for c in codes.CODES.values())


def test_split_lines_are_parsed_once_for_all_their_fields(spark):
    from rtdw.plans.queries import line_fields, topic_counts

    lines = [
        '{"common":{"mid":"m","is_new":"1","vc":null,"x":"\\"q\\""},"page":{"page_id":"p","item":7,"during_time":1.50},'
        '"displays":[{"item":"1"},{"item":2},{}],"ts":5}',
        '{"common":{"mid":7,"is_new":1},"page":null,"displays":[],"ts":"5"}',
        '{"item":"3","item_type":"sku_id","page_id":"home"}', '{"entry":"icon"}', '{"displays":[{"item":"1"}]}',
        '{"page":{"item":{"a":[1, 2]}},"item":"x","common":[1]}', "[1]", "{}", "no record", "", None,
    ]
    rows = spark.createDataFrame([("dwd_page_log", x) for x in lines] + [("dirty_log", x) for x in lines], "topic string, value string")
    paths = {
        "mid": "$.common.mid", "is_new": "$.common.is_new", "vc": "$.common.vc", "ch": "$.common.ch", "ar": "$.common.ar",
        "last_page_id": "$.page.last_page_id", "during_time": "$.page.during_time", "ts": "$.ts", "entry": "$.entry",
        "displays": "$.displays[*].item",
    }
    value = F.when(F.col("topic") == "dwd_page_log", F.col("value"))
    field = lambda *path: F.coalesce(*(F.get_json_object(value, p) for p in path))
    both = [field(f"$.page.{c}", f"$.{c}").alias(c) for c in ("page_id", "item", "item_type")]
    md5 = F.when(F.col("topic") == "dirty_log", F.md5("value")).alias("line_md5")
    want = rows.select("topic", *(field(p).alias(c) for c, p in paths.items()), *both, md5)
    got = line_fields(rows)
    as_set = lambda df: sorted(map(repr, df.collect()))
    assert got.columns == want.columns and as_set(got) == as_set(want)
    counted = rows.select("topic", field("$.page.page_id", "$.page_id").alias("page_id"), field("$.common.is_new").alias("is_new"))
    counted = counted.groupBy("topic", "page_id", "is_new").agg(F.count("*").alias("n"))
    assert as_set(topic_counts(rows)) == as_set(counted)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("get_json_object(") == 1

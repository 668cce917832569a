"""All jobs in a row, from raw text to statistics."""

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from rtdw import schemas
from rtdw.operators import logs
from rtdw.sinks.dims import create_tables
from rtdw.streaming import jobs

T0 = 1_700_000_000_000  # 2023-11-14 22:13:20 UTC
FAR = T0 + 10 * 86_400_000


def write(root, name, part, rows):
    folder = root / name
    folder.mkdir(exist_ok=True)
    texts = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows]
    (folder / f"{part}.log").write_text("\n".join(texts) + "\n")


def page(ts, mid="m1", page_id="home", last=None, item=None, kind=None, new="1", displays=None):
    record = {
        "common": {"mid": mid, "is_new": new, "vc": "v2.1", "ch": "web", "ar": "110000", "os": "x"},
        "page": {"page_id": page_id, "last_page_id": last, "item": item, "item_type": kind,
                 "during_time": 100},
        "ts": ts,
    }
    if displays is not None:
        record["displays"] = displays
    return record


def clock(seconds):
    return f"2023-11-14 22:13:{20 + seconds:02d}"


def change(table, seq, kind="insert", **after):
    image = {k: str(v) for k, v in after.items()}
    return {"database": "shop", "tableName": table, "before": {}, "after": image,
            "type": kind, "seq": seq}


def route(seq, table, sink_type, sink_table, columns, operation="insert"):
    return change("table_process", seq, source_table=table, operate_type=operation,
                  sink_type=sink_type, sink_table=sink_table, sink_columns=columns)


ORDER_COLUMNS = "id,province_id,order_status,user_id,total_amount,create_time"
DETAIL_COLUMNS = "id,order_id,sku_id,order_price,sku_num,create_time,split_total_amount"
CONFIG = [
    route(1, "order_info", "kafka", "wrong", "id"),
    route(2, "order_info", "kafka", "dwd_order_info", ORDER_COLUMNS),
    route(3, "order_detail", "kafka", "dwd_order_detail", DETAIL_COLUMNS),
    route(4, "payment_info", "kafka", "dwd_payment_info",
          "id,order_id,user_id,total_amount,payment_type,create_time"),
    route(5, "cart_info", "kafka", "dwd_cart_info", "sku_id,create_time"),
    route(6, "favor_info", "kafka", "dwd_favor_info", "sku_id,create_time"),
    route(7, "order_refund_info", "kafka", "dwd_order_refund_info",
          "order_id,sku_id,refund_amount,create_time"),
    route(8, "comment_info", "kafka", "dwd_comment_info", "sku_id,appraise,create_time"),
    route(9, "user_info", "hbase", "DIM_USER_INFO", "id,gender,birthday"),
    route(10, "user_info", "hbase", "DIM_USER_INFO", "id,gender", "update"),
    route(11, "base_province", "hbase", "DIM_BASE_PROVINCE", "id,name,area_code,iso_code,iso_3166_2"),
    route(12, "sku_info", "hbase", "DIM_SKU_INFO", "id,sku_name,price,spu_id,tm_id,category3_id"),
    route(13, "spu_info", "hbase", "DIM_SPU_INFO", "id,spu_name"),
    route(14, "base_trademark", "hbase", "DIM_BASE_TRADEMARK", "id,tm_name"),
    route(15, "base_category3", "hbase", "DIM_BASE_CATEGORY3", "id,name"),
]
DIMENSIONS = [
    change("user_info", 1, id=1, gender="F", birthday="2000-01-01", password="p"),
    change("user_info", 2, "update", id=1, gender="M", password="q"),
    change("user_info", 3, "delete"),
    change("base_province", 4, id=3, name="Bei", area_code="110", iso_code="CN-11", iso_3166_2="CN-BJ"),
    change("sku_info", 5, id=7, sku_name="phone", price="9.50", spu_id=70, tm_id=71, category3_id=72),
    change("spu_info", 6, id=70, spu_name="spu"),
    change("base_trademark", 7, id=71, tm_name="tm"),
    change("base_category3", 8, id=72, name="cat"),
]


def order(seq, ident, at, user=1):
    return change("order_info", seq, id=ident, province_id=3, order_status="1001", user_id=user,
                  total_amount="20.80", create_time=at, secret="s")


def detail(seq, ident, order_id, at, amount="10.40", num=2):
    return change("order_detail", seq, id=ident, order_id=order_id, sku_id=7, order_price="5.20",
                  sku_num=num, create_time=at, split_total_amount=amount)


def later(seq):
    """A record of every fact days later, which moves all watermarks on."""
    at = "2023-11-24 22:13:20"
    return [
        order(seq, 99, at), detail(seq + 1, 990, 99, at),
        change("payment_info", seq + 2, id=99, order_id=99, user_id=1, total_amount="1", payment_type="1101", create_time=at),
        change("cart_info", seq + 3, sku_id=7, create_time=at),
        change("favor_info", seq + 4, sku_id=7, create_time=at),
        change("order_refund_info", seq + 5, order_id=99, sku_id=7, refund_amount="1", create_time=at),
        change("comment_info", seq + 6, sku_id=7, appraise="1203", create_time=at),
    ]


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    w = jobs.Warehouse(spark, str(root), every=None)

    def run(*starts):
        for start in starts:
            query = start(w)
            query.awaitTermination()

    write(root, jobs.CONFIG_LOG, 1, CONFIG)
    write(root, jobs.DB_LOG, 1, DIMENSIONS)
    write(root, jobs.APP_LOG, 1, [
        page(T0),
        page(T0 + 1_000, page_id="good_detail", last="home", item="7", kind="sku_id",
             displays=[{"item": "7", "item_type": "sku_id"}, {"item": "8", "item_type": "x"}]),
        page(T0 + 2_000, page_id="good_list", last="home", item="Red phone", kind="keyword"),
        page(T0, mid="m2", new="0"),
        {"common": {"mid": "m1", "is_new": "1"}, "start": {"entry": "icon"}, "ts": T0 + 3_000},
        "{not json",
    ])
    run(jobs.start_log_split, jobs.start_db_routing)
    write(root, jobs.DB_LOG, 2, [
        order(20, 1, clock(0)), detail(21, 10, 1, clock(1)), detail(22, 11, 1, clock(2), num=3),
        detail(23, 12, 1, clock(9)),
        order(24, 2, clock(0), user=55), detail(25, 20, 2, clock(0)),
        change("payment_info", 26, id=5, order_id=1, user_id=1, total_amount="20.80", payment_type="1101", create_time=clock(5)),
        change("cart_info", 27, sku_id=7, create_time=clock(1)),
        change("favor_info", 28, sku_id=7, create_time=clock(1)),
        change("order_refund_info", 29, order_id=1, sku_id=7, refund_amount="10.40", create_time=clock(3)),
        change("comment_info", 30, sku_id=7, appraise="1201", create_time=clock(4)),
        change("unrouted", 31, id=1), order(32, 3, clock(0)) | {"type": "delete"},
    ])
    run(jobs.start_db_routing, jobs.start_unique_visit, jobs.start_bounce, jobs.start_order_wide,
        jobs.start_payment_wide)
    # Far later records close what is still open.
    write(root, jobs.APP_LOG, 2, [
        page(FAR, last="x"), page(FAR, mid="m2", last="x", item="far", kind="keyword"),
    ])
    write(root, jobs.DB_LOG, 3, later(40))
    run(jobs.start_log_split, jobs.start_db_routing, jobs.start_unique_visit, jobs.start_bounce,
        jobs.start_order_wide, jobs.start_payment_wide, jobs.start_visitor_stats,
        jobs.start_keyword_stats, jobs.start_province_stats, jobs.start_product_stats)
    return w


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_log_topics(warehouse):
    log = warehouse.spark.read.schema("value string, topic string").text(warehouse.path(jobs.LOGS))
    counts = dict(rows(log.groupBy("topic").count(), "topic", "count"))
    assert counts == {logs.PAGE_TOPIC: 6, logs.START_TOPIC: 1, logs.DISPLAY_TOPIC: 2,
                      logs.DIRTY_TOPIC: 1}
    texts = [json.loads(r["value"]) for r in log.where(f"topic = '{logs.PAGE_TOPIC}'").collect()]
    flags = {(t["common"]["mid"], t["ts"]): t["common"]["is_new"] for t in texts}
    assert flags == {("m1", T0): "1", ("m1", T0 + 1_000): "0", ("m1", T0 + 2_000): "0",
                     ("m2", T0): "0", ("m1", FAR): "0", ("m2", FAR): "1"}
    assert all(t["common"]["os"] == "x" for t in texts), "fields the job does not use are kept"


def test_dimensions(warehouse):
    assert rows(warehouse.dimension("user"), "*") == [(1, "M", "2000-01-01")]
    assert rows(warehouse.dimension("sku"), "*") == [(7, "phone", Decimal("9.50"), 70, 71, 72)]
    last = max(
        r["batch"] for r in warehouse.spark.read.parquet(warehouse.path("dim/changes")).select("batch").collect()
    )
    before = rows(warehouse.dimension("sku"), "*")
    jobs.compact_dimensions(warehouse, last)
    assert rows(warehouse.dimension("sku"), "*") == before
    assert rows(warehouse.dimension("user"), "*") == [(1, "M", "2000-01-01")]


def test_config_and_tables(warehouse):
    config = warehouse.config()
    assert config.where("sink_table = 'wrong'").count() == 0
    warehouse.spark.sql("CREATE DATABASE IF NOT EXISTS dims")
    create_tables(warehouse.spark, config, "dims")
    table = warehouse.spark.table("dims.DIM_SKU_INFO")
    assert table.columns == "id,sku_name,price,spu_id,tm_id,category3_id".split(",")
    assert {kind for _, kind in table.dtypes} == {"string"}


def test_wide_tables(warehouse):
    wide = warehouse.spark.read.text(warehouse.path(jobs.ORDER_WIDE))
    got = sorted((json.loads(r["value"]) for r in wide.collect()), key=lambda r: r["detail_id"])
    # Detail 12 is outside the interval, order 2 has no user row.
    assert [(r["detail_id"], r["order_id"]) for r in got] == [(10, 1), (11, 1), (990, 99)]
    assert (got[0]["user_gender"], got[0]["province_name"], got[0]["spu_name"], got[0]["tm_name"],
            got[0]["category3_name"]) == ("M", "Bei", "spu", "tm", "cat")
    paid = warehouse.spark.read.text(warehouse.path(jobs.PAYMENT_WIDE))
    assert sorted(json.loads(r["value"])["detail_id"] for r in paid.collect()) == [10, 11, 990]


def test_visitor_stats(warehouse):
    got = jobs.stored_stats(warehouse, jobs.VISITOR_STATS, schemas.VISITOR_STATS)
    assert got.columns == schemas.VISITOR_STATS.fieldNames()
    # m1's entry is followed by a page within 10 s; m2's is a bounce.
    assert rows(got, "stt", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum") == [
        (clock(0), "0", 1, 3, 1, 1, 300), (clock(0), "1", 0, 1, 1, 0, 100)]


def test_keyword_and_province_stats(warehouse):
    words = jobs.stored_stats(warehouse, jobs.KEYWORD_STATS, schemas.KEYWORD_STATS)
    assert rows(words, "keyword", "ct", "stt") == [("phone", 1, clock(0)), ("red", 1, clock(0))]
    province = jobs.stored_stats(warehouse, jobs.PROVINCE_STATS, schemas.PROVINCE_STATS)
    assert rows(province, "stt", "province_name", "order_amount", "order_count") == [
        (clock(0), "Bei", Decimal("20.80"), 1)]


def test_product_stats_and_gmv(warehouse):
    got = jobs.stored_stats(warehouse, jobs.PRODUCT_STATS, schemas.PRODUCT_STATS)
    row = got.where(f"stt = '{clock(0)}'").collect()
    assert len(row) == 1
    row = row[0].asDict()
    assert {k: row[k] for k in (
        "sku_name", "sku_price", "spu_name", "tm_name", "category3_name", "display_ct", "click_ct",
        "favor_ct", "cart_ct", "order_sku_num", "order_amount", "order_ct", "payment_amount",
        "paid_order_ct", "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct",
    )} == {
        "sku_name": "phone", "sku_price": Decimal("9.50"), "spu_name": "spu", "tm_name": "tm",
        "category3_name": "cat", "display_ct": 1, "click_ct": 1, "favor_ct": 1, "cart_ct": 1,
        "order_sku_num": 5, "order_amount": Decimal("20.80"), "order_ct": 1,
        "payment_amount": Decimal("20.80"), "paid_order_ct": 1, "refund_order_ct": 1,
        "refund_amount": Decimal("10.40"), "comment_ct": 1, "good_comment_ct": 1,
    }
    assert jobs.gmv(warehouse, date(2023, 11, 14)).first()[0] == Decimal("20.80")


def test_topics_in_kafka_need_its_package(spark, tmp_path):
    """Without the package all that can be seen is that Kafka is asked for."""
    w = jobs.Warehouse(spark, str(tmp_path), servers="nowhere:9092")
    with pytest.raises(AnalysisException, match="kafka"):
        w.lines(logs.PAGE_TOPIC)
    with pytest.raises(AnalysisException, match="kafka"):
        w.send_batch(spark.createDataFrame([("x",)], "value string"), jobs.BOUNCE, 0)

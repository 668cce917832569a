"""The shop's tables as views of the sample tables.

The sample tables hold no shop logs, so each shop table is derived from one or
two of them, row by row: events play the behaviour log and the small facts,
orders and line items play orders and details, customers, parts, suppliers and
nations play the dimensions. Nothing is filtered out that the rule under test
would keep.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from rtdw.operators.wide import as_record
from rtdw.schemas import ORDER_DETAIL, ORDER_INFO, PAYMENT_INFO, struct
from rtdw.sources.lines import CHUNK, opened_store
from rtdw.sources.rows import literal_table
from rtdw.sources.tables import dealt_table, read_table

# Parameters of the sample runs: events are hours apart and ship dates months
# from their orders, so windows and intervals are wider than the shop's.
HOUR = "1 hour"
DAY = "1 day"
MONTH = "30 days"
BOUNCE_TIMEOUT = "6 hours"
DETAIL_LOWER, DETAIL_UPPER = "-60 days", "60 days"
PAY_LOWER, PAY_UPPER = "-15 minutes", "0 seconds"
AS_OF = "2024-01-01"
FIRST_DOCUMENT_MS = 1_704_067_200_000

# Category numbers by their place in this list, from 1.
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

# The sample tables' columns: with these a read needs no look at the files.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", struct(TABLES[name]))


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return dealt_table(spark, f"{sf_dir}/{name}.parquet", struct(TABLES[name]), key)


def _second(ts: str) -> str:
    """A time as text, without its fraction."""
    return f"cast(date_trunc('second', {ts}) as string)"


def money(value: str) -> str:
    return f"cast({value} as decimal(16,2))"


# Behaviour log


def events(source: DataFrame) -> DataFrame:
    """Events with an instant and the number in ``props``."""
    return source.selectExpr(
        "event_id",
        "cast(ts as timestamp) as ts",
        "user_id",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') as bigint) as k",
    )


def log_records(source: DataFrame) -> DataFrame:
    """Every event as a log record. Sign-ups are start logs, views are entry pages."""
    return events(source).selectExpr(
        "event_id",
        """named_struct(
             'mid', cast(user_id as string),
             'is_new', if(event_type in ('signup', 'view'), '1', '0'),
             'vc', if(k < 50, 'v1', 'v2'),
             'ch', if(value >= 20, 'web', 'app'),
             'ar', cast(k div 20 as string)) as common""",
        """case when event_type <> 'signup' then named_struct(
             'page_id', case event_type when 'view' then 'home' when 'click' then 'good_detail'
                        when 'purchase' then 'trade' else 'good_list' end,
             'last_page_id', case when event_type <> 'view' then 'home' end,
             'item', case when event_type in ('click', 'purchase') then cast(k as string) end,
             'item_type', case event_type when 'click' then 'sku_id'
                          when 'purchase' then 'sku_ids' end,
             'during_time', cast(round(value * 1000) as bigint)) end as page""",
        """case event_type
             when 'view' then array(
               named_struct('item', cast(k as string), 'item_type', 'sku_id'),
               named_struct('item', cast(k + 1 as string), 'item_type', 'sku_id'),
               named_struct('item', cast(k as string), 'item_type', 'activity_id'))
             when 'error' then array() end as displays""",
        "case when event_type = 'signup' then named_struct('entry', 'icon') end as start",
        "unix_millis(ts) as ts",
    )


def page_log(source: DataFrame) -> DataFrame:
    """The page branch of the log, typed."""
    pages = source.where("event_type <> 'signup'")
    return log_records(pages).drop("start")


RECORD_TEXT = "to_json(struct(common, page, displays, start, ts)) as value"


def raw_log(source: DataFrame, conversations: DataFrame) -> DataFrame:
    """Log lines as text; conversation turns are the lines that are not records."""
    lines = log_records(source).selectExpr(RECORD_TEXT)
    return lines.unionByName(conversations.selectExpr("text as value"))


# Log files of several hosts, as a logger writes them: appended to and rolled once.
ROWS_PER_HOST = 100_000


def log_files(source: DataFrame, path: str) -> DataFrame:
    """All log lines in two files per host, one for each half of the time; the host numbers.

    Hosts are as many as the rows need, and each is written by one task.
    """
    lines = log_records(source).selectExpr("ts", "event_id", RECORD_TEXT)
    rows, low, high = lines.selectExpr("count(*)", "min(ts)", "max(ts)").first().asDict().values()
    hosts, middle = max(4, rows // ROWS_PER_HOST), ((low or 0) + (high or 0)) // 2
    placed = lines.selectExpr("value", f"ts > {middle} as later", f"pmod(hash(event_id), {hosts}) as host", "ts")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened_store(path)
        store.create_dir(base)
        out, now = None, None
        for batch in batches:
            for host, later, value in zip(*(batch.column(c).to_pylist() for c in ("host", "later", "value")), strict=True):
                if (host, later) != now:
                    if out:
                        out.close()
                    now = (host, later)
                    out = store.open_output_stream(f"{base}/{host}.{int(later)}")
                out.write((value + "\n").encode())
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["host"])

    ordered = placed.repartition("host").sortWithinPartitions("host", "later", "ts").drop("ts")
    ordered.mapInArrow(write, "host bigint").count()
    return source.sparkSession.range(hosts).selectExpr("id as host", f"'{path}' as days")


def next_log_state(hosts: DataFrame, path: str, step: int) -> None:
    """The hosts' log folders after a step: a part of the first half of the time, all of it, the roll
    and a part of the second half, all of that."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened_store(path)
        for batch in batches:
            for host, days in zip(batch.column("host").to_pylist(), batch.column("days").to_pylist(), strict=True):
                whole = f"{opened_store(days)[1]}/{host}.{step // 2}"
                folder = f"{base}/host={host}"
                store.create_dir(folder)
                log, rolled = f"{folder}/app.log", f"{folder}/app.2024-01-01.log"
                there = [x.type == pyarrow.fs.FileType.File for x in store.get_file_info([log, rolled])]
                if step == 2 and there == [True, False]:  # not again if the task is repeated
                    store.move(log, rolled)
                size = store.get_file_info(whole).size
                if not size:
                    continue
                size = size if step % 2 else size * 3 // 5
                with store.open_input_file(whole) as file, store.open_output_stream(f"{folder}/.next") as out:
                    while size and (data := file.read(min(size, CHUNK))):
                        out.write(data)
                        size -= len(data)
                store.move(f"{folder}/.next", log)
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["host"])

    hosts.mapInArrow(write, "host bigint").count()


def search_pages(documents: DataFrame, source: DataFrame) -> DataFrame:
    """Pages for the keyword job: each document is a searched text, events are other pages."""
    searched = documents.selectExpr(
        "map('item_type', 'keyword', 'item', text) as page",
        f"doc_id * 60000 + {FIRST_DOCUMENT_MS} as ts",
    )
    others = page_log(source).selectExpr(
        "map('item_type', page.item_type, 'item', page.item) as page", "ts"
    )
    return searched.unionByName(others).selectExpr(
        "page", "ts", "date_trunc('second', timestamp_millis(ts)) as rt"
    )


# The characters that stand for the letters a to z in Han lines.
HAN_LETTERS = "天地人日月山水火木金土上下左右大小多少春夏秋冬東西南"


def han_lines(documents: DataFrame) -> DataFrame:
    """Documents with their Latin letters as Han characters: ``spaced``, and ``line`` without blanks."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    spaced = documents.selectExpr("doc_id", f"translate(lower(text), '{letters}', '{HAN_LETTERS}') as spaced")
    return spaced.selectExpr("*", "replace(spaced, ' ', '') as line")


# Facts


def order_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders; the province is the customer's nation."""
    home = customer.selectExpr("c_custkey as o_custkey", "c_nationkey")
    return as_record(
        orders.join(home, "o_custkey"),
        ORDER_INFO,
        {
            "id": "o_orderkey",
            "province_id": "c_nationkey",
            "order_status": "case o_orderstatus when 'O' then '1001' when 'P' then '1002' "
            "else '1004' end",
            "user_id": "o_custkey",
            "total_amount": money("o_totalprice"),
            "activity_reduce_amount": "0",
            "coupon_reduce_amount": money(f"{money('o_totalprice')} * cast(0.05 as decimal(4,2))"),
            "original_total_amount": money("o_totalprice"),
            "feight_fee": "length(o_orderpriority)",
            "create_time": "cast(o_orderdate as string)",
        },
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    price = money("l_extendedprice")
    off = money(f"{price} * cast(l_discount as decimal(4,2))")
    return as_record(
        lineitem,
        ORDER_DETAIL,
        {
            "id": "l_orderkey * 8 + l_linenumber",
            "order_id": "l_orderkey",
            "sku_id": "l_partkey",
            "order_price": price,
            "sku_num": "l_quantity",
            "sku_name": "concat('sku ', l_partkey)",
            "split_activity_amount": money(f"{price} * cast(l_tax as decimal(4,2))"),
            "create_time": "cast(l_shipdate as string)",
            "split_total_amount": f"{price} - {off}",
            "split_coupon_amount": off,
        },
    )


def payment_info(orders: DataFrame) -> DataFrame:
    """Orders that are not open; the dearer the order, the later its payment."""
    later = "make_dt_interval(0, 0, 0, cast(floor(o_totalprice / 300) as decimal(18,6)))"
    return as_record(
        orders.where("o_orderstatus <> 'O'"),
        PAYMENT_INFO,
        {
            "id": "o_orderkey",
            "order_id": "o_orderkey",
            "user_id": "o_custkey",
            "total_amount": money("o_totalprice"),
            "subject": "o_orderpriority",
            "payment_type": "case when o_totalprice < 100000 then '1101' "
            "when o_totalprice < 300000 then '1102' else '1103' end",
            "create_time": f"cast(o_orderdate + {later} as string)",
            "callback_time": f"case when o_totalprice < 300000 then cast(o_orderdate + {later} as string) end",
        },
    )


def _small_fact(source: DataFrame, event_type: str, *more: str) -> DataFrame:
    rows = events(source.where(f"event_type = '{event_type}'"))
    return rows.selectExpr("k as sku_id", *more, f"{_second('ts')} as create_time")


def favor_info(source: DataFrame) -> DataFrame:
    return _small_fact(source, "signup")


def cart_info(source: DataFrame) -> DataFrame:
    return _small_fact(source, "purchase")


def comment_info(source: DataFrame) -> DataFrame:
    return _small_fact(source, "error", "if(value >= 20, '1201', '1203') as appraise")


def refund_info(lineitem: DataFrame) -> DataFrame:
    return lineitem.where("l_returnflag = 'R'").selectExpr(
        "l_orderkey as order_id",
        "l_partkey as sku_id",
        f"{money('l_extendedprice')} as refund_amount",
        "cast(l_shipdate as string) as create_time",
    )


# Dimensions


def dim_user(customer: DataFrame) -> DataFrame:
    """Customers; the richer one is, the earlier the birthday."""
    return customer.selectExpr(
        "c_custkey as id",
        "if(c_mktsegment = 'HOUSEHOLD', 'F', 'M') as gender",
        "cast(date_sub(date'1990-01-01', cast(floor(c_acctbal) as int)) as string) as birthday",
    )


def dim_province(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(
        "cast(n_nationkey as bigint) as id",
        "n_name as name",
        "cast(n_regionkey as string) as area_code",
        "concat('N', n_nationkey) as iso_code",
        "concat('R', n_regionkey, '-', n_nationkey) as iso_3166_2",
    )


BRAND_NUMBER = r"cast(regexp_extract(p_brand, r'(\d+)', 1) as bigint)"
TYPE_NUMBER = f"array_position(array{PART_TYPES}, p_type)"


def dim_sku(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey as id",
        "p_name as sku_name",
        f"{money('p_retailprice')} as price",
        "cast(p_size as bigint) as spu_id",
        f"{BRAND_NUMBER} as tm_id",
        f"{TYPE_NUMBER} as category3_id",
    )


def dim_spu(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr("s_suppkey as id", "s_name as spu_name")


def dim_trademark(part: DataFrame) -> DataFrame:
    return part.select("p_brand").distinct().selectExpr(
        f"{BRAND_NUMBER} as id", "p_brand as tm_name"
    )


def dim_category3(part: DataFrame) -> DataFrame:
    return part.select("p_type").distinct().selectExpr(f"{TYPE_NUMBER} as id", "p_type as name")


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = table(spark, sf_dir, "part")
    return {
        "user": dim_user(table(spark, sf_dir, "customer")),
        "province": dim_province(table(spark, sf_dir, "nation")),
        "sku": dim_sku(part),
        "spu": dim_spu(table(spark, sf_dir, "supplier")),
        "trademark": dim_trademark(part),
        "category3": dim_category3(part),
    }


# Change records


def raw_changes(source: DataFrame, orders: DataFrame) -> DataFrame:
    """Logged changes: users, payments and favourites from events, orders from orders."""
    image = """map('id', cast(user_id as string), 'name', concat('user', k),
                   'level', cast(k as string), 'phone', concat('1', event_id))"""
    from_events = events(source).selectExpr(
        """concat('mysql.shop.', case when event_type in ('signup', 'click', 'error')
             then 'user_info' when event_type = 'purchase' then 'payment_info'
             else 'favor_info' end) as topic""",
        "case event_type when 'click' then 'u' when 'error' then 'd' else 'CREATE' end as op",
        f"case when event_type in ('click', 'error') then {image} end as before",
        f"case when event_type <> 'error' then {image} end as after",
        "event_id as seq",
    )
    from_orders = orders.selectExpr(
        "'mysql.shop.order_info' as topic",
        "'c' as op",
        "cast(null as map<string,string>) as before",
        f"""map('id', cast(o_orderkey as string), 'user_id', cast(o_custkey as string),
                'total_amount', cast({money('o_totalprice')} as string),
                'order_comment', o_orderpriority) as after""",
        "o_orderkey as seq",
    )
    return from_events.unionByName(from_orders)


def user_snapshot(customer: DataFrame) -> DataFrame:
    """Stored users before the logged changes."""
    return customer.selectExpr(
        "cast(c_custkey as string) as id",
        "c_name as name",
        "cast(c_nationkey as string) as level",
        "cast(null as string) as phone",
    )


def config_changes(part: DataFrame) -> DataFrame:
    """Parts as changes of the routing config; large parts are deletes."""
    row = """map('source_table', p_type, 'operate_type', p_brand,
                 'sink_type', if(p_size < 25, 'kafka', 'hbase'), 'sink_table', p_name,
                 'sink_columns', concat('id,', split(p_name, ' ')[0]), 'sink_pk', 'id')"""
    empty = "cast(map() as map<string,string>)"
    return part.selectExpr(
        f"if(p_size >= 45, {row}, {empty}) as before",
        f"if(p_size >= 45, {empty}, {row}) as after",
        "if(p_size >= 45, 'delete', 'insert') as type",
        "p_partkey as seq",
    )


# The routing config of the sample runs.
ROUTES = (
    ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount", "id"),
    ("payment_info", "insert", "kafka", "dwd_payment_info", "id,name", "id"),
    ("user_info", "insert", "hbase", "DIM_USER_INFO", "id,name,level", "id"),
    ("user_info", "update", "hbase", "DIM_USER_INFO", "id,name", "id"),
    ("favor_info", "insert", "file", "favor_info", "id", "id"),
)


def routes(spark: SparkSession) -> DataFrame:
    ddl = (
        "source_table string, operate_type string, sink_type string, sink_table string, "
        "sink_columns string, sink_pk string"
    )
    return literal_table(spark, ddl, ROUTES)

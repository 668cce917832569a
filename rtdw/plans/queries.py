"""One query per operator, on the sample tables. Check SQL is in ``checks``."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rtdw.functions import codes, text, times
from rtdw.operators import cdc, events, joins, logs, parse, routing, segment, stats, visits, wide
from rtdw.plans import standin
from rtdw.plans.standin import table
from rtdw.schemas import MONEY_SUM, ORDER_INFO, PRODUCT_STATS, struct
from rtdw.session import fresh_dir
from rtdw.sinks.keyed_dims import KeyedDimension
from rtdw.sinks.topics import as_text
from rtdw.sources.topics import records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name; it runs in UTC."""

    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


# Shared inputs


def _page_log(spark, d):
    return standin.page_log(table(spark, d, "events"))


def _order_detail(spark, d):
    return standin.order_detail(table(spark, d, "lineitem"))


def _order_wide(spark, d):
    return wide.order_wide(
        standin.order_info(table(spark, d, "orders"), table(spark, d, "customer")),
        _order_detail(spark, d),
        standin.DETAIL_LOWER,
        standin.DETAIL_UPPER,
    )


def _order_wide_table(spark, d):
    """Order wide written once, as the table between the layers, for several readers."""
    path, rows = fresh_dir(spark, "order-wide"), _order_wide(spark, d)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _payment_wide(spark, d, orders_wide):
    return wide.payment_wide(
        standin.payment_info(table(spark, d, "orders")),
        orders_wide,
        standin.PAY_LOWER,
        standin.PAY_UPPER,
    )


def _product_events(spark, d):
    source, lineitem = table(spark, d, "events"), table(spark, d, "lineitem")
    orders_wide = _order_wide_table(spark, d)
    return events.product_events(
        _page_log(spark, d),
        standin.favor_info(source),
        orders_wide,
        _payment_wide(spark, d, orders_wide),
        standin.refund_info(lineitem),
        standin.cart_info(source),
        standin.comment_info(source),
    )


def _product_stats(spark, d):
    return stats.product_stats(
        _product_events(spark, d), standin.dimensions(spark, d), standin.DAY
    )


def _changes(spark, d):
    return cdc.normalise(
        standin.raw_changes(table(spark, d, "events"), table(spark, d, "orders"))
    )


def _user_changes(spark, d):
    return _changes(spark, d).where(F.col("tableName") == "user_info")


def topic_counts(rows):
    """Rows per topic, page and new-visitor flag."""
    clean = F.when(F.col("topic") != logs.DIRTY_TOPIC, F.col("value"))
    top = rows.select("topic", F.json_tuple(clean, "common", "page", "page_id").alias("common", "page", "shown_on"))
    return (
        top.select("topic", "common", "shown_on", F.json_tuple("page", "page_id").alias("of_page"))
        .select("topic", "shown_on", "of_page", F.json_tuple("common", "is_new").alias("is_new"))
        .select("topic", F.coalesce("of_page", "shown_on").alias("page_id"), "is_new")
        .groupBy("topic", "page_id", "is_new")
        .agg(F.count("*").alias("n"))
    )


def line_fields(rows):
    """The fields of each split line; a line that is no record has a hash instead.

    A line is parsed once, its two objects once more, whatever the number of fields.
    """
    dirty = F.col("topic") == logs.DIRTY_TOPIC
    common = ("mid", "is_new", "vc", "ch", "ar")
    page = ("page_id", "last_page_id", "item", "item_type", "during_time")
    whole = ("ts", "entry", "page_id", "item", "item_type", "displays")
    shown = F.get_json_object("__displays", "$[*].item").alias("displays")
    both = [F.coalesce(f"__of_{c}", f"__{c}").alias(c) for c in ("page_id", "item", "item_type")]
    top = rows.select(
        "topic", F.when(dirty, F.md5("value")).alias("line_md5"),
        F.json_tuple(F.when(~dirty, F.col("value")), "common", "page", *whole)
        .alias("common", "page", *[f"__{c}" for c in whole]),
    )
    of_page = top.select("*", F.json_tuple("page", *page).alias(*[f"__of_{c}" for c in page]))
    return of_page.select("*", F.json_tuple("common", *common).alias(*common)).select(
        "topic", *common, F.col("__of_last_page_id").alias("last_page_id"),
        F.col("__of_during_time").alias("during_time"), F.col("__ts").alias("ts"),
        F.col("__entry").alias("entry"), shown, *both, "line_md5",
    )


# Sources and parsing


@query
def scan_page_view(spark, d):
    lines = standin.log_records(table(spark, d, "events")).selectExpr(standin.RECORD_TEXT)
    return parse.page_view(lines).select(
        F.col("common")["mid"].alias("mid"),
        F.col("page")["page_id"].alias("page_id"),
        F.col("page")["item"].alias("item"),
        "ts",
        times.ts_to_text("rt").alias("rt"),
    )


@query
def json_dirty_split(spark, d):
    props = table(spark, d, "events").select(
        F.lit("event").alias("source"), F.col("event_id").alias("line"), F.col("props").alias("value")
    )
    turns = table(spark, d, "conversations").select(
        F.lit("turn").alias("source"), F.col("conv_id").alias("line"), F.col("text").alias("value")
    )
    texts = table(spark, d, "documents").select(
        F.lit("document").alias("source"), F.col("doc_id").alias("line"), F.col("text").alias("value")
    )
    lines = props.unionByName(turns).unionByName(texts)
    return parse.mark_dirty(lines).select("source", "line", "dirty")


@query
def log_split_counts(spark, d):
    lines = standin.raw_log(table(spark, d, "events"), table(spark, d, "conversations"))
    fixed = logs.fix_new_visitor(logs.read_log(lines), order=("ts", "line_id"))
    rows = logs.split_topics(fixed)
    return topic_counts(rows)


@query
def log_split_lines(spark, d):
    """Every line that the split writes, by the fields of its text; dirty ones by its hash."""
    lines = standin.raw_log(table(spark, d, "events"), table(spark, d, "conversations"))
    fixed = logs.fix_new_visitor(logs.read_log(lines), order=("ts", "line_id"))
    return line_fields(logs.split_topics(fixed))


@query
def display_explode(spark, d):
    rows = standin.log_records(table(spark, d, "events")).selectExpr(
        "page.page_id as page_id",
        "transform(displays, x -> map('item', x.item, 'item_type', x.item_type)) as displays",
        "to_json(start) as start",
    )
    shown = F.col("display")
    return (
        logs.display_rows(rows)
        .groupBy(
            shown["page_id"].alias("page_id"),
            shown["item"].alias("item"),
            shown["item_type"].alias("item_type"),
        )
        .agg(F.count("*").alias("n"))
    )


# Keyed rules


@query
def new_visitor_fix(spark, d):
    rows = standin.log_records(table(spark, d, "events")).select(
        "event_id", "ts", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new")
    )
    return logs.fix_new_visitor(rows, order=("ts", "event_id"))


@query
def unique_visit_daily(spark, d):
    kept = visits.unique_visits(_page_log(spark, d), tiebreak=("event_id",))
    return kept.select(
        "event_id",
        F.col("common.mid").alias("mid"),
        F.col("page.page_id").alias("page_id"),
        times.millis_to_text("ts").alias("visited"),
    )


@query
def bounce_detail(spark, d):
    kept = visits.bounces(
        _page_log(spark, d), tiebreak=("event_id",), timeout=standin.BOUNCE_TIMEOUT
    )
    return kept.select("event_id", F.col("common.mid").alias("mid"), "ts")


# Wide tables and dimensions


@query
def order_wide(spark, d):
    return _order_wide(spark, d)


@query
def payment_wide(spark, d):
    return _payment_wide(spark, d, _order_wide(spark, d))


def _dimensions_with_gaps(spark, d):
    """The dimensions without poorer users and SPUs, so that lookups miss rows."""
    users = table(spark, d, "customer").where("c_acctbal >= 1000")
    makers = table(spark, d, "supplier").where("s_acctbal >= 1000")
    return {
        **standin.dimensions(spark, d),
        "user": standin.dim_user(users), "spu": standin.dim_spu(makers),
    }


@query
def order_wide_dims(spark, d):
    dims = _dimensions_with_gaps(spark, d)
    return wide.add_dimensions(_order_wide(spark, d), dims, standin.AS_OF).select(
        "detail_id", "order_id", "sku_id", "sku_name", "user_id", "user_age", "user_gender",
        "province_id", "province_name", "province_area_code", "province_iso_code",
        "province_3166_2_code", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id",
        "category3_name", "split_total_amount", "create_time",
    )


@query
def order_wide_dims_left(spark, d):
    dims = _dimensions_with_gaps(spark, d)
    return wide.add_dimensions(_order_wide(spark, d), dims, standin.AS_OF, how="left").select(
        "detail_id", "order_id", "sku_id", "sku_name", "user_age", "province_name", "spu_id",
        "spu_name", "tm_name", "category3_name",
    )


@query
def dim_lookup_by_id(spark, d):
    users = standin.dim_user(table(spark, d, "customer"))
    return joins.lookup(users, table(spark, d, "events"), "user_id")


@query
def order_wide_coalesce(spark, d):
    orders = standin.order_info(table(spark, d, "orders"), table(spark, d, "customer"))
    gaps = wide.order_times(orders).select(
        F.col("id").alias("order_id"),
        F.when(F.col("order_status") != "1004", F.col("order_status")).alias("order_status"),
        F.when(F.col("total_amount") > 100_000, F.col("total_amount")).alias("total_amount"),
        F.when(F.col("province_id") > 4, F.col("user_id")).alias("user_id"),
        F.when(F.col("province_id") > 9, F.col("create_time")).alias("create_time"),
        "province_id",
    )
    other = standin.payment_info(table(spark, d, "orders")).select(
        "order_id", F.lit("1002").alias("order_status"), "total_amount", "user_id", "create_time"
    )
    return wide.merge_wide(gaps, other, key="order_id")


@query
def order_time_parts(spark, d):
    created = table(spark, d, "events").select(
        "event_id", times.ts_to_text("ts").alias("create_time")
    )
    return wide.order_times(created)


@query
def user_age(spark, d):
    users = standin.dim_user(table(spark, d, "customer"))
    return users.select("id", "birthday", times.age_years("birthday", standin.AS_OF).alias("user_age"))


@query
def fact_records(spark, d):
    """Orders written as JSON text and read back as typed records."""
    lines = as_text(
        standin.order_info(table(spark, d, "orders"), table(spark, d, "customer"))
    )
    return records(lines, ORDER_INFO).select(
        "id", "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
        "create_time",
    )


@query
def province_rows(spark, d):
    return wide.province_row(_order_wide(spark, d)).select(
        "province_id", "order_amount", "order_count"
    )


# Statistics


@query
def product_click_display(spark, d):
    return (
        events.clicks_and_displays(_page_log(spark, d))
        .groupBy("sku_id")
        .agg(F.sum("click_ct").alias("click_ct"), F.sum("display_ct").alias("display_ct"))
    )


@query
def product_events_unified(spark, d):
    return _product_events(spark, d)


_SUM = MONEY_SUM.simpleString()
PRODUCT_COLUMNS = (
    "stt", "edt", "sku_id", "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
    f"cast(order_amount as {_SUM}) as order_amount", "order_ct",
    f"cast(payment_amount as {_SUM}) as payment_amount", "paid_order_ct", "refund_order_ct",
    f"cast(refund_amount as {_SUM}) as refund_amount", "comment_ct", "good_comment_ct", "ts",
)


@query
def product_stats(spark, d):
    measured = stats.product_measures(_product_events(spark, d), standin.DAY)
    return measured.selectExpr(*PRODUCT_COLUMNS)


@query
def product_stats_dims(spark, d):
    return _product_stats(spark, d).select(
        "stt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
        "category3_id", "category3_name",
    )


@query
def product_stats_sink_columns(spark, d):
    return stats.to_sink_order(_product_stats(spark, d), PRODUCT_STATS)


@query
def distinct_orders_by_sku(spark, d):
    details = events.orders(_order_detail(spark, d))
    return stats.distinct_orders(details, "sku_id", "order_id", standin.MONTH)


@query
def province_stats(spark, d):
    located = joins.enrich(
        _order_wide(spark, d),
        standin.dim_province(table(spark, d, "nation")),
        "province_id",
        {
            "province_name": "name",
            "province_area_code": "area_code",
            "province_iso_code": "iso_code",
            "province_3166_2_code": "iso_3166_2",
        },
    )
    return stats.province_stats(located, standin.DAY).drop("ts")


@query
def gmv_by_day(spark, d):
    orders = events.orders(_order_wide(spark, d))
    return stats.gmv_by_day(stats.product_measures(orders, standin.DAY))


@query
def visitor_stats(spark, d):
    pages = _page_log(spark, d)
    unified = events.visitor_events(
        pages,
        visits.unique_visits(pages, tiebreak=("event_id",)),
        visits.bounces(pages, tiebreak=("event_id",), timeout=standin.BOUNCE_TIMEOUT),
    )
    return stats.visitor_stats(unified, standin.HOUR)


@query
def session_starts(spark, d):
    return (
        events.page_views(_page_log(spark, d))
        .groupBy("ch", "ar", "vc", "is_new")
        .agg(F.sum("pv_ct").alias("pv_ct"), F.sum("sv_ct").alias("sv_ct"))
    )


@query
def good_comment_rate(spark, d):
    return (
        events.comments(standin.comment_info(table(spark, d, "events")))
        .groupBy("sku_id")
        .agg(
            F.sum("comment_ct").alias("comment_ct"),
            F.sum("good_comment_ct").alias("good_comment_ct"),
        )
        .withColumn(
            "good_rate", F.round(F.col("good_comment_ct") / F.col("comment_ct"), 6)
        )
    )


@query
def keyword_filter(spark, d):
    pages = standin.search_pages(table(spark, d, "documents"), table(spark, d, "events"))
    return stats.keyword_rows(pages).select("full_word", times.ts_to_text("rt").alias("rt"))


@query
def keyword_count(spark, d):
    pages = standin.search_pages(table(spark, d, "documents"), table(spark, d, "events"))
    return stats.keyword_stats(pages, standin.HOUR).drop("ts")


@query
def keyword_lateral_sql(spark, d):
    text.register_split_function(spark)
    pages = standin.search_pages(table(spark, d, "documents"), table(spark, d, "events"))
    return spark.sql(
        f"""
        SELECT word AS keyword, count(*) AS ct
        FROM {{searched}}, LATERAL {text.SPLIT_FUNCTION}(full_word)
        GROUP BY word
        """,
        searched=stats.keyword_rows(pages),
    )


@query
def keyword_han_words(spark, d):
    """The texts are shuffled, by document, not the words they are cut to."""
    dictionary = segment.counted_dictionary(standin.han_lines(table(spark, d, "documents")), "spaced")
    lines = standin.han_lines(standin.dealt(spark, d, "documents", "doc_id"))
    found = segment.dictionary_words(lines.select("doc_id", "line"), "line", dictionary)
    return found.groupBy("doc_id", F.col("word").alias("keyword")).agg(F.count("*").alias("ct"))


# Change records


@query
def cdc_normalize(spark, d):
    return _changes(spark, d).select(
        "database",
        "tableName",
        F.col("before")["id"].alias("before_id"),
        F.size("before").alias("before_columns"),
        F.col("after")["id"].alias("after_id"),
        F.size("after").alias("after_columns"),
        "type",
        "seq",
    )


@query
def cdc_filter_deletes(spark, d):
    return cdc.drop_deletes(_changes(spark, d)).select(
        "tableName", "type", F.col("after")["id"].alias("id"), "seq"
    )


@query
def cdc_latest_table(spark, d):
    users = struct("id bigint, name string, level int, phone string")
    return cdc.typed_rows(cdc.fold(_user_changes(spark, d)), users)


@query
def cdc_snapshot_plus_changes(spark, d):
    users = struct("id bigint, name string, level int, phone string")
    current = cdc.snapshot_plus_changes(
        standin.user_snapshot(table(spark, d, "customer")), _changes(spark, d), "shop", "user_info"
    )
    return cdc.typed_rows(current, users)


@query
def dim_upsert_latest(spark, d):
    routed = routing.dimensions(routing.route(_changes(spark, d), standin.routes(spark)))
    stored = standin.user_snapshot(table(spark, d, "customer")).select("id", "name", "level")
    return cdc.upsert(stored, routed)


@query
def dim_keyed_upsert(spark, d):
    """User changes applied to the bucketed store in two batches, the later changes first."""
    routed = routing.dimensions(routing.route(_changes(spark, d), standin.routes(spark)))
    store = KeyedDimension(spark, fresh_dir(spark, "keyed-users"), ["id", "name", "level"])
    half = (routed.agg(F.max("seq")).first()[0] or 0) // 2
    for batch, part in enumerate((f"seq > {half}", f"seq <= {half}")):
        store.apply(routed.where(part), batch)
    return store.read()


@query
def dim_keyed_lookup(spark, d):
    """The user of the last event, from its bucket of a store that holds all users."""
    users = standin.dim_user(table(spark, d, "customer"))
    store = KeyedDimension(spark, fresh_dir(spark, "keyed-lookup"), users.columns)
    store.load(users)
    last = table(spark, d, "events").agg(F.max_by("user_id", F.struct("ts", "event_id"))).first()[0]
    return store.lookup_one(str(last))


# Routing


@query
def config_latest(spark, d):
    rows = routing.config_rows(standin.config_changes(table(spark, d, "part")))
    return routing.latest_config(rows).drop("sink_extend")


@query
def config_column_prune(spark, d):
    config = routing.config_rows(standin.config_changes(table(spark, d, "part")))
    payload = F.create_map(
        F.lit("id"), F.col("seq").cast("string"),
        F.lit("red"), F.lit("r"),
        F.lit("blue"), F.lit("b"),
        F.lit("cold"), F.lit("c"),
        F.lit("large"), F.lit("l"),
    )
    return config.select(
        "seq",
        "sink_columns",
        F.to_json(routing.keep_columns(payload, "sink_columns")).alias("payload"),
    )


@query
def route_fact_payload(spark, d):
    routed = routing.route(
        cdc.drop_deletes(_changes(spark, d)), standin.routes(spark)
    )
    return routing.facts(routed)


@query
def route_dim_payload(spark, d):
    routed = routing.dimensions(
        routing.route(cdc.drop_deletes(_changes(spark, d)), standin.routes(spark))
    )
    return routed.select(
        "sink_table", "type", "seq", F.to_json("after").alias("payload"), "sink_pk"
    )


@query
def decode_codes(spark, d):
    orders = standin.order_info(table(spark, d, "orders"), table(spark, d, "customer")).select(
        "id", "order_status"
    )
    return codes.with_label(orders, "order_status", "order_status", "status_label")

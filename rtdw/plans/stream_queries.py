"""The operators as streaming jobs over the sample tables.

A run reads a table as a stream, processes all of it and returns what was
appended. A row far ahead of all others comes along, which closes the windows
of the table's last rows; its own window stays open. Jobs that read other jobs'
results read them as tables, as the running jobs do.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rtdw.functions import times
from rtdw.operators import cdc, events, joins, parse, routing, stats, wide
from rtdw.operators import visits as stored_visits
from rtdw.plans import standin
from rtdw.plans.queries import PRODUCT_COLUMNS, line_fields, query, topic_counts
from rtdw.plans.standin import TABLES, table
from rtdw.schemas import CHANGE, ORDER_WIDE, PAYMENT_WIDE, struct
from rtdw.session import fresh_dir, remove_dir, session_settings
from rtdw.sinks.dims import DimensionStore
from rtdw.sources import growing
from rtdw.streaming import changelog, config, jobs, keyed, visits
from rtdw.streaming.run import (
    BOUNDED_MEMORY, INNER_JOINS, in_share, read_folders, run_shares, run_to_folder, run_to_table, start_batches,
    start_table, state_partitions,
)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table as a stream. The name is a pattern, so a file and a folder both work."""
    return spark.readStream.schema(struct(TABLES[name])).parquet(f"{sf_dir}/{name}.parque[t]")


def run_over(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], stream: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over sample tables, with partitions of its state by their size."""
    parts = state_partitions(spark, *[f"{sf_dir}/{name}.parquet" for name in tables])
    return run_to_table(spark, stream, purpose, parts)


def run_by_shares(
    spark: SparkSession, sf_dir: str, tables: tuple[str, ...], stream_of: Callable[[int, int], DataFrame], purpose: str
) -> list[str]:
    """Run ``stream_of(share, shares)`` for each share of its keys, of which the sample tables take
    more the larger they are; the folders of the results. Disk is taken for one share at a time."""
    paths = [f"{sf_dir}/{name}.parquet" for name in tables]
    shares = run_shares(spark, *paths)
    parts = -(-state_partitions(spark, *paths) // shares)
    return [run_to_folder(spark, stream_of(share, shares), purpose, parts) for share in range(shares)]


ORDERED = ("orders", "lineitem")  # the tables that order wide and its followers read

FAR_MS = 4_102_444_800_000
FAR_TEXT = "2100-01-01 00:00:00"


def stored_stream(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written as a table, as a stream."""
    path = fresh_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def with_far_row(stream: DataFrame, **values) -> DataFrame:
    """The stream and one row with these values, null elsewhere."""
    spark = stream.sparkSession
    row = tuple(values.get(c) for c in stream.columns)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    far = stored_stream(spark, spark.createDataFrame([row], nullable), "far-row")
    return stream.unionByName(far)


def _pages(spark, d):
    return standin.page_log(stream_table(spark, d, "events"))


def _orders(spark, d):
    return standin.order_info(stream_table(spark, d, "orders"), table(spark, d, "customer"))


def _order_wide(spark, d):
    """Folders of order wide, one for each share of the orders."""

    def joined(share, shares):
        return wide.order_wide(
            in_share(_orders(spark, d), "id", share, shares),
            in_share(standin.order_detail(stream_table(spark, d, "lineitem")), "order_id", share, shares),
            standin.DETAIL_LOWER,
            standin.DETAIL_UPPER,
        )

    with session_settings(spark, INNER_JOINS):
        return run_by_shares(spark, d, ORDERED, joined, "order-wide")


def _order_wide_topic(spark, folders):
    """Finished tables of order wide as a stream."""
    return read_folders(spark, ORDER_WIDE, folders, as_stream=True)


def _payment_wide(spark, d, orders_wide):
    """Folders of payment wide. A share of the orders has its payments and its order wide alone."""

    def joined(share, shares):
        paid = in_share(standin.payment_info(stream_table(spark, d, "orders")), "order_id", share, shares)
        topic = _order_wide_topic(spark, orders_wide[share : share + 1])
        return wide.payment_wide(paid, topic, standin.PAY_LOWER, standin.PAY_UPPER)

    with session_settings(spark, INNER_JOINS):
        return run_by_shares(spark, d, ORDERED, joined, "payment")


def _remove(spark, folders):
    for folder in folders:
        remove_dir(spark, folder)


@query
def stream_new_visitor_fix(spark, d):
    rows = standin.log_records(stream_table(spark, d, "events")).selectExpr(
        "event_id", "ts", "common.mid as mid", "common.is_new as is_new"
    )
    fixed = keyed.fix_new_visitor(rows, order=("ts", "event_id"))
    return run_to_table(spark, fixed, "new-visitor")


@query
def stream_unique_visit(spark, d):
    kept = visits.unique_visits(_pages(spark, d)).selectExpr(
        "common.mid as mid", "cast(to_date(timestamp_millis(ts)) as string) as day"
    )
    return run_to_table(spark, kept, "unique-visit")


def _bounced(spark, d):
    pages = _pages(spark, d).selectExpr(
        "common.mid as mid", "ts", "page.last_page_id is null as entry",
        "lpad(event_id, 20, '0') as tie", "cast(event_id as string) as value",
    )
    pages = with_far_row(pages, mid="far", ts=FAR_MS, entry=True, tie="", value="")
    return keyed.bounces(pages, timeout=standin.BOUNCE_TIMEOUT)


@query
def stream_bounce_detail(spark, d):
    return run_to_table(spark, _bounced(spark, d), "bounce").selectExpr(
        "cast(value as bigint) as event_id", "mid", "ts"
    )


@query
def stream_order_wide(spark, d):
    return read_folders(spark, ORDER_WIDE, _order_wide(spark, d))


@query
def stream_payment_wide(spark, d):
    orders_wide = _order_wide(spark, d)
    paid = _payment_wide(spark, d, orders_wide)
    _remove(spark, orders_wide)
    return read_folders(spark, PAYMENT_WIDE, paid)


@query
def stream_page_stats(spark, d):
    views = with_far_row(events.page_views(_pages(spark, d)), ts=FAR_MS)
    return run_to_table(spark, stats.visitor_stats(views, standin.HOUR), "page-stats")


@query
def stream_visitor_stats(spark, d):
    """Page views, unique visits and bounces, the latter two as tables of their jobs.

    Unique visits come from the stored form, which keeps the first by time; the
    running form keeps the first to arrive.
    """
    stored = standin.page_log(table(spark, d, "events"))
    visited = stored_visits.unique_visits(stored, tiebreak=("event_id",))
    bounced = run_to_table(spark, _bounced(spark, d), "bounce").selectExpr(
        "cast(value as bigint) as event_id"
    )
    unified = events.visitor_events(
        _pages(spark, d),
        stored_stream(spark, visited, "unique-visit"),
        stored_stream(spark, stored.join(bounced, "event_id"), "bounce"),
    )
    counted = stats.visitor_stats(with_far_row(unified, ts=FAR_MS), standin.HOUR)
    return run_to_table(spark, counted, "visitor-stats")


@query
def stream_product_stats(spark, d):
    """All seven inputs; orders and payments are tables of their jobs."""
    source = stream_table(spark, d, "events")
    orders_wide = _order_wide(spark, d)
    paid = _payment_wide(spark, d, orders_wide)
    unified = events.product_events(
        standin.page_log(source),
        standin.favor_info(source),
        _order_wide_topic(spark, orders_wide),
        read_folders(spark, PAYMENT_WIDE, paid, as_stream=True),
        standin.refund_info(stream_table(spark, d, "lineitem")),
        standin.cart_info(source),
        standin.comment_info(source),
    )

    def measured(share, shares):
        far = with_far_row(in_share(unified, "sku_id", share, shares), ts=FAR_MS)
        return stats.product_measures(far, standin.DAY).selectExpr(*PRODUCT_COLUMNS)

    counted = run_by_shares(spark, d, ("events", "lineitem"), measured, "product-stats")
    _remove(spark, [*orders_wide, *paid])
    return read_folders(spark, measured(0, 1).schema, counted)


@query
def stream_province_stats(spark, d):
    located = joins.enrich(
        _order_wide_topic(spark, _order_wide(spark, d)),
        standin.dim_province(table(spark, d, "nation")),
        "province_id",
        {
            "province_name": "name",
            "province_area_code": "area_code",
            "province_iso_code": "iso_code",
            "province_3166_2_code": "iso_3166_2",
        },
    )
    located = with_far_row(located, create_time=FAR_TEXT)
    counted = stats.province_stats(located, standin.DAY).drop("ts")
    return run_to_table(spark, counted, "province-stats")


@query
def stream_keyword_stats(spark, d):
    pages = standin.search_pages(
        stream_table(spark, d, "documents"), stream_table(spark, d, "events")
    )
    far = datetime.fromtimestamp(FAR_MS / 1000, UTC)
    pages = with_far_row(pages, page={"item_type": "keyword", "item": "far"}, ts=FAR_MS, rt=far)
    counted = stats.keyword_stats(pages, standin.HOUR).drop("ts")
    return run_to_table(spark, counted, "keyword-stats")


# Splitting and routing


def _routed(spark, d):
    changes = cdc.normalise(
        standin.raw_changes(stream_table(spark, d, "events"), stream_table(spark, d, "orders"))
    )
    return routing.route(cdc.drop_deletes(changes), standin.routes(spark))


@query
def stream_log_split(spark, d):
    lines = standin.raw_log(
        stream_table(spark, d, "events"), stream_table(spark, d, "conversations")
    )
    return topic_counts(run_to_table(spark, jobs.split_log(lines), "log-split"))


@query
def stream_log_split_lines(spark, d):
    lines = standin.raw_log(
        stream_table(spark, d, "events"), stream_table(spark, d, "conversations")
    )
    return line_fields(run_to_table(spark, jobs.split_log(lines), "log-split"))


@query
def stream_route_facts(spark, d):
    return run_to_table(spark, routing.facts(_routed(spark, d)), "facts")


@query
def stream_visit_expiry(spark, d):
    """The devices still in the state of the daily visits after the earlier ones' has expired.

    The pages come in two halves by time, the second when the state of the first is too old.
    """
    path, out, checkpoint = (fresh_dir(spark, f"expiry-{n}") for n in ("in", "out", "checkpoint"))
    pages = standin.page_log(table(spark, d, "events")).selectExpr("*", "cast(event_id as string) as value")
    low, high = pages.agg(F.min("ts"), F.max("ts")).first()
    middle = ((low or 0) + (high or 0)) // 2
    for half in (f"ts <= {middle}", f"ts > {middle}"):
        pages.where(half).write.mode("append").parquet(path)
        stream = spark.readStream.schema(pages.schema).parquet(path)
        kept = visits.unique_visits_with_expiry(stream, ttl="2 seconds")
        # In processing time a run without new input would never be the last.
        with session_settings(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}):
            start_table(kept, out, checkpoint, every=None).awaitTermination()
        time.sleep(3)
    return visits.stored_state(spark, checkpoint, "last").selectExpr(
        "user_map_key.mid as mid", "user_map_value.value.day as last_day"
    )


@query
def stream_order_sketches(spark, d):
    """Different orders per quarter, merged from the sketches of days and products, and whether
    they are near the exact count and their size is bounded."""
    details = events.orders(standin.order_detail(stream_table(spark, d, "lineitem")))
    far = with_far_row(details, ts=FAR_MS, sku_id=-1, order_id=-1)
    with session_settings(spark, BOUNDED_MEMORY):
        daily = run_over(spark, d, ("lineitem",), stats.order_sketches(far, standin.DAY), "order-sketches")
    quarter = F.date_format(F.date_trunc("quarter", "stt"), "yyyy-MM-dd").alias("quarter")
    merged = stats.merged_orders(daily, quarter)
    stored = events.orders(standin.order_detail(table(spark, d, "lineitem")))
    of_row = F.date_format(F.date_trunc("quarter", F.timestamp_millis("ts")), "yyyy-MM-dd").alias("quarter")
    exact = stored.groupBy(of_row).agg(F.count_distinct("order_id").alias("exact"))
    near = F.abs(F.col("order_ct") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged.join(exact, "quarter").select(
        "quarter", F.col("exact").alias("order_ct"), near.alias("near"),
        (F.octet_length("orders") <= 4200).alias("bounded"),
    )


@query
def stream_cdc_changelog(spark, d):
    """The changelog of the users, folded. It comes in two runs, the later half of the changes
    first, so that many changes come after newer ones of their row."""
    path, out, checkpoint = (fresh_dir(spark, f"changelog-{n}") for n in ("in", "out", "checkpoint"))
    stored = standin.raw_changes(table(spark, d, "events"), table(spark, d, "orders"))
    half = stored.agg(F.max("seq")).first()[0]
    half = (half or 0) // 2
    for part in (f"seq > {half}", f"seq <= {half} or seq % 3 = 0"):  # some come twice
        cdc.normalise(stored).where(part).write.mode("append").parquet(path)
        users = spark.readStream.schema(CHANGE).parquet(path).where("tableName = 'user_info'")
        start_table(changelog.changelog(users), out, checkpoint, every=None).awaitTermination()
    rows = spark.read.schema("kind string, tableName string, key string, seq bigint, after map<string,string>")
    users = struct("id bigint, name string, level int, phone string")
    return cdc.typed_rows(changelog.fold_changelog(rows.parquet(out)), users)


@query
def stream_route_early_facts(spark, d):
    """Config and changes as streams; all changes come before their config."""
    log, settings, out, checkpoint = (
        fresh_dir(spark, f"early-{n}") for n in ("log", "config", "out", "checkpoint")
    )
    routes = standin.routes(spark)
    image = F.create_map(*[x for c in routes.columns for x in (F.lit(c), F.col(c))])
    routes = routes.select(image.alias("after"), F.lit(1).cast("bigint").alias("seq"))
    changes = cdc.normalise(standin.raw_changes(table(spark, d, "events"), table(spark, d, "orders")))
    changes.write.parquet(log)
    for rows in (routes.where("false"), routes):
        rows.write.mode("append").parquet(settings)
        routed = config.route_with_state(
            cdc.drop_deletes(spark.readStream.schema(changes.schema).parquet(log)),
            spark.readStream.schema(routes.schema).parquet(settings),
        )
        start_table(routing.facts(routed), out, checkpoint, every=None).awaitTermination()
    return spark.read.schema("topic string, value string").parquet(out)


@query
def stream_log_intake(spark, d):
    """Page views of log files that grow and are rolled while a stream reads them.

    The stream is stopped and restarted after each step: a file that ends within a line, the
    rest of its day, the roll with the start of the next file, and the rest of that one.
    """
    folder, out, checkpoint = (fresh_dir(spark, f"intake-{n}") for n in ("log", "out", "checkpoint"))
    logs_ = standin.log_files(table(spark, d, "events"), fresh_dir(spark, "intake-days"))
    for step in range(4):
        standin.next_log_state(logs_, folder, step)
        start_table(growing.read_growing(spark, folder), out, checkpoint, every=None).awaitTermination()
    lines = spark.read.schema("value string").parquet(out)
    return parse.page_view(lines).select(
        F.col("common")["mid"].alias("mid"),
        F.col("page")["page_id"].alias("page_id"),
        F.col("page")["item"].alias("item"),
        "ts",
        times.ts_to_text("rt").alias("rt"),
    )


@query
def stream_dim_upsert(spark, d):
    store = DimensionStore(spark, fresh_dir(spark, "dim"))
    start_batches(
        routing.dimensions(_routed(spark, d)),
        store.append,
        fresh_dir(spark, "dim-checkpoint"),
        every=None,
    ).awaitTermination()
    return store.read("DIM_USER_INFO", ["id", "name", "level"])

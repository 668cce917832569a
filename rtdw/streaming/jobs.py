"""The jobs of the warehouse over one folder of topics and tables.

Every ``start_*`` returns a running query. ``every`` is the trigger interval;
``None`` processes the input there is and stops. A job reads the topics of the
jobs before it, so each can be stopped and restarted by itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rtdw import schemas
from rtdw.functions.times import duration_ms
from rtdw.operators import cdc, events, logs, parse, routing, stats, wide
from rtdw.sinks import olap, topics as topic_sink
from rtdw.sinks.dims import DimensionStore, create_tables, table_columns
from rtdw.sinks.keyed_dims import KeyedDimension
from rtdw.sources import changes, growing, handover, topics
from rtdw.sources.dims import typed
from rtdw.session import session_settings
from rtdw.streaming import changelog, config, keyed, visits
from rtdw.streaming.run import start_batches, start_table

# Where each job writes, and the dimension tables by role.
APP_LOG = "ods_base_log"
DB_LOG = "ods_base_db"
CONFIG_LOG = "table_process"
LOGS = "dwd_log"
FACTS = "dwd_fact"
UNIQUE_VISIT = "dwm_unique_visit"
BOUNCE = "dwm_user_jump_detail"
ORDER_WIDE = "dwm_order_wide"
PAYMENT_WIDE = "dwm_payment_wide"
VISITOR_STATS = "visitor_stats"
PRODUCT_STATS = "product_stats"
PROVINCE_STATS = "province_stats"
KEYWORD_STATS = "keyword_stats"
GMV_BY_DAY = "gmv_by_day"
DIMENSIONS = {
    "user": ("DIM_USER_INFO", schemas.DIM_USER),
    "province": ("DIM_BASE_PROVINCE", schemas.DIM_PROVINCE),
    "sku": ("DIM_SKU_INFO", schemas.DIM_SKU),
    "spu": ("DIM_SPU_INFO", schemas.DIM_SPU),
    "trademark": ("DIM_BASE_TRADEMARK", schemas.DIM_TRADEMARK),
    "category3": ("DIM_BASE_CATEGORY3", schemas.DIM_CATEGORY3),
}


@dataclass(frozen=True)
class Warehouse:
    """A session and the folder, shared by all executors, that holds all topics and tables.

    With ``servers`` the topics live in Kafka instead; dimensions, config and
    statistics stay in the folder. ``rate`` bounds what a micro-batch takes of a
    topic, in files, batches or Kafka records, so a backlog is worked off in steps. With
    ``growing_logs`` the application log's files may be appended to and rolled. With
    ``keyed_dims`` dimensions are kept in buckets of their keys, for tables so large that
    folding them as a whole takes too long.
    """

    spark: SparkSession
    root: str
    every: str | None = "5 seconds"
    servers: str | None = None
    starting: str = "latest"
    database: str | None = None
    rate: int | None = None
    growing_logs: bool = False
    keyed_dims: bool = False

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    @property
    def dims(self) -> DimensionStore:
        return DimensionStore(self.spark, self.path("dim"))

    def keyed_dimension(self, table: str, columns: list[str], pk: str = "id") -> KeyedDimension:
        return KeyedDimension(self.spark, self.path(f"dim_keyed/{table}"), columns, pk)

    def dimension(self, role: str) -> DataFrame:
        """The current rows of a dimension; read anew by every micro-batch that asks."""
        table, schema = DIMENSIONS[role]
        if self.keyed_dims:
            return typed(self.keyed_dimension(table, schema.fieldNames()).read(), schema)
        return typed(self.dims.read(table, schema.fieldNames()), schema)

    def dimensions(self, *roles: str) -> dict[str, DataFrame]:
        return {role: self.dimension(role) for role in roles or DIMENSIONS}

    def config(self) -> DataFrame:
        """The routing config as of now."""
        log = changes.stored_changes(self.spark, self.path(CONFIG_LOG))
        return routing.latest_config(routing.config_rows(log), keep_order=True)

    def lines(self, topic: str) -> DataFrame:
        """A topic as a stream of text."""
        if self.servers:
            return topics.read_kafka(
                self.spark, self.servers, topic, self.starting, rate=self.rate
            )
        if topic in (logs.PAGE_TOPIC, logs.START_TOPIC, logs.DISPLAY_TOPIC):
            return topics.read_topic(self.spark, self.path(LOGS), topic, self.rate)
        if topic == ORDER_WIDE:
            return handover.read_delivered(self.spark, self.path(topic), rate=self.rate)
        if topic.startswith("dwd_"):
            return handover.read_delivered(self.spark, self.path(FACTS), topic, self.rate)
        if topic == APP_LOG and self.growing_logs:
            return growing.read_growing(self.spark, self.path(topic))
        return topics.read_folder(self.spark, self.path(topic), self.rate)

    def start_sending(self, rows: DataFrame, name: str):
        """Start writing a stream to the topic ``name``, or to the topic each row names."""
        if self.servers:
            topic = None if "topic" in rows.columns else name
            return topic_sink.start_kafka(
                rows, self.servers, self.checkpoint(name), topic, self.every
            )
        return topic_sink.start_folder(rows, self.path(name), self.checkpoint(name), self.every)

    def send_batch(self, rows: DataFrame, name: str, batch_id: int) -> None:
        """Write one micro-batch likewise."""
        if self.servers:
            topic = None if "topic" in rows.columns else name
            topic_sink.send_batch(rows, self.servers, topic)
        else:
            handover.deliver_batch(rows, self.path(name), batch_id)

    def pages(self) -> DataFrame:
        """The page log, with each record's text."""
        return _pages(self.lines(logs.PAGE_TOPIC))

    def fact(self, topic: str, schema: T.StructType) -> DataFrame:
        return topics.records(self.lines(topic), schema)

    def orders_wide(self) -> DataFrame:
        return self.fact(ORDER_WIDE, schemas.ORDER_WIDE)

    def payments_wide(self) -> DataFrame:
        return self.fact(PAYMENT_WIDE, schemas.PAYMENT_WIDE)


def _pages(lines: DataFrame) -> DataFrame:
    record = F.from_json("value", schemas.PAGE_LOG, {"mode": "FAILFAST"})
    return lines.select("value", F.explode(F.array(record)).alias("r")).select("value", "r.*")


def split_log(lines: DataFrame) -> DataFrame:
    """Application log lines to rows (topic, value), with the new-visitor flag corrected."""
    log = logs.read_log(lines)
    flagged = "not dirty and is_new <=> '1'"
    fixed = keyed.first_flags(
        log.where(flagged).select("value", "line_id", "mid", "is_new", "ts"),
        order=("ts", "line_id"),
    ).select(logs.with_flag(F.col("value"), F.col("is_new")).alias("value"))
    return logs.split_topics(log.where(f"not ({flagged})").unionByName(logs.read_log(fixed)))


def start_log_split(w: Warehouse):
    """Application log to page, start, display and dirty topics."""
    return w.start_sending(split_log(w.lines(APP_LOG)), LOGS)


def apply_dimensions(w: Warehouse, rows: DataFrame, batch_id: int, vacuum: bool) -> None:
    """One batch of routed dimension changes into the bucketed tables, those with changes only."""
    changed = {row["sink_table"] for row in rows.select("sink_table").distinct().collect()}
    for table in table_columns(w.config()).where(F.col("sink_table").isin(sorted(changed))).collect():
        store = w.keyed_dimension(table["sink_table"], table["columns"], table["sink_pk"])
        store.apply(rows.where(F.col("sink_table") == table["sink_table"]), batch_id)
        if vacuum:
            store.vacuum()


def compact_dimensions(w: Warehouse, upto: int) -> None:
    """Fold the dimension changes up to a batch into a new base, for all tables of the config.

    The config has a few rows per source table, so listing its tables is cheap.
    """
    tables = table_columns(w.config()).collect()
    for table in tables:
        w.dims.compact(table["sink_table"], sorted(table["columns"]), upto, table["sink_pk"])
    w.dims.vacuum([table["sink_table"] for table in tables])


def start_db_routing(w: Warehouse, compact_every: int = 100, early: bool = False, wait: str | None = None):
    """Change records to fact topics and the dimension store, by the config of the moment.

    Every ``compact_every`` batches the dimension changes are folded, so that a
    reader never folds more than that many batches. With a ``database`` a new
    config row also creates its dimension table there. Bucketed dimensions
    (``w.keyed_dims``) are up to date after each batch; old versions go as often.

    With ``early`` the config is a stream too, kept as state: records that come before their
    config wait for it (at most ``wait``) instead of being left out.
    """
    log = changes.parse_changes(w.lines(DB_LOG))
    if early:
        config_log = changes.parse_changes(topics.read_folder(w.spark, w.path(CONFIG_LOG), w.rate))
        log = config.route_with_state(cdc.drop_deletes(log), config_log, wait=wait)

    def process(batch: DataFrame, batch_id: int) -> None:
        known, last = w.config(), batch_id % compact_every == compact_every - 1
        if w.database:
            create_tables(w.spark, known, w.database)
        routed = (batch if early else routing.route(cdc.drop_deletes(batch), known)).persist()
        try:
            w.send_batch(routing.facts(routed), FACTS, batch_id)
            if w.keyed_dims:
                apply_dimensions(w, routing.dimensions(routed), batch_id, vacuum=last)
            else:
                w.dims.append(routing.dimensions(routed), batch_id)
        finally:
            routed.unpersist()
        if last and not w.keyed_dims:
            compact_dimensions(w, batch_id)

    # What expires by the clock would keep a run over the input there is from ending.
    clock = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"} if wait and not w.every else {}
    with session_settings(w.spark, clock):
        return start_batches(log, process, w.checkpoint(FACTS), w.every)


def start_changelog(w: Warehouse, name: str, pk: str = "id"):
    """A table's changes as rows to add and to retract, appended to a table."""
    log = changes.parse_changes(w.lines(DB_LOG)).where(F.col("tableName") == name)
    path = f"changelog/{name}"
    return start_table(changelog.changelog(log, pk), w.path(path), w.checkpoint(path), every=w.every)


def start_unique_visit(w: Warehouse):
    """Days are those of the session's time zone, as in the stored form."""
    kept = visits.unique_visits(w.pages()).select("value")
    return w.start_sending(kept, UNIQUE_VISIT)


def start_bounce(w: Warehouse, timeout: str = "10 seconds"):
    pages = w.pages().selectExpr(
        "common.mid as mid", "ts", "page.last_page_id is null as entry",
        "hex(xxhash64(value)) as tie", "value",
    )
    bounced = keyed.bounces(pages, timeout).select("value")
    return w.start_sending(bounced, BOUNCE)


def start_order_wide(w: Warehouse, how: str = "inner"):
    """Orders joined with details on the stream; dimensions are added per micro-batch."""
    joined = wide.order_wide(
        w.fact("dwd_order_info", schemas.ORDER_INFO),
        w.fact("dwd_order_detail", schemas.ORDER_DETAIL),
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        filled = wide.add_dimensions(batch, w.dimensions(), how=how)
        w.send_batch(topic_sink.as_text(filled), ORDER_WIDE, batch_id)

    return start_batches(joined, process, w.checkpoint(ORDER_WIDE), w.every)


def start_payment_wide(w: Warehouse):
    joined = wide.payment_wide(
        w.fact("dwd_payment_info", schemas.PAYMENT_INFO), w.orders_wide()
    )
    return w.start_sending(topic_sink.as_text(joined), PAYMENT_WIDE)


def chain_lateness(w: Warehouse, layers: int, base: int) -> str:
    """How far behind the fastest input the rows of the longest chain of jobs may come.

    ``base`` seconds of the rules themselves, and for each layer two trigger
    intervals: one to pick its input up and one to close on the watermark.
    """
    late = 1000 * base + 2 * layers * duration_ms(w.every or "0 seconds")
    return f"{late} milliseconds" if late % 1000 else f"{late // 1000} seconds"


def start_visitor_stats(
    w: Warehouse, width: str = "10 seconds", lateness: str | None = None
):
    """Bounces come one job later than pages: after their timeout of 10 s, the 2 s of that
    job and the 4 s of this one, and the triggers of both."""
    lateness = lateness or chain_lateness(w, 2, 16)
    unified = events.visitor_events(
        w.pages(),
        _pages(w.lines(UNIQUE_VISIT)),
        _pages(w.lines(BOUNCE)),
    )
    return start_table(
        stats.visitor_stats(unified, width, lateness),
        w.path(VISITOR_STATS),
        w.checkpoint(VISITOR_STATS),
        every=w.every,
    )


def start_product_stats(
    w: Warehouse, width: str = "10 seconds", how: str = "inner", lateness: str | None = None
):
    """Seven topics to windowed measures; dimensions are added to the finished windows.

    Payments come through routing, order wide and payment wide, so rows may be as
    late as the triggers of these jobs and this one, and the 2 s of each join.
    """
    lateness = lateness or chain_lateness(w, 4, 6)
    unified = events.product_events(
        w.pages(),
        w.fact("dwd_favor_info", schemas.FAVOR_INFO),
        w.orders_wide(),
        w.payments_wide(),
        w.fact("dwd_order_refund_info", schemas.REFUND_INFO),
        w.fact("dwd_cart_info", schemas.CART_INFO),
        w.fact("dwd_comment_info", schemas.COMMENT_INFO),
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        dims = w.dimensions("sku", "spu", "trademark", "category3")
        filled = stats.product_dimensions(batch, dims, how)
        filled = filled.persist()
        try:
            olap.write_parquet(filled, schemas.PRODUCT_STATS, w.path(PRODUCT_STATS), batch_id)
            olap.write_by_day(stats.gmv_by_day(filled), w.path(GMV_BY_DAY), batch_id)
        finally:
            filled.unpersist()

    measured = stats.product_measures(unified, width, lateness)
    return start_batches(measured, process, w.checkpoint(PRODUCT_STATS), w.every)


def start_province_stats(w: Warehouse, width: str = "10 seconds"):
    return start_table(
        stats.province_stats(w.orders_wide(), width),
        w.path(PROVINCE_STATS),
        w.checkpoint(PROVINCE_STATS),
        every=w.every,
    )


def start_keyword_stats(w: Warehouse, width: str = "10 seconds"):
    pages = parse.page_view(w.lines(logs.PAGE_TOPIC))
    return start_table(
        stats.keyword_stats(pages, width),
        w.path(KEYWORD_STATS),
        w.checkpoint(KEYWORD_STATS),
        every=w.every,
    )


def stored_stats(w: Warehouse, name: str, schema: T.StructType) -> DataFrame:
    """A statistics table as written so far."""
    return w.spark.read.schema(schema).parquet(w.path(name))


def gmv(w: Warehouse, day: date | None = None) -> DataFrame:
    """Total order amount of a day (default today), from the roll-up by day.

    Only that day's partition is listed and read: one row per micro-batch that closed windows
    of the day.
    """
    rows = olap.read_by_day(w.spark, w.path(GMV_BY_DAY), "gmv decimal(26,2)")
    wanted = F.lit(int(f"{day:%Y%m%d}")) if day else F.date_format(F.current_date(), "yyyyMMdd").cast("int")
    return rows.where(F.col("day") == wanted).agg(F.sum("gmv").cast(schemas.MONEY_SUM).alias("gmv"))

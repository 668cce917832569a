"""Order wide and payment wide tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from rtdw.functions.times import age_years, text_to_ts, time_parts
from rtdw.operators.joins import PRODUCT_NAMES, enrich, interval_join, product_dimension
from rtdw.schemas import ORDER_WIDE, PAYMENT_WIDE

# Which side of the order/detail join each wide column comes from.
FROM_ORDER = (
    "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "create_time",
    "create_date", "create_hour",
)
FROM_DETAIL = (
    "sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount",
    "split_coupon_amount", "split_total_amount",
)
# A payment's own values win over the order's of the same name.
FROM_PAYMENT = (
    "subject", "payment_type", "callback_time", "order_id", "user_id", "total_amount",
)
# Columns the first-non-null merge fills from the other record.
MERGED = (
    "order_status", "create_time", "create_date", "coupon_reduce_amount",
    "activity_reduce_amount", "original_total_amount", "feight_fee", "total_amount",
    "user_id", "sku_id", "sku_name", "order_price", "sku_num",
)


def as_record(df: DataFrame, schema: T.StructType, source: Mapping[str, str]) -> DataFrame:
    """The columns of a record type from SQL expressions; those without one are null."""
    return df.selectExpr(
        *[
            f"cast({source.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}"
            for f in schema
        ]
    )


def order_times(orders: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Add create_date, create_hour and create_ts."""
    return orders.withColumns(time_parts(create_time))


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    lower: str = "-2 seconds",
    upper: str = "2 seconds",
    lateness: str = "2 seconds",
) -> DataFrame:
    """Orders with their details created within the interval; dimensions still null.

    Works on stored tables and on streams; ``lateness`` is the watermark of the
    latter.
    """
    left = order_times(orders).withColumn("__time", text_to_ts("create_time"))
    right = details.withColumn("__time", text_to_ts("create_time"))
    if left.isStreaming:
        left = left.withWatermark("__time", lateness)
        right = right.withWatermark("__time", lateness)
    joined = interval_join(left, right, "id", "order_id", "__time", "__time", lower, upper)
    source = {
        "detail_id": "r.id",
        "order_id": "l.id",
        **{c: f"l.{c}" for c in FROM_ORDER},
        **{c: f"r.{c}" for c in FROM_DETAIL},
    }
    return as_record(joined, ORDER_WIDE, source)


def add_dimensions(
    wide: DataFrame, dims: Mapping[str, DataFrame], as_of: str | None = None, how: str = "inner"
) -> DataFrame:
    """Fill the dimension columns of an order wide table.

    ``dims`` holds user, province, sku, spu, trademark and category3. The four
    product dimensions are joined with each other first, so the facts are
    shuffled for three lookups, not for six.
    """
    steps = (
        ("user", "user_id", {
            "user_age": age_years("birthday", as_of), "user_gender": "gender"}),
        ("province", "province_id", {
            "province_name": "name", "province_area_code": "area_code",
            "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"}),
        ("product", "sku_id", {c: c for c in PRODUCT_NAMES}),
    )
    dims = {**dims, "product": product_dimension(dims, how)}
    for dim, key, columns in steps:
        wide = enrich(wide, dims[dim], key, columns, how=how)
    return wide


def payment_wide(
    payments: DataFrame,
    orders_wide: DataFrame,
    lower: str = "-15 minutes",
    upper: str = "0 seconds",
    lateness: str = "0 seconds",
) -> DataFrame:
    """Payments with the order wide rows created in the interval before them."""
    left = payments.withColumn("__time", text_to_ts("create_time"))
    right = orders_wide.withColumn("__time", text_to_ts("create_time"))
    if left.isStreaming:
        left = left.withWatermark("__time", lateness)
        right = right.withWatermark("__time", lateness)
    joined = interval_join(
        left, right, "order_id", "order_id", "__time", "__time", lower, upper
    )
    source = {
        **{c: f"r.{c}" for c in orders_wide.columns},
        **{c: f"l.{c}" for c in FROM_PAYMENT},
        "payment_id": "l.id",
        "payment_create_time": "l.create_time",
        "order_create_time": "r.create_time",
    }
    return as_record(joined, PAYMENT_WIDE, source)


def merge_wide(this: DataFrame, other: DataFrame, key: str = "detail_id") -> DataFrame:
    """First non-null value of two wide tables, row by row of equal key.

    Columns outside the merge list keep this side's value, and so do the three
    split amounts, which the merge rule takes from one side only.
    """
    a, b = this.alias("a"), other.alias("b")
    merged = {c: f"coalesce(a.{c}, b.{c})" for c in MERGED if c in other.columns}
    return a.join(b, F.expr(f"a.{key} = b.{key}"), "left").selectExpr(
        *[f"{merged.get(c, f'a.{c}')} as {c}" for c in this.columns]
    )


def province_row(wide: DataFrame) -> DataFrame:
    """Each order wide row as a province record of its own, counting one order."""
    return wide.selectExpr(
        "province_id",
        "province_name",
        "province_area_code",
        "province_iso_code",
        "province_3166_2_code",
        "split_total_amount as order_amount",
        "cast(1 as bigint) as order_count",
    )

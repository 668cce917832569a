"""The facts of the seven product streams and three visitor streams in one shape each."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rtdw.functions.codes import APPRAISE_GOOD
from rtdw.schemas import struct

# Measures default to 0. The three ids mark which order a row counts for.
PRODUCT_EVENT = struct(
    """
    sku_id bigint, display_ct bigint, click_ct bigint, favor_ct bigint, cart_ct bigint,
    order_sku_num bigint, order_amount decimal(16,2), payment_amount decimal(16,2),
    refund_amount decimal(16,2), comment_ct bigint, good_comment_ct bigint,
    order_id bigint, paid_order_id bigint, refund_order_id bigint, ts bigint
    """
)
NO_DEFAULT = ("sku_id", "order_id", "paid_order_id", "refund_order_id", "ts")
VISITOR_KEYS = ("vc", "ch", "ar", "is_new")
VISITOR_COUNTS = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")

# How a page tells a product click and a product display.
DETAIL_PAGE = "good_detail"
SKU_ITEM = "sku_id"

CREATED = "unix_millis(cast(create_time as timestamp))"


def product_event(df: DataFrame, **given: str) -> DataFrame:
    """Rows in the unified product shape, from SQL expressions.

    A measure not given, or null, is 0; an id not given is null.
    """
    columns = []
    for f in PRODUCT_EVENT:
        kind = f.dataType.simpleString()
        value = f"cast({given.get(f.name, 'null')} as {kind})"
        if f.name not in NO_DEFAULT:
            zero = f"cast(0 as {kind})"
            value = f"coalesce({value}, {zero})" if f.name in given else zero
        columns.append(f"{value} as {f.name}")
    return df.selectExpr(*columns)


def clicks_and_displays(pages: DataFrame) -> DataFrame:
    """A click per product detail page and a display per shown product, in one pass."""
    shown = f"""
        transform(
          filter(coalesce(displays, array()), d -> d.item_type = '{SKU_ITEM}'),
          d -> struct(d.item as item, 0 as click, 1 as display))
        """
    hits = f"""
        case when page.page_id = '{DETAIL_PAGE}' and page.item_type = '{SKU_ITEM}'
             then concat(array(struct(page.item as item, 1 as click, 0 as display)), {shown})
             else {shown} end
        """
    rows = pages.selectExpr("ts", f"inline({hits})")
    return product_event(rows, sku_id="item", click_ct="click", display_ct="display", ts="ts")


def favors(favor_info: DataFrame) -> DataFrame:
    return product_event(favor_info, sku_id="sku_id", favor_ct="1", ts=CREATED)


def carts(cart_info: DataFrame) -> DataFrame:
    return product_event(cart_info, sku_id="sku_id", cart_ct="1", ts=CREATED)


def orders(order_wide: DataFrame) -> DataFrame:
    return product_event(
        order_wide,
        sku_id="sku_id",
        order_id="order_id",
        order_sku_num="sku_num",
        order_amount="split_total_amount",
        ts=CREATED,
    )


def paid(payment_wide: DataFrame) -> DataFrame:
    return product_event(
        payment_wide,
        sku_id="sku_id",
        paid_order_id="order_id",
        payment_amount="split_total_amount",
        ts=CREATED.replace("create_time", "payment_create_time"),
    )


def refunds(refund_info: DataFrame) -> DataFrame:
    return product_event(
        refund_info,
        sku_id="sku_id",
        refund_order_id="order_id",
        refund_amount="refund_amount",
        ts=CREATED,
    )


def comments(comment_info: DataFrame) -> DataFrame:
    return product_event(
        comment_info,
        sku_id="sku_id",
        comment_ct="1",
        good_comment_ct=f"if(appraise = '{APPRAISE_GOOD}', 1, 0)",
        ts=CREATED,
    )


def product_events(
    pages: DataFrame,
    favor_info: DataFrame,
    order_wide: DataFrame,
    payment_wide: DataFrame,
    refund_info: DataFrame,
    cart_info: DataFrame,
    comment_info: DataFrame,
) -> DataFrame:
    """All seven streams, union all."""
    return (
        clicks_and_displays(pages)
        .unionByName(favors(favor_info))
        .unionByName(orders(order_wide))
        .unionByName(paid(payment_wide))
        .unionByName(refunds(refund_info))
        .unionByName(carts(cart_info))
        .unionByName(comments(comment_info))
    )


def visitor_event(df: DataFrame, **given: str) -> DataFrame:
    """Rows in the unified visitor shape; counts not given are 0."""
    return df.selectExpr(
        *[f"common.{key} as {key}" for key in VISITOR_KEYS],
        *[
            f"cast(coalesce({given.get(name, '0')}, 0) as bigint) as {name}"
            for name in VISITOR_COUNTS
        ],
        "ts",
    )


def page_views(pages: DataFrame) -> DataFrame:
    """A page view each; an entry page also starts a session."""
    return visitor_event(
        pages,
        pv_ct="1",
        sv_ct="if(page.last_page_id is null, 1, 0)",
        dur_sum="page.during_time",
    )


def visitor_events(pages: DataFrame, visits: DataFrame, bounced: DataFrame) -> DataFrame:
    """Page views, unique visits and bounces, union all."""
    return (
        page_views(pages)
        .unionByName(visitor_event(visits, uv_ct="1"))
        .unionByName(visitor_event(bounced, uj_ct="1"))
    )

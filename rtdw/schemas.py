"""Record types of the warehouse and the column order of its outputs."""

from __future__ import annotations

import re

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)
MONEY_SUM = T.DecimalType(26, 2)


TEXT_MAP = T.MapType(T.StringType(), T.StringType())
TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(16,2)": MONEY,
    "decimal(26,2)": MONEY_SUM,
    "map<string,string>": TEXT_MAP,
}
_FIELD = re.compile(r"\s*(\w+)\s+([^\s,(<]+(?:[(<][^)>]*[)>])?)\s*(?:,|$)")


def struct(columns: str) -> T.StructType:
    """A record type from ``name type, name type``; unlike Spark's own it needs no session."""
    fields = _FIELD.findall(columns)
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


# Behaviour log. Nested objects stay maps where the jobs only pick elements.
PAGE_VIEW = struct("common map<string,string>, page map<string,string>, ts bigint")
DISPLAY = struct("item string, item_type string")
PAGE_LOG = T.StructType(
    [
        T.StructField(
            "common", struct("mid string, is_new string, vc string, ch string, ar string")
        ),
        T.StructField(
            "page",
            struct(
                "page_id string, last_page_id string, item string, item_type string, "
                "during_time bigint"
            ),
        ),
        T.StructField("displays", T.ArrayType(DISPLAY)),
        T.StructField("ts", T.LongType()),
    ]
)

# Change records. ``seq`` orders the changes of one row (log offset or source
# time); without it "newest" would mean arrival order.
CHANGE = struct(
    """
    database string, tableName string, before map<string,string>,
    after map<string,string>, type string, seq bigint
    """
)
RAW_CHANGE = struct(
    """
    topic string, op string, before map<string,string>, after map<string,string>, seq bigint
    """
)
TABLE_PROCESS = struct(
    """
    source_table string, operate_type string, sink_type string, sink_table string,
    sink_columns string, sink_pk string, sink_extend string
    """
)

# Facts.
ORDER_INFO = struct(
    """
    id bigint, province_id bigint, order_status string, user_id bigint,
    total_amount decimal(16,2), activity_reduce_amount decimal(16,2),
    coupon_reduce_amount decimal(16,2), original_total_amount decimal(16,2),
    feight_fee decimal(16,2), expire_time string, create_time string, operate_time string
    """
)
ORDER_DETAIL = struct(
    """
    id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2), sku_num bigint,
    sku_name string, create_time string, split_total_amount decimal(16,2),
    split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2)
    """
)
PAYMENT_INFO = struct(
    """
    id bigint, order_id bigint, user_id bigint, total_amount decimal(16,2), subject string,
    payment_type string, create_time string, callback_time string
    """
)
CART_INFO = struct("sku_id bigint, create_time string")
FAVOR_INFO = struct("sku_id bigint, create_time string")
REFUND_INFO = struct(
    "order_id bigint, sku_id bigint, refund_amount decimal(16,2), create_time string"
)
COMMENT_INFO = struct("sku_id bigint, appraise string, create_time string")

# Dimensions are stored as text; these are the types to read them as.
DIM_USER = struct("id bigint, gender string, birthday string")
DIM_PROVINCE = struct(
    "id bigint, name string, area_code string, iso_code string, iso_3166_2 string"
)
DIM_SKU = struct(
    """
    id bigint, sku_name string, price decimal(16,2), spu_id bigint, tm_id bigint,
    category3_id bigint
    """
)
DIM_SPU = struct("id bigint, spu_name string")
DIM_TRADEMARK = struct("id bigint, tm_name string")
DIM_CATEGORY3 = struct("id bigint, name string")

# Wide tables and statistics, in sink order.
ORDER_WIDE = struct(
    """
    detail_id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2),
    sku_num bigint, sku_name string, province_id bigint, order_status string, user_id bigint,
    total_amount decimal(16,2), activity_reduce_amount decimal(16,2),
    coupon_reduce_amount decimal(16,2), original_total_amount decimal(16,2),
    feight_fee decimal(16,2), split_feight_fee decimal(16,2),
    split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2),
    split_total_amount decimal(16,2),
    expire_time string, create_time string, operate_time string, create_date string,
    create_hour string,
    province_name string, province_area_code string, province_iso_code string,
    province_3166_2_code string, user_age int, user_gender string,
    spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, tm_name string,
    category3_name string
    """
)
PAYMENT_WIDE = struct(
    """
    payment_id bigint, subject string, payment_type string, payment_create_time string,
    callback_time string, detail_id bigint, order_id bigint, sku_id bigint,
    order_price decimal(16,2), sku_num bigint, sku_name string, province_id bigint,
    order_status string, user_id bigint, total_amount decimal(16,2),
    activity_reduce_amount decimal(16,2), coupon_reduce_amount decimal(16,2),
    original_total_amount decimal(16,2), feight_fee decimal(16,2),
    split_feight_fee decimal(16,2), split_activity_amount decimal(16,2),
    split_coupon_amount decimal(16,2), split_total_amount decimal(16,2),
    order_create_time string,
    province_name string, province_area_code string, province_iso_code string,
    province_3166_2_code string, user_age int, user_gender string,
    spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, tm_name string,
    category3_name string
    """
)
VISITOR_STATS = struct(
    """
    stt string, edt string, vc string, ch string, ar string, is_new string, uv_ct bigint,
    pv_ct bigint, sv_ct bigint, uj_ct bigint, dur_sum bigint, ts bigint
    """
)
PRODUCT_STATS = struct(
    """
    stt string, edt string, sku_id bigint, sku_name string, sku_price decimal(16,2),
    spu_id bigint, spu_name string, tm_id bigint, tm_name string, category3_id bigint,
    category3_name string, display_ct bigint, click_ct bigint, favor_ct bigint, cart_ct bigint,
    order_sku_num bigint, order_amount decimal(26,2), order_ct bigint,
    payment_amount decimal(26,2), paid_order_ct bigint, refund_order_ct bigint,
    refund_amount decimal(26,2), comment_ct bigint, good_comment_ct bigint, ts bigint
    """
)
PROVINCE_STATS = struct(
    """
    stt string, edt string, province_id bigint, province_name string,
    province_area_code string, province_iso_code string, province_3166_2_code string,
    order_amount decimal(26,2), order_count bigint, ts bigint
    """
)
KEYWORD_STATS = struct(
    "keyword string, ct bigint, source string, stt string, edt string, ts bigint"
)

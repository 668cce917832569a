"""The same results as the queries, in SQL on the sample tables."""

from __future__ import annotations

from rtdw.plans.standin import FIRST_DOCUMENT_MS, HAN_LETTERS

SECOND = "'%Y-%m-%d %H:%M:%S'"
HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def _window(ms: str, width: int) -> str:
    start = f"(({ms}) // {width}) * {width}"
    return (
        f"strftime(make_timestamp({start} * 1000), {SECOND}) AS stt, "
        f"strftime(make_timestamp(({start} + {width}) * 1000), {SECOND}) AS edt"
    )


def _millis(text: str) -> str:
    return f"epoch_ms(strptime({text}, {SECOND}))"


LOG = """
log AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts, event_type AS kind,
         CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN event_type IN ('signup', 'view') THEN '1' ELSE '0' END AS is_new,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) < 50
              THEN 'v1' ELSE 'v2' END AS vc,
         CASE WHEN value >= 20 THEN 'web' ELSE 'app' END AS ch,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) // 20 AS VARCHAR) AS ar,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              WHEN 'purchase' THEN 'trade' WHEN 'error' THEN 'good_list' END AS page_id,
         CASE WHEN event_type IN ('click', 'purchase', 'error') THEN 'home' END AS last_page_id,
         CASE WHEN event_type IN ('click', 'purchase')
              THEN json_extract_string(props, '$.k') END AS item,
         CASE event_type WHEN 'click' THEN 'sku_id' WHEN 'purchase' THEN 'sku_ids' END AS item_type,
         CAST(round(value * 1000) AS BIGINT) AS during_time,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, value
  FROM events),
page AS (SELECT * FROM log WHERE kind <> 'signup'),
display AS (
  SELECT page_id, ts, CAST(k AS VARCHAR) AS item, 'sku_id' AS item_type FROM log WHERE kind = 'view'
  UNION ALL
  SELECT page_id, ts, CAST(k + 1 AS VARCHAR), 'sku_id' FROM log WHERE kind = 'view'
  UNION ALL
  SELECT page_id, ts, CAST(k AS VARCHAR), 'activity_id' FROM log WHERE kind = 'view')
"""

FIXED = """
fixed AS (
  SELECT event_id, ts, mid, page_id, kind,
         CASE WHEN is_new = '1' AND row_number() OVER (
                PARTITION BY mid, is_new ORDER BY ts, event_id) > 1
              THEN '0' ELSE is_new END AS is_new
  FROM log)
"""

VISIT = """
visit AS (
  SELECT * FROM page WHERE last_page_id IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY mid, CAST(make_timestamp(ts * 1000) AS DATE) ORDER BY ts, event_id) = 1)
"""

BOUNCE = f"""
stepped AS (
  SELECT *, lead(ts) OVER w AS next_ts, lead(event_id) OVER w AS next_id,
         lead(last_page_id) OVER w AS next_last
  FROM page WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id)),
bounce AS (
  SELECT * FROM stepped
  WHERE last_page_id IS NULL
    AND (next_id IS NULL OR next_ts - ts >= {6 * HOUR_MS} OR next_last IS NULL))
"""

SOME_USERS = (
    "(SELECT dim_user.* FROM dim_user JOIN customer ON id = c_custkey WHERE c_acctbal >= 1000)"
)
SOME_SPUS = (
    "(SELECT dim_spu.* FROM dim_spu JOIN supplier ON id = s_suppkey WHERE s_acctbal >= 1000)"
)

# The columns that only the lookups fill; the queries that look up compare them.
ORDER = """
no_dimension AS (
  SELECT CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS province_area_code,
         CAST(NULL AS VARCHAR) AS province_iso_code, CAST(NULL AS VARCHAR) AS province_3166_2_code,
         CAST(NULL AS INTEGER) AS user_age, CAST(NULL AS VARCHAR) AS user_gender,
         CAST(NULL AS BIGINT) AS spu_id, CAST(NULL AS BIGINT) AS tm_id,
         CAST(NULL AS BIGINT) AS category3_id, CAST(NULL AS VARCHAR) AS spu_name,
         CAST(NULL AS VARCHAR) AS tm_name, CAST(NULL AS VARCHAR) AS category3_name),
order_info AS (
  SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id,
         CASE o_orderstatus WHEN 'O' THEN '1001' WHEN 'P' THEN '1002' ELSE '1004' END AS order_status,
         o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
         CAST(0 AS DECIMAL(16,2)) AS activity_reduce_amount,
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(16,2))
           AS coupon_reduce_amount,
         CAST(length(o_orderpriority) AS DECIMAL(16,2)) AS feight_fee,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time
  FROM orders JOIN customer ON o_custkey = c_custkey),
order_detail AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2))
              AS DECIMAL(16,2)) AS split_coupon_amount,
         'sku ' || l_partkey AS sku_name,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2))
              AS DECIMAL(16,2)) AS split_activity_amount
  FROM lineitem),
payment_info AS (
  SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id,
         CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount, o_orderpriority AS subject,
         CASE WHEN o_totalprice < 100000 THEN '1101' WHEN o_totalprice < 300000 THEN '1102'
              ELSE '1103' END AS payment_type,
         strftime(o_orderdate + to_seconds(CAST(floor(o_totalprice / 300) AS BIGINT)),
                  '%Y-%m-%d %H:%M:%S') AS create_time,
         CASE WHEN payment_type <> '1103' THEN create_time END AS callback_time
  FROM orders WHERE o_orderstatus <> 'O'),
order_wide AS (
  SELECT d.id AS detail_id, o.id AS order_id, d.sku_id, d.order_price, d.sku_num, o.province_id,
         o.order_status, o.user_id, o.total_amount, o.activity_reduce_amount,
         d.split_coupon_amount,
         CAST(d.order_price - d.split_coupon_amount AS DECIMAL(16,2)) AS split_total_amount,
         o.create_time, substr(o.create_time, 1, 10) AS create_date,
         substr(o.create_time, 12, 2) AS create_hour, d.sku_name, o.coupon_reduce_amount,
         o.total_amount AS original_total_amount, o.feight_fee, d.split_activity_amount,
         CAST(NULL AS DECIMAL(16,2)) AS split_feight_fee, CAST(NULL AS VARCHAR) AS expire_time,
         CAST(NULL AS VARCHAR) AS operate_time, no_dimension.*
  FROM order_info o CROSS JOIN no_dimension JOIN order_detail d ON o.id = d.order_id
   AND strptime(d.create_time, '%Y-%m-%d %H:%M:%S')
       BETWEEN strptime(o.create_time, '%Y-%m-%d %H:%M:%S') - INTERVAL 60 DAY
           AND strptime(o.create_time, '%Y-%m-%d %H:%M:%S') + INTERVAL 60 DAY),
payment_wide AS (
  SELECT p.id AS payment_id, p.subject, p.payment_type, p.create_time AS payment_create_time,
         w.detail_id, p.order_id, w.sku_id, w.order_price, w.sku_num, w.province_id,
         w.order_status, p.user_id, p.total_amount, w.split_total_amount,
         w.create_time AS order_create_time, p.callback_time, w.sku_name,
         w.activity_reduce_amount, w.coupon_reduce_amount, w.original_total_amount, w.feight_fee,
         w.split_feight_fee, w.split_activity_amount, w.split_coupon_amount, no_dimension.*
  FROM payment_info p CROSS JOIN no_dimension JOIN order_wide w ON p.order_id = w.order_id
   AND strptime(w.create_time, '%Y-%m-%d %H:%M:%S')
       BETWEEN strptime(p.create_time, '%Y-%m-%d %H:%M:%S') - INTERVAL 15 MINUTE
           AND strptime(p.create_time, '%Y-%m-%d %H:%M:%S'))
"""

DIM = """
dim_user AS (
  SELECT c_custkey AS id, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'F' ELSE 'M' END AS gender,
         strftime(DATE '1990-01-01' - CAST(floor(c_acctbal) AS INTEGER), '%Y-%m-%d') AS birthday,
         CAST(epoch_ms(TIMESTAMP '2024-01-01')
              - epoch_ms(CAST(DATE '1990-01-01' - CAST(floor(c_acctbal) AS INTEGER) AS TIMESTAMP))
              AS BIGINT) AS lived
  FROM customer),
dim_province AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
         CAST(n_regionkey AS VARCHAR) AS area_code, 'N' || n_nationkey AS iso_code,
         'R' || n_regionkey || '-' || n_nationkey AS iso_3166_2
  FROM nation),
dim_sku AS (
  SELECT p_partkey AS id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(16,2)) AS price,
         CAST(p_size AS BIGINT) AS spu_id,
         CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS tm_id,
         CAST(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type)
              AS BIGINT) AS category3_id
  FROM part),
dim_spu AS (SELECT s_suppkey AS id, s_name AS spu_name FROM supplier),
dim_trademark AS (
  SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS id, p_brand AS tm_name
  FROM part),
dim_category3 AS (
  SELECT DISTINCT
         CAST(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type)
              AS BIGINT) AS id, p_type AS name
  FROM part)
"""

# One branch per product stream, named columns only; the rest is added as zeros.
PRODUCT_EVENT = f"""
product_event AS (
  SELECT CAST(item AS BIGINT) AS sku_id, 0 AS display_ct, 1 AS click_ct, 0 AS favor_ct,
         0 AS cart_ct, CAST(0 AS BIGINT) AS order_sku_num,
         CAST(0 AS DECIMAL(16,2)) AS order_amount, CAST(0 AS DECIMAL(16,2)) AS payment_amount,
         CAST(0 AS DECIMAL(16,2)) AS refund_amount, 0 AS comment_ct, 0 AS good_comment_ct,
         CAST(NULL AS BIGINT) AS order_id, CAST(NULL AS BIGINT) AS paid_order_id,
         CAST(NULL AS BIGINT) AS refund_order_id, ts
  FROM page WHERE page_id = 'good_detail' AND item_type = 'sku_id'
  UNION ALL
  SELECT CAST(item AS BIGINT), 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL, ts
  FROM display WHERE item_type = 'sku_id'
  UNION ALL
  SELECT k, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL, {_millis('create_time')}
  FROM log WHERE kind = 'signup'
  UNION ALL
  SELECT sku_id, 0, 0, 0, 0, sku_num, split_total_amount, 0, 0, 0, 0, order_id, NULL, NULL,
         {_millis('create_time')}
  FROM order_wide
  UNION ALL
  SELECT sku_id, 0, 0, 0, 0, 0, 0, split_total_amount, 0, 0, 0, NULL, order_id, NULL,
         {_millis('payment_create_time')}
  FROM payment_wide
  UNION ALL
  SELECT l_partkey, 0, 0, 0, 0, 0, 0, 0, CAST(l_extendedprice AS DECIMAL(16,2)), 0, 0, NULL, NULL,
         l_orderkey, epoch_ms(l_shipdate)
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT k, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL, {_millis('create_time')}
  FROM log WHERE kind = 'purchase'
  UNION ALL
  SELECT k, 0, 0, 0, 0, 0, 0, 0, 0, 1, CASE WHEN value >= 20 THEN 1 ELSE 0 END,
         NULL, NULL, NULL, {_millis('create_time')}
  FROM log WHERE kind = 'error')
"""

PRODUCT_STAT = f"""
product_stat AS (
  SELECT {_window('ts', DAY_MS)}, sku_id,
         CAST(sum(display_ct) AS BIGINT) AS display_ct, CAST(sum(click_ct) AS BIGINT) AS click_ct,
         CAST(sum(favor_ct) AS BIGINT) AS favor_ct, CAST(sum(cart_ct) AS BIGINT) AS cart_ct,
         CAST(sum(order_sku_num) AS BIGINT) AS order_sku_num,
         CAST(sum(order_amount) AS DECIMAL(26,2)) AS order_amount,
         count(DISTINCT order_id) AS order_ct,
         CAST(sum(payment_amount) AS DECIMAL(26,2)) AS payment_amount,
         count(DISTINCT paid_order_id) AS paid_order_ct,
         count(DISTINCT refund_order_id) AS refund_order_ct,
         CAST(sum(refund_amount) AS DECIMAL(26,2)) AS refund_amount,
         CAST(sum(comment_ct) AS BIGINT) AS comment_ct,
         CAST(sum(good_comment_ct) AS BIGINT) AS good_comment_ct, min(ts) AS ts
  FROM product_event GROUP BY ALL)
"""

PRODUCT_WIDE = """
product_wide AS (
  SELECT s.*, k.sku_name, k.price AS sku_price, k.spu_id, u.spu_name, k.tm_id, t.tm_name,
         k.category3_id, c.name AS category3_name
  FROM product_stat s JOIN dim_sku k ON s.sku_id = k.id JOIN dim_spu u ON k.spu_id = u.id
  JOIN dim_trademark t ON k.tm_id = t.id JOIN dim_category3 c ON k.category3_id = c.id)
"""

CHANGE = """
change AS (
  SELECT CASE WHEN event_type IN ('signup', 'click', 'error') THEN 'user_info'
              WHEN event_type = 'purchase' THEN 'payment_info' ELSE 'favor_info' END AS tableName,
         CASE event_type WHEN 'click' THEN 'update' WHEN 'error' THEN 'delete'
              ELSE 'insert' END AS type,
         CASE WHEN event_type IN ('click', 'error') THEN CAST(user_id AS VARCHAR) END AS before_id,
         CASE WHEN event_type IN ('click', 'error') THEN 4 ELSE 0 END AS before_columns,
         CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS after_id,
         CASE WHEN event_type <> 'error' THEN 4 ELSE 0 END AS after_columns,
         'user' || json_extract_string(props, '$.k') AS name,
         json_extract_string(props, '$.k') AS level, '1' || event_id AS phone,
         event_id AS seq, NULL AS user_id, NULL AS total_amount
  FROM events
  UNION ALL
  SELECT 'order_info', 'insert', NULL, 0, CAST(o_orderkey AS VARCHAR), 4, NULL, NULL, NULL,
         o_orderkey, CAST(o_custkey AS VARCHAR),
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR)
  FROM orders),
user_change AS (
  SELECT *, coalesce(after_id, before_id) AS id FROM change WHERE tableName = 'user_info')
"""

CONFIG = """
config AS (
  SELECT p_type AS source_table, p_brand AS operate_type,
         CASE WHEN p_size < 25 THEN 'kafka' ELSE 'hbase' END AS sink_type, p_name AS sink_table,
         'id,' || split_part(p_name, ' ', 1) AS sink_columns, 'id' AS sink_pk, p_partkey AS seq
  FROM part WHERE p_size < 45)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


CHECKS = {
    "scan_page_view": f"""{_with(LOG)}
SELECT mid, page_id, item, ts, strftime(make_timestamp(ts * 1000), {SECOND}) AS rt FROM log""",
    "json_dirty_split": """
SELECT source, line,
       NOT (json_valid(value) AND CASE WHEN json_valid(value)
            THEN json_type(value) = 'OBJECT' ELSE false END) AS dirty
FROM (SELECT 'event' AS source, event_id AS line, props AS value FROM events
      UNION ALL SELECT 'turn', conv_id, text FROM conversations
      UNION ALL SELECT 'document', doc_id, text FROM documents)""",
    "log_split_counts": f"""{_with(LOG, FIXED)}
SELECT topic, page_id, is_new, count(*) AS n FROM (
  SELECT 'dwd_start_log' AS topic, NULL AS page_id, NULL AS is_new FROM fixed WHERE kind = 'signup'
  UNION ALL SELECT 'dwd_page_log', page_id, is_new FROM fixed WHERE kind <> 'signup'
  UNION ALL SELECT 'dwd_display_log', page_id, NULL FROM display
  UNION ALL SELECT 'dirty_log', NULL, NULL FROM conversations)
GROUP BY ALL""",
    "log_split_lines": f"""{_with(LOG, FIXED)}
SELECT 'dwd_start_log' AS topic, NULL AS mid, NULL AS is_new, NULL AS vc, NULL AS ch, NULL AS ar,
       NULL AS last_page_id, NULL AS during_time, NULL AS ts, 'icon' AS entry, NULL AS displays,
       NULL AS page_id, NULL AS item, NULL AS item_type, NULL AS line_md5
FROM fixed WHERE kind = 'signup'
UNION ALL
SELECT 'dwd_page_log', f.mid, f.is_new, l.vc, l.ch, l.ar, l.last_page_id,
       CAST(l.during_time AS VARCHAR), CAST(l.ts AS VARCHAR), NULL,
       CASE WHEN l.kind = 'view' THEN '["' || l.k || '","' || (l.k + 1) || '","' || l.k || '"]' END,
       l.page_id, l.item, l.item_type, NULL
FROM fixed f JOIN log l ON f.event_id = l.event_id WHERE f.kind <> 'signup'
UNION ALL
SELECT 'dwd_display_log', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, page_id,
       item, item_type, NULL
FROM display
UNION ALL
SELECT 'dirty_log', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       md5(text)
FROM conversations""",
    "display_explode": f"""{_with(LOG)}
SELECT page_id, item, item_type, count(*) AS n FROM display GROUP BY ALL""",
    "new_visitor_fix": f"""{_with(LOG, FIXED)}
SELECT event_id, ts, mid, is_new FROM fixed""",
    "unique_visit_daily": f"""{_with(LOG, VISIT)}
SELECT event_id, mid, page_id, create_time AS visited FROM visit""",
    "bounce_detail": f"""{_with(LOG, BOUNCE)}
SELECT event_id, mid, ts FROM bounce""",
    "order_wide": f"""{_with(ORDER)}
SELECT * FROM order_wide""",
    "payment_wide": f"""{_with(ORDER)}
SELECT * FROM payment_wide""",
    "order_wide_dims": f"""{_with(ORDER, DIM)}
SELECT w.detail_id, w.order_id, w.sku_id, k.sku_name, w.user_id,
       CAST(u.lived // 31536000000 AS INTEGER) AS user_age, u.gender AS user_gender,
       w.province_id, v.name AS province_name, v.area_code AS province_area_code,
       v.iso_code AS province_iso_code, v.iso_3166_2 AS province_3166_2_code,
       k.spu_id, s.spu_name, k.tm_id, t.tm_name, k.category3_id, c.name AS category3_name,
       w.split_total_amount, w.create_time
FROM order_wide w JOIN {SOME_USERS} u ON w.user_id = u.id
JOIN dim_province v ON w.province_id = v.id
JOIN dim_sku k ON w.sku_id = k.id JOIN {SOME_SPUS} s ON k.spu_id = s.id
JOIN dim_trademark t ON k.tm_id = t.id JOIN dim_category3 c ON k.category3_id = c.id""",
    "order_wide_dims_left": f"""{_with(ORDER, DIM)}
SELECT w.detail_id, w.order_id, w.sku_id, k.sku_name,
       CAST(u.lived // 31536000000 AS INTEGER) AS user_age, v.name AS province_name,
       k.spu_id, s.spu_name, t.tm_name, c.name AS category3_name
FROM order_wide w LEFT JOIN {SOME_USERS} u ON w.user_id = u.id
LEFT JOIN dim_province v ON w.province_id = v.id
LEFT JOIN dim_sku k ON w.sku_id = k.id LEFT JOIN {SOME_SPUS} s ON k.spu_id = s.id
LEFT JOIN dim_trademark t ON k.tm_id = t.id LEFT JOIN dim_category3 c ON k.category3_id = c.id""",
    "dim_lookup_by_id": f"""{_with(DIM)}
SELECT id, gender, birthday FROM dim_user WHERE id IN (SELECT user_id FROM events)""",
    "order_wide_coalesce": f"""{_with(ORDER)}
SELECT o.id AS order_id,
       coalesce(CASE WHEN order_status <> '1004' THEN order_status END,
                CASE WHEN p.id IS NOT NULL THEN '1002' END) AS order_status,
       coalesce(CASE WHEN o.total_amount > 100000 THEN o.total_amount END, p.total_amount)
         AS total_amount,
       coalesce(CASE WHEN province_id > 4 THEN o.user_id END, p.user_id) AS user_id,
       coalesce(CASE WHEN province_id > 9 THEN o.create_time END, p.create_time) AS create_time,
       province_id
FROM order_info o LEFT JOIN payment_info p ON o.id = p.order_id""",
    "order_time_parts": f"""
SELECT event_id, strftime(ts, {SECOND}) AS create_time, strftime(ts, '%Y-%m-%d') AS create_date,
       strftime(ts, '%H') AS create_hour, epoch_ms(date_trunc('second', ts)) AS create_ts
FROM events""",
    "user_age": f"""{_with(DIM)}
SELECT id, birthday, CAST(lived // 31536000000 AS INTEGER) AS user_age FROM dim_user""",
    "fact_records": f"""{_with(ORDER)}
SELECT id, province_id, order_status, user_id, total_amount, activity_reduce_amount, create_time
FROM order_info""",
    "province_rows": f"""{_with(ORDER)}
SELECT province_id, split_total_amount AS order_amount, CAST(1 AS BIGINT) AS order_count
FROM order_wide""",
    "product_click_display": f"""{_with(LOG)}
SELECT sku_id, CAST(sum(click_ct) AS BIGINT) AS click_ct,
       CAST(sum(display_ct) AS BIGINT) AS display_ct
FROM (SELECT CAST(item AS BIGINT) AS sku_id, 1 AS click_ct, 0 AS display_ct FROM page
      WHERE page_id = 'good_detail' AND item_type = 'sku_id'
      UNION ALL
      SELECT CAST(item AS BIGINT), 0, 1 FROM display WHERE item_type = 'sku_id')
GROUP BY sku_id""",
    "product_events_unified": f"""{_with(LOG, ORDER, PRODUCT_EVENT)}
SELECT * REPLACE (CAST(display_ct AS BIGINT) AS display_ct, CAST(click_ct AS BIGINT) AS click_ct,
  CAST(favor_ct AS BIGINT) AS favor_ct, CAST(cart_ct AS BIGINT) AS cart_ct,
  CAST(order_amount AS DECIMAL(16,2)) AS order_amount,
  CAST(payment_amount AS DECIMAL(16,2)) AS payment_amount,
  CAST(refund_amount AS DECIMAL(16,2)) AS refund_amount,
  CAST(comment_ct AS BIGINT) AS comment_ct, CAST(good_comment_ct AS BIGINT) AS good_comment_ct)
FROM product_event""",
    "product_stats": f"""{_with(LOG, ORDER, PRODUCT_EVENT, PRODUCT_STAT)}
SELECT * FROM product_stat""",
    "product_stats_dims": f"""{_with(LOG, ORDER, PRODUCT_EVENT, PRODUCT_STAT, DIM, PRODUCT_WIDE)}
SELECT stt, sku_id, sku_name, sku_price, spu_id, spu_name, tm_id, tm_name, category3_id,
       category3_name
FROM product_wide""",
    "product_stats_sink_columns": f"""{_with(LOG, ORDER, PRODUCT_EVENT, PRODUCT_STAT, DIM, PRODUCT_WIDE)}
SELECT stt, edt, sku_id, sku_name, sku_price, spu_id, spu_name, tm_id, tm_name, category3_id,
       category3_name, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, order_amount,
       order_ct, payment_amount, paid_order_ct, refund_order_ct, refund_amount, comment_ct,
       good_comment_ct, ts
FROM product_wide""",
    "distinct_orders_by_sku": f"""
SELECT {_window('epoch_ms(l_shipdate)', 30 * DAY_MS)}, l_partkey AS sku_id,
       count(DISTINCT l_orderkey) AS order_ct
FROM lineitem GROUP BY ALL""",
    "province_stats": f"""{_with(ORDER, DIM)}
SELECT {_window(_millis('create_time'), DAY_MS)}, province_id, name AS province_name,
       area_code AS province_area_code, iso_code AS province_iso_code,
       iso_3166_2 AS province_3166_2_code,
       CAST(sum(split_total_amount) AS DECIMAL(26,2)) AS order_amount,
       count(DISTINCT order_id) AS order_count
FROM order_wide JOIN dim_province ON province_id = id GROUP BY ALL""",
    "gmv_by_day": f"""{_with(ORDER)}
SELECT CAST(replace(create_date, '-', '') AS INTEGER) AS day,
       CAST(sum(split_total_amount) AS DECIMAL(26,2)) AS gmv
FROM order_wide GROUP BY ALL""",
    "visitor_stats": f"""{_with(LOG, VISIT, BOUNCE)}
SELECT {_window('ts', HOUR_MS)}, vc, ch, ar, is_new,
       CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
       CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
       CAST(sum(dur) AS BIGINT) AS dur_sum, min(ts) AS ts
FROM (
  SELECT ts, vc, ch, ar, is_new, 0 AS uv, 1 AS pv,
         CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv, 0 AS uj, during_time AS dur
  FROM page
  UNION ALL SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM visit
  UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, 1, 0 FROM bounce)
GROUP BY stt, edt, vc, ch, ar, is_new""",
    "session_starts": f"""{_with(LOG)}
SELECT ch, ar, vc, is_new, count(*) AS pv_ct,
       CAST(sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct
FROM page GROUP BY ALL""",
    "good_comment_rate": f"""{_with(LOG)}
SELECT k AS sku_id, count(*) AS comment_ct,
       CAST(sum(CASE WHEN value >= 20 THEN 1 ELSE 0 END) AS BIGINT) AS good_comment_ct,
       round(sum(CASE WHEN value >= 20 THEN 1 ELSE 0 END) / count(*), 6) AS good_rate
FROM log WHERE kind = 'error' GROUP BY k""",
    "keyword_filter": f"""
SELECT text AS full_word,
       strftime(make_timestamp((doc_id * 60000 + {FIRST_DOCUMENT_MS}) * 1000), {SECOND}) AS rt
FROM documents WHERE text IS NOT NULL""",
    "keyword_count": f"""
WITH word AS (
  SELECT doc_id * 60000 + {FIRST_DOCUMENT_MS} AS ts,
         unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS keyword
  FROM documents)
SELECT keyword, count(*) AS ct, 'search' AS source, {_window('ts', HOUR_MS)}
FROM word GROUP BY ALL""",
    "keyword_lateral_sql": """
SELECT keyword, count(*) AS ct
FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS keyword FROM documents)
GROUP BY keyword""",
    "keyword_han_words": f"""
WITH han AS (
  SELECT doc_id, translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', '{HAN_LETTERS}') AS spaced
  FROM documents),
dictionary AS (
  SELECT word FROM (SELECT unnest(regexp_extract_all(spaced, '\\p{{Han}}+')) AS word FROM han)
  WHERE length(word) BETWEEN 2 AND 8 GROUP BY word HAVING count(*) >= 5),
token AS (SELECT doc_id, unnest(regexp_extract_all(replace(spaced, ' ', ''), '\\p{{Han}}+')) AS run FROM han),
run AS (
  SELECT row_number() OVER () AS id, run, regexp_extract_all(run, '.') AS chars
  FROM (SELECT DISTINCT run FROM token)),
start AS (
  SELECT id, place, ch || {" || ".join(f"coalesce(lead(ch, {n}) OVER following, '')" for n in range(1, 8))} AS ahead
  FROM (SELECT id, unnest(chars) AS ch, generate_subscripts(chars, 1) AS place FROM run)
  WINDOW following AS (PARTITION BY id ORDER BY place)),
matched AS (
  SELECT id, place, max(k) AS k
  FROM (SELECT id, place, k, substring(ahead, 1, k) AS word
        FROM start, range(2, 9) AS sizes(k) WHERE k <= length(ahead))
  JOIN dictionary USING (word) GROUP BY id, place),
taken AS (
  SELECT id, unnest(list_reduce(
    list({{'next': place + k, 'place': place, 'taken': [place]}} ORDER BY place),
    lambda a, b: CASE WHEN b.place >= a.next
      THEN {{'next': b.next, 'place': b.place, 'taken': list_concat(a.taken, b.taken)}} ELSE a END).taken) AS place
  FROM matched GROUP BY id),
word AS (SELECT id, place, k FROM taken JOIN matched USING (id, place)),
piece AS (
  SELECT id, substring(ahead, 1, k) AS keyword FROM word JOIN start USING (id, place)
  UNION ALL
  SELECT id, substring(ahead, 1, 1) FROM start
  ANTI JOIN (SELECT id, unnest(range(place, place + k)) AS place FROM word) USING (id, place)),
found AS (
  SELECT doc_id, keyword FROM token JOIN run USING (run) JOIN piece USING (id)
  UNION ALL
  SELECT doc_id, unnest(regexp_extract_all(
    regexp_replace(replace(spaced, ' ', ''), '\\p{{Han}}+', ' ', 'g'), '[\\p{{L}}\\p{{N}}]+')) FROM han)
SELECT doc_id, keyword, count(*) AS ct FROM found GROUP BY ALL""",
    "cdc_normalize": f"""{_with(CHANGE)}
SELECT 'shop' AS database, tableName, before_id, before_columns, after_id, after_columns, type, seq
FROM change""",
    "cdc_filter_deletes": f"""{_with(CHANGE)}
SELECT tableName, type, after_id AS id, seq FROM change WHERE type <> 'delete'""",
    "cdc_latest_table": f"""{_with(CHANGE)}
SELECT CAST(id AS BIGINT) AS id, name, CAST(level AS INTEGER) AS level, phone FROM (
  SELECT * FROM user_change
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
WHERE type <> 'delete'""",
    "cdc_snapshot_plus_changes": f"""{_with(CHANGE)}
SELECT CAST(id AS BIGINT) AS id, name, CAST(level AS INTEGER) AS level, phone FROM (
  SELECT * FROM (
    SELECT id, name, level, phone, type, seq FROM user_change
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), NULL, 'read', -1
    FROM customer)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
WHERE type <> 'delete'""",
    "dim_upsert_latest": f"""{_with(CHANGE)},
named AS (
  SELECT after_id AS id, arg_max(name, seq) AS name,
         arg_max(level, seq) FILTER (WHERE type = 'insert') AS level
  FROM user_change WHERE type <> 'delete' GROUP BY after_id),
stored AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS level
  FROM customer)
SELECT id, coalesce(n.name, s.name) AS name, coalesce(n.level, s.level) AS level
FROM stored s FULL JOIN named n USING (id)""",
    "config_latest": f"""{_with(CONFIG)}
SELECT source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk FROM config
QUALIFY row_number() OVER (PARTITION BY source_table, operate_type ORDER BY seq DESC) = 1""",
    "config_column_prune": f"""{_with(CONFIG)}
SELECT seq, sink_columns, '{{"id":"' || seq || '"' ||
       CASE split_part(sink_columns, ',', 2) WHEN 'red' THEN ',"red":"r"'
            WHEN 'blue' THEN ',"blue":"b"' WHEN 'cold' THEN ',"cold":"c"'
            WHEN 'large' THEN ',"large":"l"' ELSE '' END || '}}' AS payload
FROM config""",
    "route_fact_payload": f"""{_with(CHANGE)}
SELECT 'dwd_order_info' AS topic, '{{"id":"' || after_id || '","user_id":"' || user_id ||
       '","total_amount":"' || total_amount || '"}}' AS value
FROM change WHERE tableName = 'order_info'
UNION ALL
SELECT 'dwd_payment_info', '{{"id":"' || after_id || '","name":"' || name || '"}}'
FROM change WHERE tableName = 'payment_info'""",
    "route_dim_payload": f"""{_with(CHANGE)}
SELECT 'DIM_USER_INFO' AS sink_table, type, seq,
       '{{"id":"' || after_id || '","name":"' || name || '"' ||
       CASE WHEN type = 'insert' THEN ',"level":"' || level || '"' ELSE '' END || '}}' AS payload,
       'id' AS sink_pk
FROM user_change WHERE type <> 'delete'""",
    "decode_codes": f"""{_with(ORDER)}
SELECT id, order_status,
       CASE order_status WHEN '1001' THEN 'unpaid' WHEN '1002' THEN 'paid'
            ELSE 'finished' END AS status_label
FROM order_info""",
    "stream_new_visitor_fix": f"""{_with(LOG, FIXED)}
SELECT event_id, ts, mid, is_new FROM fixed""",
    "stream_unique_visit": f"""{_with(LOG)}
SELECT DISTINCT mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day
FROM page WHERE last_page_id IS NOT NULL""",
    "stream_page_stats": f"""{_with(LOG)}
SELECT {_window('ts', HOUR_MS)}, vc, ch, ar, is_new, CAST(0 AS BIGINT) AS uv_ct,
       count(*) AS pv_ct,
       CAST(sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
       CAST(0 AS BIGINT) AS uj_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum, min(ts) AS ts
FROM page
GROUP BY stt, edt, vc, ch, ar, is_new""",
}
CHECKS["stream_bounce_detail"] = CHECKS["bounce_detail"]
CHECKS["stream_order_wide"] = CHECKS["order_wide"]
CHECKS["stream_payment_wide"] = CHECKS["payment_wide"]
CHECKS["stream_visitor_stats"] = CHECKS["visitor_stats"]
CHECKS["stream_product_stats"] = CHECKS["product_stats"]
CHECKS["stream_province_stats"] = CHECKS["province_stats"]
CHECKS["stream_keyword_stats"] = CHECKS["keyword_count"]
CHECKS["stream_log_split_lines"] = CHECKS["log_split_lines"]
CHECKS["stream_log_split"] = CHECKS["log_split_counts"]
CHECKS["stream_route_facts"] = CHECKS["route_fact_payload"]
CHECKS["stream_route_early_facts"] = CHECKS["route_fact_payload"]
CHECKS["stream_cdc_changelog"] = CHECKS["cdc_latest_table"]
CHECKS["stream_log_intake"] = CHECKS["scan_page_view"]
CHECKS["stream_visit_expiry"] = f"""{_with(LOG)}
SELECT mid, strftime(make_timestamp(max(ts) * 1000), '%Y-%m-%d') AS last_day FROM log
WHERE kind <> 'signup' AND last_page_id IS NOT NULL
  AND ts > (SELECT (min(ts) + max(ts)) // 2 FROM log WHERE kind <> 'signup')
GROUP BY mid"""
CHECKS["stream_order_sketches"] = """
SELECT strftime(date_trunc('quarter', l_shipdate), '%Y-%m-%d') AS quarter,
       count(DISTINCT l_orderkey) AS order_ct, true AS near, true AS bounded
FROM lineitem GROUP BY ALL"""
CHECKS["dim_keyed_lookup"] = f"""{_with(DIM)}
SELECT CAST(id AS VARCHAR) AS id, gender, birthday FROM dim_user
WHERE id = (SELECT user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)"""
CHECKS["stream_dim_upsert"] = f"""{_with(CHANGE)}
SELECT after_id AS id, arg_max(name, seq) AS name,
       arg_max(level, seq) FILTER (WHERE type = 'insert') AS level
FROM user_change WHERE type <> 'delete' GROUP BY after_id"""
CHECKS["dim_keyed_upsert"] = CHECKS["stream_dim_upsert"]

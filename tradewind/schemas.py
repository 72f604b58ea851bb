"""Record layouts shared by batch and streaming jobs (Spark DDL)."""

from __future__ import annotations

AMOUNT = "decimal(16,2)"
TOTAL = "decimal(38,2)"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# ODS: one raw click-log line; ``seq`` is the arrival order (e.g. built from topic time and offset).
LOG_LINE = "value STRING, seq BIGINT"

# DWD page log, one row per page view.
PAGE_LOG = """
    seq BIGINT, mid STRING, vc STRING, ch STRING, ar STRING, is_new STRING,
    page_id STRING, last_page_id STRING, item STRING, item_type STRING, during_time BIGINT,
    displays ARRAY<STRUCT<item: STRING, item_type: STRING>>, ts BIGINT
"""

# Row change as the capture connector hands it over, and in its normalised form.
CDC_RECORD = "topic STRING, before STRING, after STRING, op STRING, seq BIGINT"
CDC_CHANGE = """
    database STRING, table STRING, before MAP<STRING, STRING>, after MAP<STRING, STRING>,
    operation STRING, seq BIGINT
"""

ROUTING_RULE = """
    source_table STRING, operate_type STRING, sink_type STRING, sink_table STRING,
    sink_columns STRING, sink_pk STRING, sink_extend STRING, seq BIGINT
"""

ORDER_INFO = f"""
    id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, total_amount {AMOUNT},
    activity_reduce_amount {AMOUNT}, coupon_reduce_amount {AMOUNT}, original_total_amount {AMOUNT},
    feight_fee {AMOUNT}, expire_time STRING, create_time STRING, operate_time STRING
"""

ORDER_DETAIL = f"""
    id BIGINT, order_id BIGINT, sku_id BIGINT, order_price {AMOUNT}, sku_num BIGINT, sku_name STRING,
    create_time STRING, split_total_amount {AMOUNT}, split_activity_amount {AMOUNT},
    split_coupon_amount {AMOUNT}
"""

PAYMENT_INFO = f"""
    id BIGINT, order_id BIGINT, user_id BIGINT, total_amount {AMOUNT}, subject STRING,
    payment_type STRING, create_time STRING, callback_time STRING
"""

COMMENT_INFO = """
    id BIGINT, user_id BIGINT, nick_name STRING, head_img STRING, sku_id BIGINT, spu_id BIGINT,
    order_id BIGINT, appraise STRING, comment_txt STRING, create_time STRING, operate_time STRING
"""

# Dimensions: every column text, key ``id``.
DIM_USER = "id STRING, gender STRING, birthday STRING"
DIM_PROVINCE = "id STRING, name STRING, area_code STRING, iso_code STRING, iso_3166_2 STRING"
DIM_SKU = "id STRING, sku_name STRING, price STRING, spu_id STRING, tm_id STRING, category3_id STRING"
DIM_SPU = "id STRING, spu_name STRING"
DIM_TRADEMARK = "id STRING, tm_name STRING"
DIM_CATEGORY3 = "id STRING, name STRING"

# Column order of the stored tables (the serving table is filled by position).
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id",
    "order_status", "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "expire_time", "create_time", "operate_time",
    "create_date", "create_hour", "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "user_age", "user_gender", "spu_id", "tm_id", "category3_id",
    "spu_name", "tm_name", "category3_name",
]
VISITOR_STATS_COLUMNS = [
    "stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts",
]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts",
]
PROVINCE_STATS_COLUMNS = [
    "stt", "edt", "province_id", "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "order_amount", "order_count", "ts",
]
KEYWORD_STATS_COLUMNS = ["keyword", "ct", "source", "stt", "edt", "ts"]

# What a gap in one wide row may take from another version of the row; never the split amounts.
ORDER_WIDE_FILLED = [
    "order_status", "create_time", "create_date", "coupon_reduce_amount", "activity_reduce_amount",
    "original_total_amount", "feight_fee", "total_amount", "user_id", "sku_id", "sku_name", "order_price", "sku_num",
]

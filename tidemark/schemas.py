"""Row types of the warehouse, as Spark DDL."""

from __future__ import annotations

# A record of any topic: an orderable arrival id and the JSON text.
RECORD = "id bigint, value string"

MONEY = "decimal(18,2)"

# The members of a log line. Members that may be a number or a quoted number are read as
# text, and so are those only looked at as a whole.
LOG = (
    "common struct<mid:string,vc:string,ch:string,ar:string,is_new:string>, start string, "
    "page struct<page_id:string,last_page_id:string,during_time:string>, displays string, ts string"
)
LOG_FLAGS = "common struct<mid:string,is_new:string>, ts string"

# Field names and types of the order topics.
ORDER_FIELDS = {
    "id": "bigint",
    "province_id": "bigint",
    "order_status": "string",
    "user_id": "bigint",
    "total_amount": MONEY,
    "activity_reduce_amount": MONEY,
    "coupon_reduce_amount": MONEY,
    "original_total_amount": MONEY,
    "feight_fee": MONEY,
    "expire_time": "string",
    "create_time": "string",
    "operate_time": "string",
    "create_date": "string",
    "create_hour": "string",
}

DETAIL_FIELDS = {
    "id": "bigint",
    "order_id": "bigint",
    "sku_id": "bigint",
    "order_price": MONEY,
    "sku_num": "bigint",
    "sku_name": "string",
    "create_time": "string",
    "split_total_amount": MONEY,
    "split_activity_amount": MONEY,
    "split_coupon_amount": MONEY,
}

# The columns of a wide order row, in table order.
ORDER_WIDE_FIELDS = {
    "detail_id": "bigint",
    "order_id": "bigint",
    "sku_id": "bigint",
    "order_price": MONEY,
    "sku_num": "bigint",
    "sku_name": "string",
    "province_id": "bigint",
    "order_status": "string",
    "user_id": "bigint",
    "total_amount": MONEY,
    "activity_reduce_amount": MONEY,
    "coupon_reduce_amount": MONEY,
    "original_total_amount": MONEY,
    "feight_fee": MONEY,
    "split_feight_fee": MONEY,
    "split_activity_amount": MONEY,
    "split_coupon_amount": MONEY,
    "split_total_amount": MONEY,
    "expire_time": "string",
    "create_time": "string",
    "operate_time": "string",
    "create_date": "string",
    "create_hour": "string",
    "province_name": "string",
    "province_area_code": "string",
    "province_iso_code": "string",
    "province_3166_2_code": "string",
    "user_age": "int",
    "user_gender": "string",
    "spu_id": "bigint",
    "tm_id": "bigint",
    "category3_id": "bigint",
    "spu_name": "string",
    "tm_name": "string",
    "category3_name": "string",
}

# The columns of a visitor statistics row, in table order.
VISITOR_STATS_COLUMNS = [
    "stt",
    "edt",
    "vc",
    "ch",
    "ar",
    "is_new",
    "uv_ct",
    "pv_ct",
    "sv_ct",
    "uj_ct",
    "dur_sum",
    "ts",
]

# Routing rules of change records. One row per (source_table, operate_type).
ROUTING = (
    "source_table string, operate_type string, sink_type string, sink_table string, "
    "sink_columns string, sink_pk string, sink_extend string"
)


class Topic:
    """Topic names shared by the jobs."""

    ODS_LOG = "ods_base_log"
    ODS_DB = "ods_base_db_m"
    START = "dwd_start_log"
    PAGE = "dwd_page_log"
    DISPLAY = "dwd_display_log"
    ORDER = "dwd_order_info"
    ORDER_DETAIL = "dwd_order_detail"
    UNIQUE_VISIT = "dwm_unique_visit"
    BOUNCE = "dwm_user_jump_detail"
    ORDER_WIDE = "dwm_order_wide"
    FALLBACK = "DEFAULT_DATA"


# Records no job can use are kept here instead of stopping the job.
QUARANTINE_TOPIC = "quarantine"


class SinkType:
    """Sink kinds named by the routing rules."""

    HBASE = "hbase"
    KAFKA = "kafka"
    CLICKHOUSE = "clickhouse"

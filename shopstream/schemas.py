"""Record shapes, as Spark DDL strings."""

# Money has no declared precision at the source; two decimals is our choice. It is read
# with so many decimals, and an amount that the type cannot hold exactly is no amount.
MONEY = "DECIMAL(16,2)"
READ_DECIMALS = 20

# What a topic gives: the text of one record and its position in the topic.
TOPIC = "value STRING, arrival BIGINT"

# A record's place among those of several partitions; compares by time, then partition, then offset.
POSITION = "STRUCT<time: BIGINT, partition: INT, offset: BIGINT>"

# ``ts`` is read as text so that both 1000 and "1000" are accepted, then cast.
APP_LOG = (
    "common STRUCT<mid: STRING, is_new: STRING>, "
    "page STRUCT<page_id: STRING, last_page_id: STRING>, "
    "start MAP<STRING, STRING>, "
    "displays ARRAY<MAP<STRING, VARIANT>>, "
    "ts STRING"
)

CHANGE = "`table` STRING, type STRING, data MAP<STRING, VARIANT>"

RULE_CHANGE = "database STRING, `table` STRING, type STRING, data MAP<STRING, STRING>"

RULE = (
    "source_table STRING, operate_type STRING, sink_type STRING, sink_table STRING, "
    "sink_columns STRING, sink_pk STRING, sink_extend STRING"
)

ORDER_INFO = (
    "id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, "
    f"total_amount {MONEY}, activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, "
    f"original_total_amount {MONEY}, feight_fee {MONEY}, "
    "expire_time STRING, create_time STRING, operate_time STRING, "
    "create_date STRING, create_hour STRING, create_ts BIGINT"
)

ORDER_DETAIL = (
    f"id BIGINT, order_id BIGINT, sku_id BIGINT, order_price {MONEY}, sku_num BIGINT, "
    f"sku_name STRING, create_time STRING, split_total_amount {MONEY}, "
    f"split_activity_amount {MONEY}, split_coupon_amount {MONEY}, create_ts BIGINT"
)

# The wide order row: name, type and where the value comes from
# ("order"/"detail" column, or None where nothing fills it).
ORDER_WIDE = [
    ("detail_id", "BIGINT", ("detail", "id")),
    ("order_id", "BIGINT", ("order", "id")),
    ("sku_id", "BIGINT", ("detail", "sku_id")),
    ("order_price", MONEY, ("detail", "order_price")),
    ("sku_num", "BIGINT", ("detail", "sku_num")),
    ("sku_name", "STRING", ("detail", "sku_name")),
    ("province_id", "BIGINT", ("order", "province_id")),
    ("order_status", "STRING", ("order", "order_status")),
    ("user_id", "BIGINT", ("order", "user_id")),
    ("total_amount", MONEY, ("order", "total_amount")),
    ("activity_reduce_amount", MONEY, ("order", "activity_reduce_amount")),
    ("coupon_reduce_amount", MONEY, ("order", "coupon_reduce_amount")),
    ("original_total_amount", MONEY, ("order", "original_total_amount")),
    ("feight_fee", MONEY, ("order", "feight_fee")),
    ("split_feight_fee", MONEY, None),
    ("split_activity_amount", MONEY, ("detail", "split_activity_amount")),
    ("split_coupon_amount", MONEY, ("detail", "split_coupon_amount")),
    ("split_total_amount", MONEY, ("detail", "split_total_amount")),
    ("expire_time", "STRING", None),
    ("create_time", "STRING", ("order", "create_time")),
    ("operate_time", "STRING", None),
    ("create_date", "STRING", ("order", "create_date")),
    ("create_hour", "STRING", None),
    ("province_name", "STRING", None),
    ("province_area_code", "STRING", None),
    ("province_iso_code", "STRING", None),
    ("province_3166_2_code", "STRING", None),
    ("user_age", "INT", None),
    ("user_gender", "STRING", None),
    ("spu_id", "BIGINT", None),
    ("tm_id", "BIGINT", None),
    ("category3_id", "BIGINT", None),
    ("spu_name", "STRING", None),
    ("tm_name", "STRING", None),
    ("category3_name", "STRING", None),
]

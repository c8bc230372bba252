"""Shop records derived from the given tables: every row of a table becomes a record.

The rules are those of ``FIXTURES.md``; ``oracles.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions.times import position


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """A table; with ``key``, spread over the cluster if its files are too few for that."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tasks = spark.sparkContext.defaultParallelism
    if key and df.rdd.getNumPartitions() < tasks:
        return df.repartition(tasks, key)
    return df


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _events(spark: SparkSession, sf_dir: str, disordered: bool) -> DataFrame:
    """Events with ``k`` from their properties, and an arrival order."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events", "event_id").withColumn("k", k)
    late = F.col("k") % 5
    # The late variant moves events back by 0 to 800 places, ties by event_id.
    moved = (F.col("event_id") + late * 200) * 5 + 4 - late
    return events.withColumn("arrival", moved if disordered else F.col("event_id"))


def app_logs(spark: SparkSession, sf_dir: str, disordered: bool = False) -> DataFrame:
    """Raw app logs (``value``, ``arrival``) out of events."""
    kind = F.col("event_type")
    is_start = kind == "error"
    entry = kind.isin("signup", "view")
    displays = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < F.col("k") % 4),
        lambda i: F.struct((F.col("k") * 10 + i).alias("item"), i.alias("order")),
    )
    log = F.struct(
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            F.when(F.col("k") % 2 == 0, "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        F.when(is_start, F.struct(F.lit("icon").alias("entry"), F.col("k").alias("loading_time"))).alias("start"),
        F.when(
            ~is_start, F.struct(kind.alias("page_id"), F.when(~entry, F.lit("home")).alias("last_page_id"))
        ).alias("page"),
        F.when(~is_start, displays).alias("displays"),
        _millis("ts").alias("ts"),
    )
    return _events(spark, sf_dir, disordered).select(F.to_json(log).alias("value"), "arrival")


def damaged_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app logs, each damaged in one of several ways (or not) by its number."""
    logs = app_logs(spark, sf_dir)
    case = F.col("arrival") % 8
    ts = F.regexp_extract("value", r'"ts":(\d+)', 1)
    mid = F.regexp_extract("value", r'"mid":"(\w+)"', 1)

    def text(template: str) -> Column:
        return F.format_string(template, mid, ts)

    value = (
        F.when(case == 1, F.expr("substr(value, 1, length(value) - 1)"))
        .when(case == 2, F.format_string('{"page":{"page_id":"home"},"ts":%s}', ts))
        .when(case == 3, F.format_string('{"common":{"is_new":"1"},"page":{"page_id":"home"},"ts":%s}', ts))
        .when(case == 4, text('{"common":{"mid":"%s","is_new":"1"},"ts":%s}'))
        .when(case == 5, F.format_string('{"common":{"mid":"%s","is_new":1},"page":{"page_id":"home"}}', mid))
        .when(case == 6, text('{"common":{"mid":"%s","is_new":1},"page":{"page_id":"home"},"start":{},"ts":"%s"}'))
        .when(case == 7, text('{"common":{"mid":"%s"},"page":{"page_id":"home"},"displays":[null],"ts":%s}'))
        .otherwise(F.col("value"))
    )
    return logs.select(value.alias("value"), "arrival")


PARTITIONS = 4


def partitioned_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app logs dealt to partitions with offsets of their own, in order of their time."""
    number, ts = F.col("arrival"), F.get_json_object("value", "$.ts").cast("bigint")
    # The offset of the last partition is ahead of the others, which tells nothing.
    ahead = F.when(number % PARTITIONS == PARTITIONS - 1, 1_000_000).otherwise(0)
    place = position(ts, number % PARTITIONS, F.floor(number / PARTITIONS) + ahead)
    return app_logs(spark, sf_dir).select("value", place.alias("arrival"))


def rough_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The disordered app logs in texts that are no strict JSON, or odd, by their number; the fields say the same."""
    logs = app_logs(spark, sf_dir, disordered=True)
    case = F.col("arrival") % 5
    value = (
        F.when(case == 0, F.regexp_replace("value", r"^\{", '{"more":{"x":1,"x":2},'))
        .when(case == 1, F.translate("value", '"', "'"))
        .when(case == 2, F.regexp_replace("value", r'"common":\{', '"note":"common","note":"\u00e9\U0001f600","common":{"v":{"is_new":"1"},'))
        .when(case == 3, F.regexp_replace("value", '"is_new":"1"', '"is_new" : 1'))
        .otherwise(F.col("value"))
    )
    return logs.select(value.alias("value"), "arrival")


def repeated_displays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app logs with each display's item named twice, the first time wrongly."""
    value = F.regexp_replace("value", r'\{"item":', '{"item":-1,"item":')
    return app_logs(spark, sf_dir).select(value.alias("value"), "arrival")


def repeated_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of orders that name the status twice, the first time wrongly."""
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    text = '{"table":"order_info","type":"update","data":{"status":"?","id":%d,"status":"%s"}}'
    value = F.format_string(text, F.col("o_orderkey"), F.col("o_orderstatus"))
    return orders.select(value.alias("value"), F.col("o_orderkey").alias("arrival"))


def damaged(records: DataFrame, key: str) -> DataFrame:
    """Order records, some of them cut short, without their key or without a readable time, by their number."""
    case = F.col("arrival") % 50
    value = (
        F.when(case == 1, F.expr("substr(value, 1, length(value) - 1)"))
        .when(case == 2, F.regexp_replace("value", f'"{key}":\\d+', '"other":1'))
        .when(case == 3, F.regexp_replace("value", r'"create_time":"[^"]*"', '"create_time":"soon"'))
        .otherwise(F.col("value"))
    )
    return records.select(value.alias("value"), "arrival")


# Source table of the change records, and the table and key they come from.
CHANGED = [
    ("order_info", "orders", "o_orderkey"),
    ("user_info", "customer", "c_custkey"),
    ("base_province", "nation", "n_nationkey"),
    ("sku_info", "part", "p_partkey"),
]


def _operation(key: Column) -> Column:
    digit = key % 10
    return (
        F.when(digit <= 5, "insert").when(digit == 6, "bootstrap-insert").when(digit <= 8, "update").otherwise("delete")
    )


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change records out of four tables, and broken ones out of supplier."""
    parts = []
    for source, name, key in CHANGED:
        rows = table(spark, sf_dir, name, key)
        change = F.struct(
            F.lit(source).alias("table"), _operation(F.col(key)).alias("type"), F.struct(*rows.columns).alias("data")
        )
        parts.append(rows.select(F.to_json(change).alias("value"), F.col(key).cast("bigint").alias("arrival")))
    supplier = table(spark, sf_dir, "supplier")
    case = F.col("s_suppkey") % 6
    key = F.col("s_suppkey").cast("string")
    broken = (
        F.when(case == 0, F.format_string('{"type":"insert","data":{"id":%s}}', key))
        .when(case == 1, F.lit('{"table":"user_info","type":"insert"}'))
        .when(case == 2, F.lit('{"table":"user_info","type":"insert","data":{}}'))
        .when(case == 3, F.lit('{"table":"user_info","type":"insert","data":{"id":null}}'))
        .when(case == 4, F.format_string('{"table":"user_info","data":{"c_custkey":%s}}', key))
        .otherwise(F.format_string('{"table":"","type":"insert","data":{"id":%s}}', key))
    )
    parts.append(supplier.select(broken.alias("value"), F.col("s_suppkey").alias("arrival")))
    records = parts[0]
    for part in parts[1:]:
        records = records.unionByName(part)
    return records


RULES = [
    ("order_info", "insert", "kafka", "dwd_order_info", None, None),
    ("order_info", "update", "kafka", "dwd_order_info_update", "o_orderkey,o_orderstatus", None),
    ("user_info", "insert", "hbase", "dim_user_info", "c_custkey,c_name,c_nationkey", "c_custkey"),
    ("user_info", "update", "hbase", "dim_user_info", "c_custkey,c_nationkey", "c_custkey"),
    ("base_province", "insert", "hbase", "dim_base_province", "n_nationkey, n_name", "n_nationkey"),
    ("sku_info", "insert", "clickhouse", "any", None, None),
]


def rules(spark: SparkSession) -> DataFrame:
    """The routing rules of the change records (configuration, not data)."""
    return spark.createDataFrame(
        [(*r, None) for r in RULES],
        "source_table string, operate_type string, sink_type string, sink_table string, "
        "sink_columns string, sink_pk string, sink_extend string",
    )


def rule_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture envelopes of a rule table: each part writes the rule of its brand and type."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    op = F.when(key % 11 == 0, "DELETE").when(key % 3 == 0, "UPDATE").when(key % 3 == 1, "CREATE").otherwise("READ")
    image = F.struct(
        F.concat(F.lit("src_"), F.col("p_brand")).alias("source_table"),
        F.lower("p_type").alias("operate_type"),
        F.when(F.col("p_size") % 2 == 0, "hbase").otherwise("kafka").alias("sink_type"),
        F.concat(F.lit("sink_"), key.cast("string")).alias("sink_table"),
        F.when(F.col("p_size") % 3 > 0, "id,name").alias("sink_columns"),
    )
    gone = key % 11 == 0
    envelope = F.struct(
        F.lit("server1.shop_rules.table_process").alias("topic"), op.alias("op"), key.alias("ts_ms"),
        F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"),
    )
    return part.select(F.to_json(envelope).alias("value"), key.alias("arrival"))


def versioned_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture envelopes that change the rules of orders and users again and again, at positions among their changes."""
    part = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    of_orders = key % 2 == 0
    image = F.struct(
        F.when(of_orders, "order_info").otherwise("user_info").alias("source_table"),
        F.when(size % 3 == 0, "insert").when(size % 3 == 1, "update").otherwise("delete").alias("operate_type"),
        F.when(size % 4 == 0, "hbase").when(size % 4 == 1, "clickhouse").otherwise("kafka").alias("sink_type"),
        F.concat(F.lit("sink_"), key.cast("string")).alias("sink_table"),
        F.when((size % 5 > 0) & of_orders, "o_orderkey,o_orderstatus").when(size % 5 > 0, "c_custkey,c_name").alias("sink_columns"),
    )
    gone = key % 11 == 0
    envelope = F.struct(
        F.lit("server1.shop_rules.table_process").alias("topic"), F.when(gone, "DELETE").otherwise("UPDATE").alias("op"),
        (key * 7).alias("ts_ms"), F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"),
    )
    return part.select(F.to_json(envelope).alias("value"))


def damaged_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture envelopes, some of them cut short, without an operation or without an image, by their number."""
    case = F.col("arrival") % 29
    value = (
        F.when(case == 1, F.expr("substr(value, 1, length(value) DIV 4)"))
        .when(case == 2, F.regexp_replace("value", '"op":"[A-Z]+",', ""))
        .when(case == 3, F.regexp_replace("value", '"(after|before)":', '"other":'))
        .otherwise(F.col("value"))
    )
    return rule_envelopes(spark, sf_dir).select(value.alias("value"), "arrival")


def status_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed changes of a customer dimension: each order changes its customer.

    Some changes leave a column out, some write a null.
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    key = F.col("o_orderkey")
    record = F.struct(
        F.when(key % 17 == 0, "delete").otherwise("update").alias("type"),
        F.struct(
            F.col("o_custkey").cast("string").alias("id"),
            F.when(key % 3 == 0, F.col("o_orderstatus")).alias("status"),
            F.when(key % 4 > 0, F.col("o_orderpriority")).alias("priority"),
            F.when(key % 7 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_day"),
        ).alias("data"),
    )
    # A null that is present: written on orders whose key divides by 5.
    text = F.to_json(record)
    text = F.when(key % 5 == 0, F.regexp_replace(text, r'"priority":"[^"]*"', '"priority":null')).otherwise(text)
    change = F.from_json(text, "type STRING, data MAP<STRING, VARIANT>")
    return orders.select(F.inline(F.array(change)), key.alias("arrival"))


def _order_time(order_key: Column, order_date: Column) -> Column:
    return F.unix_timestamp(order_date.cast("timestamp")) + order_key % 86400


def _clock(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order topic: one record per order, at a second of its day."""
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    seconds = _order_time(F.col("o_orderkey"), F.col("o_orderdate"))
    total = F.col("o_totalprice").cast("decimal(16,2)")
    record = F.struct(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
        total.alias("total_amount"), total.alias("original_total_amount"),
        _clock(seconds).alias("create_time"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("create_date"),
    )
    return orders.select(F.to_json(record).alias("value"), F.col("o_orderkey").alias("arrival"))


def detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order line topic: one record per line, up to six seconds off its order."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    seconds = _order_time(F.col("o_orderkey"), F.col("o_orderdate")) + (F.col("l_linenumber") - 4) * 2
    record = F.struct(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), F.col("l_extendedprice").cast("decimal(16,2)").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku-"), F.col("l_partkey").cast("string")).alias("sku_name"),
        _clock(seconds).alias("create_time"),
        F.col("l_extendedprice").cast("decimal(16,2)").alias("split_total_amount"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount").cast("decimal(16,2)")).alias("split_coupon_amount"),
    )
    return joined.select(
        F.to_json(record).alias("value"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival")
    )


def rough_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose amounts are written with many decimals, or as cents with an exponent, by their number."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey")
    number = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(16,2)").cast("string")
    case = number % 4
    text = (
        F.when(case == 0, F.concat(price, F.lit("0000000000"))).when(case == 1, F.concat(price, F.lit("0000000001")))
        .when(case == 2, F.concat(F.translate(price, ".", ""), F.lit("e-2"))).otherwise(price)
    )
    template = '{"id":%d,"order_id":%d,"order_price":%s,"split_total_amount":%s,"create_time":"2024-01-01 00:00:00"}'
    value = F.format_string(template, number, F.col("l_orderkey"), text, price)
    return lines.select(value.alias("value"), number.alias("arrival"))

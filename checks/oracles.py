"""The same questions in SQL, for DuckDB over the same tables."""

from __future__ import annotations

HOUR_MS = 3_600_000

EVENTS = r"""
    e AS (
        SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ts, CAST(ts AS DATE) AS day,
               CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k
        FROM events
    ),
    logs AS (
        SELECT event_id AS arrival,
               (event_id + (k % 5) * 200) * 5 + 4 - k % 5 AS late_arrival,
               CAST(user_id AS VARCHAR) AS mid, event_type AS page_id,
               CASE WHEN event_type IN ('click', 'purchase') THEN 'home' END AS last_page_id,
               event_type = 'error' AS is_start, CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
               ts, day, k
        FROM e
    )
"""

REPAIRED = f"""
    {EVENTS},
    flagged AS (
        SELECT late_arrival, first_value(day) OVER (PARTITION BY mid ORDER BY late_arrival) AS first_day
        FROM logs WHERE is_new = '1'
    ),
    repaired AS (
        SELECT l.*, CASE WHEN l.is_new = '1' AND l.day <> f.first_day THEN '0' ELSE l.is_new END AS new_flag
        FROM logs l LEFT JOIN flagged f USING (late_arrival)
    )
"""


def records(arrival: str, flag: str, source: str, ctes: str) -> str:
    return f"""
        WITH {ctes}
        SELECT CASE WHEN is_start THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic,
               {arrival} AS arrival, mid, {flag} AS is_new,
               CASE WHEN NOT is_start THEN page_id END AS page_id, CAST(NULL AS BIGINT) AS item, ts
        FROM {source}
        UNION ALL
        SELECT 'dwd_display_log', {arrival}, NULL, NULL, page_id, CAST(k * 10 + i AS BIGINT), NULL
        FROM {source}, range(4) AS r(i) WHERE NOT is_start AND i < k % 4
    """


def jumps(gap_ms: int, complete: bool = True, arrival: str = "arrival") -> str:
    cut = "" if complete else f"AND ts + {gap_ms} < (SELECT max(ts) FROM pages)"
    return f"""
        WITH {EVENTS},
        pages AS (SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, {arrival}) AS next_ts FROM logs WHERE NOT is_start)
        SELECT {arrival} AS arrival, mid, page_id, ts FROM pages
        WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_ts - ts >= {gap_ms}) {cut}
    """


ENTRIES = f"{EVENTS}, entries AS (SELECT * FROM logs WHERE NOT is_start AND last_page_id IS NULL)"

VISIT_EXACT = f"""
    WITH {ENTRIES},
    seen AS (SELECT *, lag(day) OVER (PARTITION BY mid ORDER BY late_arrival) AS last_day FROM entries)
    SELECT late_arrival AS arrival, mid, page_id, ts, day AS visit_date FROM seen
    WHERE last_day IS NULL OR last_day <> day
"""

VISIT_DAILY = f"""
    WITH {ENTRIES},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY mid, day ORDER BY late_arrival) AS n FROM entries)
    SELECT late_arrival AS arrival, mid, page_id, ts, day AS visit_date FROM ranked WHERE n = 1
"""

OPERATION = """CASE WHEN {key} % 10 <= 5 THEN 'insert' WHEN {key} % 10 = 6 THEN 'bootstrap-insert'
                    WHEN {key} % 10 <= 8 THEN 'update' ELSE 'delete' END"""


INEXACT = ("o_totalprice", "o_orderdate", "c_acctbal", "p_retailprice")


def _content(columns: str, only: str | None = None) -> str:
    names = [c for c in columns.split(",") if c not in INEXACT and (only is None or c in only.split(","))]
    return "concat_ws('|', " + ", ".join(names) + ")"


def _changed(source: str, table: str, key: str, columns: str, kept: dict[str, str] = {}) -> str:
    op = OPERATION.format(key=key)
    cases = " ".join(f"WHEN '{k}' THEN {_content(columns, v)}" for k, v in kept.items())
    content = f"CASE replace({op}, 'bootstrap-', '') {cases} ELSE {_content(columns)} END" if kept else _content(columns)
    return f"""SELECT '{source}' AS source, {op} AS op, CAST({key} AS BIGINT) AS arrival, '{columns}' AS columns,
                      {content} AS content FROM {table}"""


CHANGES = f"""
    changes AS (
        {_changed('order_info', 'orders', 'o_orderkey',
                  'o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus,o_totalprice', {'update': 'o_orderkey,o_orderstatus'})}
        UNION ALL {_changed('user_info', 'customer', 'c_custkey', 'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey',
                           {'insert': 'c_custkey,c_name,c_nationkey', 'update': 'c_custkey,c_nationkey'})}
        UNION ALL {_changed('base_province', 'nation', 'n_nationkey', 'n_name,n_nationkey,n_regionkey', {'insert': 'n_nationkey'})}
        UNION ALL {_changed('sku_info', 'part', 'p_partkey', 'p_brand,p_name,p_partkey,p_retailprice,p_size,p_type')}
        UNION ALL SELECT 'user_info', NULL, s_suppkey, 'c_custkey', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 6 = 4
    ),
    normal AS (SELECT source, CASE WHEN op = 'bootstrap-insert' THEN 'insert' ELSE op END AS op, arrival, columns, content FROM changes),
    rules(source, op, sink_type, sink_table, kept) AS (
        VALUES ('order_info', 'insert', 'kafka', 'dwd_order_info', NULL),
               ('order_info', 'update', 'kafka', 'dwd_order_info_update', 'o_orderkey,o_orderstatus'),
               ('user_info', 'insert', 'hbase', 'dim_user_info', 'c_custkey,c_name,c_nationkey'),
               ('user_info', 'update', 'hbase', 'dim_user_info', 'c_custkey,c_nationkey'),
               ('base_province', 'insert', 'hbase', 'dim_base_province', 'n_nationkey'),
               ('sku_info', 'insert', 'clickhouse', 'any', NULL)
    ),
    routed AS (
        SELECT n.source AS "table", n.op AS type, arrival, r.sink_type, r.sink_table, coalesce(r.kept, n.columns) AS columns, n.content
        FROM normal n LEFT JOIN rules r ON n.source = r.source AND n.op = r.op
    )
"""

ROUTED = 'SELECT "table", type, arrival, sink_table, columns, content FROM routed'

RULE_HISTORY = """
    history AS (
        SELECT p_partkey AS version, 'src_' || p_brand AS source_table, lower(p_type) AS operate_type,
               CASE WHEN p_size % 2 = 0 THEN 'hbase' ELSE 'kafka' END AS sink_type, 'sink_' || p_partkey AS sink_table,
               CASE WHEN p_size % 3 > 0 THEN 'id,name' END AS sink_columns, p_partkey % 11 = 0 AS gone
        FROM part
    )
"""


def current_rules(kept: str, final: str) -> str:
    return f"""
        WITH {RULE_HISTORY},
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source_table, operate_type ORDER BY version DESC) AS n
            FROM history WHERE {kept}
        )
        SELECT source_table, operate_type, sink_type, sink_table, sink_columns FROM ranked WHERE n = 1 AND {final}
    """


AS_OF = f"""
    WITH {CHANGES},
    versions AS (
        SELECT CASE WHEN p_partkey % 2 = 0 THEN 'order_info' ELSE 'user_info' END AS of_table,
               CASE p_size % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS of_type,
               CASE p_size % 4 WHEN 0 THEN 'dim' WHEN 1 THEN 'unrouted' ELSE 'fact' END AS route,
               'sink_' || p_partkey AS sink_table, p_partkey % 11 = 0 AS gone, p_partkey * 7 AS since,
               CASE WHEN p_size % 5 > 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'o_orderkey,o_orderstatus' ELSE 'c_custkey,c_name' END END AS kept
        FROM part
    ),
    found AS (
        SELECT n.*, v.route, v.sink_table, v.kept, v.since IS NOT NULL AND NOT v.gone AS held
        FROM normal n ASOF LEFT JOIN versions v ON n.source = v.of_table AND n.op = v.of_type AND n.arrival >= v.since
    )
    SELECT source AS "table", op AS type, arrival,
           CASE WHEN op IS NULL THEN 'rejected' WHEN NOT held THEN 'unmatched' ELSE route END AS route,
           CASE WHEN op IS NOT NULL AND held THEN sink_table END AS sink_table,
           CASE WHEN held THEN coalesce(kept, columns) ELSE columns END AS columns
    FROM found
"""

FACTS = """
    SELECT CASE WHEN o_orderkey % 10 <= 6 THEN 'dwd_order_info' ELSE 'dwd_order_info_update' END AS topic,
           o_orderkey, CASE WHEN o_orderkey % 10 <= 6 THEN o_custkey END AS o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 10 <= 6 THEN CAST(o_totalprice AS DECIMAL(16, 2)) END AS o_totalprice
    FROM orders WHERE o_orderkey % 10 <= 8
"""


def last_write(column: str, value: str, written: str, since: str = "TRUE") -> str:
    return f"""CASE WHEN bool_or(({written}) AND {since})
                    THEN list({value} ORDER BY o_orderkey DESC) FILTER (({written}) AND {since})[1] END AS {column}"""


def status_table(deletes: bool) -> str:
    cleared = "max(CASE WHEN o_orderkey % 17 = 0 THEN o_orderkey END)" if deletes else "NULL"
    since = "(cleared IS NULL OR o_orderkey > cleared)"
    return f"""
        WITH cleared AS (SELECT o_custkey, CAST({cleared} AS BIGINT) AS cleared FROM orders GROUP BY o_custkey),
        writes AS (SELECT * FROM orders JOIN cleared USING (o_custkey) WHERE {since})
        SELECT CAST(o_custkey AS VARCHAR) AS id,
               {last_write('status', 'o_orderstatus', 'o_orderkey % 3 = 0')},
               {last_write('priority', "CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END", 'o_orderkey % 4 > 0')},
               {last_write('last_day', "strftime(o_orderdate, '%Y-%m-%d')", 'o_orderkey % 7 = 0')}
        FROM writes GROUP BY o_custkey
    """


ORDERS = """
    infos AS (
        SELECT o_orderkey AS id, o_orderkey % 25 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
               CAST(o_totalprice AS DECIMAL(16, 2)) AS total, CAST(o_orderdate AS DATE) AS day,
               epoch_ms(o_orderdate) // 1000 + o_orderkey % 86400 AS seconds
        FROM orders
    ),
    details AS (
        SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(l_extendedprice AS DECIMAL(16, 2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
               'sku-' || l_partkey AS sku_name,
               CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_discount AS DECIMAL(16, 2)) END AS split_coupon_amount,
               o.seconds + (l_linenumber - 4) * 2 AS seconds
        FROM lineitem JOIN infos o ON o.id = l_orderkey
    ),
    joined AS (
        SELECT o.*, d.id AS detail_id, d.sku_id, d.order_price, d.sku_num, d.sku_name, d.split_coupon_amount,
               d.seconds AS detail_seconds, strftime(to_timestamp(o.seconds) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS create_time
        FROM infos o JOIN details d ON d.order_id = o.id
    )
"""

WITHIN = "detail_seconds BETWEEN seconds - 5 AND seconds + 5"
SAME_DAY = "seconds // 86400 = detail_seconds // 86400"


def _nulls(kind: str, *columns: str) -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {c}" for c in columns)


def wide(condition: str) -> str:
    return f"""
    WITH {ORDERS}
    SELECT detail_id, id AS order_id, sku_id, order_price, sku_num, sku_name, province_id, order_status, user_id,
           total AS total_amount, total AS original_total_amount, order_price AS split_total_amount, split_coupon_amount,
           create_time, strftime(day, '%Y-%m-%d') AS create_date, CAST(NULL AS INTEGER) AS user_age,
           {_nulls('DECIMAL(16, 2)', 'activity_reduce_amount', 'coupon_reduce_amount', 'feight_fee',
                   'split_feight_fee', 'split_activity_amount')},
           {_nulls('BIGINT', 'spu_id', 'tm_id', 'category3_id')},
           {_nulls('VARCHAR', 'expire_time', 'operate_time', 'create_hour', 'province_name', 'province_area_code',
                   'province_iso_code', 'province_3166_2_code', 'user_gender', 'spu_name', 'tm_name', 'category3_name')}
    FROM joined WHERE {condition}
    """


def merge_wide(split_coupon: str, split_activity: str) -> str:
    def merged(name: str, mine: str, other: str) -> str:
        return f"CASE WHEN detail_id % 2 = 0 THEN {mine} ELSE {other} END AS {name}"

    return f"""
        WITH {ORDERS}
        SELECT id AS order_id, detail_id, order_status, create_time, total AS total_amount, user_id, province_id,
               total AS original_total_amount, strftime(day, '%Y-%m-%d') AS create_date, CAST(NULL AS INTEGER) AS user_age,
               {_nulls('DECIMAL(16, 2)', 'activity_reduce_amount', 'coupon_reduce_amount', 'feight_fee', 'split_feight_fee')},
               {split_activity} AS split_activity_amount,
               {_nulls('BIGINT', 'spu_id', 'tm_id', 'category3_id')},
               {_nulls('VARCHAR', 'expire_time', 'operate_time', 'create_hour', 'province_name', 'province_area_code',
                       'province_iso_code', 'province_3166_2_code', 'user_gender', 'spu_name', 'tm_name', 'category3_name')},
               {merged('sku_id', 'sku_id', 'province_id')},
               {merged('sku_name', 'sku_name', "'order-' || id")},
               {merged('order_price', 'order_price', 'total')},
               {merged('sku_num', 'sku_num', '1')},
               {split_coupon} AS split_coupon_amount, order_price AS split_total_amount
        FROM joined WHERE {SAME_DAY}
    """


USERS = """
    SELECT 'dim_user_info' AS target, CAST(c_custkey AS VARCHAR) AS c_custkey,
           CASE WHEN c_custkey % 10 <= 6 THEN c_name END AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey
    FROM customer WHERE c_custkey % 10 <= 8
"""

ALL: dict[str, str] = {
    "unique_visit_exact": VISIT_EXACT,
    "unique_visit_daily": VISIT_DAILY,
    "unique_visit_positions": f"""
        WITH {ENTRIES},
        seen AS (SELECT *, lag(day) OVER (PARTITION BY mid ORDER BY ts, arrival % 4, arrival // 4) AS last_day FROM entries)
        SELECT arrival, mid, page_id, ts, day AS visit_date FROM seen WHERE last_day IS NULL OR last_day <> day""",
    "jump_detail_10s": jumps(10_000),
    "jump_detail_1h": jumps(HOUR_MS),
    "jump_detail_6h": jumps(6 * HOUR_MS),
    "jump_detail_so_far": jumps(6 * HOUR_MS, complete=False),
    "repair_is_new": f"""
        WITH {REPAIRED}
        SELECT late_arrival AS arrival, mid, new_flag AS is_new, new_flag AS text_is_new, ts FROM repaired""",
    "log_split_page": f"WITH {EVENTS} SELECT arrival, mid, page_id, last_page_id, ts FROM logs WHERE NOT is_start",
    "log_split_start": f"""
        WITH {EVENTS} SELECT arrival, mid, 'icon' AS entry, k AS loading_time, ts FROM logs WHERE is_start""",
    "log_displays": f"""
        WITH {EVENTS} SELECT arrival, CAST(k * 10 + i AS BIGINT) AS item, CAST(i AS BIGINT) AS order_no, page_id
        FROM logs, range(4) AS r(i) WHERE NOT is_start AND i < k % 4""",
    "log_records": records("arrival", "is_new", "logs", EVENTS),
    "log_quarantine": """
        SELECT event_id AS arrival,
               CASE event_id % 8 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'no_common' WHEN 3 THEN 'no_mid'
                    WHEN 4 THEN 'no_page' WHEN 5 THEN 'no_ts' ELSE 'bad_display' END AS reject_reason
        FROM events WHERE event_id % 8 NOT IN (0, 6)""",
    "land_raw_log": f"WITH {EVENTS} SELECT day AS dt, mid, ts FROM logs",
    "topic_round_trip": f"""
        WITH {EVENTS} SELECT arrival, mid, 'icon' AS entry, k AS loading_time, ts FROM logs WHERE is_start""",
    "run_logs": records("late_arrival", "new_flag", "repaired", REPAIRED),
    "run_visits": f"""
        WITH {EVENTS},
        seen AS (
            SELECT 'dwm_unique_visit' AS topic, arrival FROM ({VISIT_EXACT})
            UNION ALL
            SELECT 'dwm_user_jump_detail', arrival FROM ({jumps(10_000, arrival="late_arrival")})
        )
        SELECT topic, late_arrival AS arrival, mid, page_id, last_page_id, is_new, k % 4 AS n_displays, ts
        FROM seen JOIN logs ON late_arrival = seen.arrival""",
    "page_predicates": f"""
        WITH {EVENTS} SELECT arrival, last_page_id IS NULL AS is_entry, page_id <> '' AS is_page FROM logs WHERE NOT is_start""",
    "cdc_clean": f"""
        WITH {CHANGES} SELECT source AS "table", op AS type, arrival, CAST(len(string_split(columns, ',')) AS INTEGER) AS n_columns
        FROM changes""",
    "cdc_route_dim": f"WITH {CHANGES} {ROUTED} WHERE sink_type = 'hbase'",
    "cdc_route_fact": f"WITH {CHANGES} {ROUTED} WHERE sink_type = 'kafka'",
    "cdc_unrouted": f"WITH {CHANGES} {ROUTED} WHERE sink_type = 'clickhouse'",
    "cdc_unmatched": f"""
        WITH {CHANGES} SELECT "table", type, arrival FROM routed WHERE sink_type IS NULL AND type IS NOT NULL""",
    "cdc_rejected": f'WITH {CHANGES} SELECT "table", type, arrival FROM routed WHERE type IS NULL',
    "cdc_route_as_of": AS_OF,
    "cdc_rule_flatten": f"""
        WITH {RULE_HISTORY}
        SELECT 'shop_rules' AS "database", 'table_process' AS "table", version,
               CASE WHEN gone THEN 'delete' WHEN version % 3 = 0 THEN 'update' WHEN version % 3 = 1 THEN 'insert'
                    ELSE 'read' END AS type,
               CASE WHEN NOT gone THEN source_table END AS source_table,
               CAST(CASE WHEN gone THEN 0 WHEN sink_columns IS NULL THEN 4 ELSE 5 END AS INTEGER) AS n_fields
        FROM history""",
    "cdc_current_rules": current_rules("NOT gone", "TRUE"),
    "cdc_current_rules_deletes": current_rules("TRUE", "NOT gone"),
    "rules_from_files": current_rules("NOT gone", "TRUE"),
    "fact_topics": FACTS,
    "dim_rules": f"""
        WITH {RULE_HISTORY}
        SELECT sink_table, 'id' AS pk, sink_columns AS columns,
               CASE WHEN sink_columns IS NULL THEN 'no_columns' END AS reject_reason
        FROM history WHERE sink_type = 'hbase'""",
    "dim_rejects": """
        SELECT o_orderkey AS arrival, 'unknown_column' AS reject_reason FROM orders WHERE o_orderkey % 7 = 0""",
    "dim_upsert": status_table(False),
    "dim_upsert_deletes": status_table(True),
    "dim_table_batches": status_table(False),
    "order_parse_info": f"""
        WITH {ORDERS}
        SELECT id, user_id, total AS total_amount, strftime(day, '%Y-%m-%d') AS create_date,
               strftime(to_timestamp(seconds) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS create_time,
               seconds // 86400 * 86400000 AS create_ts
        FROM infos""",
    "order_parse_detail": f"""
        WITH {ORDERS}
        SELECT id, order_id, sku_id, order_price, sku_num, seconds * 1000 AS create_ts,
               strftime(to_timestamp(seconds) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS create_time
        FROM details""",
    "run_order_wide": wide(WITHIN),
    "order_quarantine": f"""
        WITH damaged AS (
            SELECT 'dwd_order_info' AS source, o_orderkey AS arrival FROM orders
            UNION ALL SELECT 'dwd_order_detail', l_orderkey * 8 + l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        )
        SELECT source, arrival, CASE arrival % 50 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'no_key' ELSE 'no_create_time' END AS reject_reason
        FROM damaged WHERE arrival % 50 IN (1, 2, 3)""",
    "order_amounts": """
        WITH lines AS (
            SELECT l_orderkey * 8 + l_linenumber AS arrival, CAST(l_extendedprice AS DECIMAL(16, 2)) AS price FROM lineitem
        )
        SELECT arrival, CASE WHEN arrival % 4 <> 1 THEN price END AS order_price, price AS split_total_amount,
               CASE WHEN arrival % 4 = 1 THEN 'unfit_amount' END AS reject_reason
        FROM lines""",
    "order_interval_join": f"""
        WITH {ORDERS}
        SELECT id AS order_id, detail_id, sku_id, seconds * 1000 AS order_ts, detail_seconds * 1000 AS detail_ts
        FROM joined WHERE detail_seconds BETWEEN seconds - 5 AND seconds + 5""",
    "order_wide_day": wide(SAME_DAY),
    "order_merge_wide": merge_wide("split_coupon_amount", "CAST(NULL AS DECIMAL(16, 2))"),
    "order_merge_wide_splits": merge_wide("coalesce(split_coupon_amount, total)", "total"),
    "stream_logs": records("late_arrival", "new_flag", "repaired", REPAIRED),
    "stream_unique_visit_exact": VISIT_EXACT,
    "stream_unique_visit_daily": VISIT_DAILY,
    "stream_unique_visit_ttl": VISIT_EXACT,
    "stream_late_rows": f"""
        WITH {EVENTS},
        pages AS (SELECT * FROM logs WHERE NOT is_start),
        cuts AS (SELECT min(ts) + (max(ts) + 1 - min(ts)) * 2 // 3 AS last_step FROM pages),
        second AS (SELECT max(ts) AS newest FROM pages, cuts WHERE ts < last_step AND arrival % 50 <> 0),
        told AS (SELECT pages.*, arrival % 50 = 0 AND ts < newest AS late FROM pages, second),
        followed AS (SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, arrival) AS next_ts FROM told WHERE NOT late)
        SELECT 'rejected_records' AS topic, arrival, 'late' AS reject_reason FROM told WHERE late
        UNION ALL
        SELECT 'dwm_user_jump_detail', arrival, NULL FROM followed
        WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_ts - ts >= 10000) AND ts + 10000 < (SELECT max(ts) FROM pages)""",
    "stream_jump_detail": jumps(10_000, complete=False),
    "stream_order_wide": wide(WITHIN),
    "stream_order_wide_day": wide(SAME_DAY),
    "stream_changes": f"""
        {USERS} UNION ALL
        SELECT 'dim_base_province', CAST(n_nationkey AS VARCHAR), NULL, NULL FROM nation WHERE n_nationkey % 10 <= 6
        UNION ALL
        SELECT topic, CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_custkey AS VARCHAR) FROM ({FACTS})""",
    "stream_rules": f"""
        SELECT *, CAST(NULL AS VARCHAR) AS reject_reason, CAST(NULL AS BIGINT) AS arrival
        FROM ({current_rules("NOT gone AND version % 29 NOT IN (1, 2, 3)", "TRUE")})
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, CASE p_partkey % 29 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'no_op' ELSE 'no_image' END, p_partkey
        FROM part WHERE p_partkey % 29 IN (1, 2, 3)""",
    "two_jobs_one_store": f"""
        SELECT topic, arrival FROM ({records("arrival", "is_new", "logs", EVENTS)})
        UNION ALL SELECT 'dwm_unique_visit', arrival FROM ({VISIT_EXACT.replace("late_arrival", "arrival")})
        UNION ALL SELECT 'dwm_user_jump_detail', arrival FROM ({jumps(10_000, complete=False)})
        UNION ALL SELECT topic, o_orderkey FROM ({FACTS})""",
    "repair_rough_json": f"""
        WITH {REPAIRED}
        SELECT form, late_arrival AS arrival, mid, new_flag AS is_new, ts FROM repaired, (VALUES ('batch'), ('stream')) f(form)""",
    "display_repeated_keys": f"""
        WITH {EVENTS}
        SELECT arrival, '{{"item":' || (k * 10 + i) || ',"order":' || i || ',"page_id":"' || page_id || '"}}' AS value
        FROM logs, range(4) AS r(i) WHERE NOT is_start AND i < k % 4""",
    "cdc_repeated_keys": """
        SELECT o_orderkey AS arrival, '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' AS data FROM orders""",
}

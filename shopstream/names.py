"""Topic, sink and namespace names other systems rely on."""

ODS_LOG = "ods_base_log"
ODS_CHANGES = "ods_base_db_m"
START_LOG = "dwd_start_log"
PAGE_LOG = "dwd_page_log"
DISPLAY_LOG = "dwd_display_log"
ORDER_INFO = "dwd_order_info"
ORDER_DETAIL = "dwd_order_detail"
UNIQUE_VISIT = "dwm_unique_visit"
USER_JUMP = "dwm_user_jump_detail"
# Our own: changes of the rule table, as capture envelopes.
ODS_RULES = "ods_rules"
DEFAULT_TOPIC = "DEFAULT_DATA"
# Our own: raw records that a job could not use, with the reason.
REJECTED = "rejected_records"

SINK_DIMENSION = "hbase"
SINK_FACT = "kafka"

# Default primary key of a dimension table whose rule names none.
DEFAULT_PK = "id"

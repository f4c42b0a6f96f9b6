"""Declared schemas: the wire event and the tables derived from it."""

from pyspark.sql import types as T

# Field names and types of one wire event.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("amount", T.DoubleType()),
    ]
)

EVENT_FIELDS = tuple(EVENT_SCHEMA.fieldNames())

PARSED_SCHEMA = (
    T.StructType(list(EVENT_SCHEMA.fields))
    .add("event_ts", T.TimestampType())
    .add("event_date", T.DateType())
)

# Landed rows: the event fields, when they were landed, the text of a rejected row, and the partition columns: what kind of
# row it is and its date.
LANDED_SCHEMA = T.StructType(
    [
        *PARSED_SCHEMA.fields[:-1], T.StructField("landed_at", T.TimestampType()), T.StructField("value", T.StringType()),
        T.StructField("kind", T.StringType()), PARSED_SCHEMA.fields[-1],
    ]
)
EVENTS_SCHEMA = T.StructType([f for f in LANDED_SCHEMA.fields if f.name not in ("value", "kind")])

WIRE_SCHEMA = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)

SLIDING_SCHEMA = (
    "window_start timestamp, window_end timestamp, event_count long, active_users long, "
    "revenue double, count_pageview long, count_click long, count_purchase long, "
    "count_search long, event_date date"
)

# Columns of the metric tables, in order.
TUMBLING_COLUMNS = (
    "window_start", "window_end", "total_events", "unique_users", "unique_sessions", "purchase_count", "total_revenue",
    "avg_order_value", "page_views", "clicks", "searches",
)
SLIDING_COLUMNS = (
    "window_start", "window_end", "event_count", "active_users", "revenue", "count_pageview", "count_click", "count_purchase",
    "count_search",
)
REVENUE_COLUMNS = ("window_start", "revenue", "order_count", "avg_order", "max_order")
DEVICE_COLUMNS = ("window_start", "device", "event_count", "unique_users")
PAGE_COLUMNS = ("window_start", "page", "view_count")

# Column order of the alert table.
ALERT_COLUMNS = (
    "alert_id",
    "alert_type",
    "severity",
    "metric",
    "current_val",
    "baseline",
    "z_score",
    "pct_change",
    "message",
    "timestamp",
    "window_start",
    "window_end",
)

# Columns of a stored alert index and of the totals beside it, as the detector's alerts make them.
INDEX_SCHEMA = (
    "alert_id string, alert_type string, severity string, metric string, current_val double, baseline double, z_score double, "
    "pct_change double, message string, timestamp timestamp, window_start timestamp, window_end timestamp, series string, "
    "indexed_at timestamp, event_date date"
)
TOTALS_SCHEMA = (
    "series string, severity string, alert_type string, alerts long, oldest timestamp, newest timestamp, event_date date"
)
# Alerts of the job also say whether they were taken back.
JOB_INDEX_SCHEMA = INDEX_SCHEMA.replace("indexed_at", "withdrawn boolean, indexed_at")

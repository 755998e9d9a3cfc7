"""Column names, types and fixed values of the click-event tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of an event.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

PARTITION_COLUMNS = ["year", "month", "day"]

# Raw and clean events share one layout: cleaning only removes rows.
BRONZE_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField(c, T.IntegerType()) for c in PARTITION_COLUMNS]
)
SILVER_SCHEMA = BRONZE_SCHEMA

# Table names, also used by the command line.
BRONZE = "bronze"
SILVER = "silver"
GOLD_DAU = "gold_dau"
GOLD_PAGE_VIEWS = "gold_page_views"
GOLD_SESSIONS = "gold_sessions"
GOLD_TABLES = [GOLD_DAU, GOLD_PAGE_VIEWS, GOLD_SESSIONS]

# The event types the default rule suite allows.
ALLOWED_EVENT_TYPES = ["click", "view", "purchase", "scroll"]

# The default watermark delay and the type counted as a page view.
WATERMARK_DELAY = "10 minutes"
PAGE_VIEW_TYPE = "view"

"""Aggregations over clean events.

Each one groups with built-in aggregates, so rows are combined in every task before
the shuffle: a hot day, page or session (also the null one) sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import whole_seconds_between
from tidemark.schema import PAGE_VIEW_TYPE, PARTITION_COLUMNS


def daily_active_users(events: DataFrame) -> DataFrame:
    """Exact number of users per day. Events without a time form a day of their own.

    Spark first reduces to one row per day and user, spread over all tasks by both,
    then counts; no task has to hold the users of a whole day.
    """
    users = F.count_distinct("user_id").alias("daily_active_users")
    return events.groupBy(*PARTITION_COLUMNS).agg(users)


def page_views(events: DataFrame) -> DataFrame:
    """Number of view events per page; events without a page form one group."""
    views = events.filter(F.col("event_type") == PAGE_VIEW_TYPE)
    return views.groupBy("page").agg(F.count(F.lit(1)).alias("total_views"))


def session_metrics(events: DataFrame) -> DataFrame:
    """Events, first and last time, and length per ``session_id``.

    Sessions are given by their id, not found by a time gap, and aren't split by day
    or user. All events without an id form one session.
    """
    sessions = events.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events_in_session"),
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
    )
    length = whole_seconds_between(F.col("session_start"), F.col("session_end"))
    return sessions.withColumn("duration_seconds", length)

"""Small queries over published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_days(dau: DataFrame, k: int = 5) -> DataFrame:
    """The latest ``k`` days; a day without a date comes last."""
    return dau.orderBy(F.desc("year"), F.desc("month"), F.desc("day")).limit(k)


def earliest_days(dau: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` days; a day without a date comes first."""
    return dau.orderBy("year", "month", "day").limit(k)


def top_pages(views: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most viewed pages, equal counts by page name."""
    return views.orderBy(F.desc("total_views"), F.asc("page")).limit(k)


def engagement(sessions: DataFrame) -> DataFrame:
    """One row over all sessions.

    The session without an id isn't counted, but its length and events do enter the
    average and the maximum. Sessions without times don't enter the average.
    """
    # The three column names.
    return sessions.agg(
        F.count("session_id").alias("total_sessions"),
        F.round(F.avg("duration_seconds"), 2).alias("avg_session_length_seconds"),
        F.max("events_in_session").alias("max_clicks_in_one_session"),
    )


def silver_sample(silver: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` clean events; no order, so only as many files as needed are read."""
    return silver.select("user_id", "event_type", "page", "device", "timestamp").limit(n)


def session_sample(sessions: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` sessions."""
    return sessions.select("session_id", "events_in_session", "duration_seconds").limit(n)

from tidemark.operators.clean import clean, drop_nulls, keep_allowed, keep_first
from tidemark.operators.contracts import (
    ContractViolation,
    gate,
    profile,
    unexpected_values,
    validate,
    verdict,
)
from tidemark.operators.families import observed_quantiles
from tidemark.operators.gold import daily_active_users, page_views, session_metrics
from tidemark.operators.report import (
    earliest_days,
    engagement,
    latest_days,
    session_sample,
    silver_sample,
    top_pages,
)

__all__ = [
    "ContractViolation",
    "clean",
    "daily_active_users",
    "drop_nulls",
    "earliest_days",
    "engagement",
    "gate",
    "keep_allowed",
    "keep_first",
    "latest_days",
    "observed_quantiles",
    "page_views",
    "profile",
    "session_metrics",
    "session_sample",
    "silver_sample",
    "top_pages",
    "unexpected_values",
    "validate",
    "verdict",
]

"""Cleaning as rows arrive: the suite's steps on a stream."""

from __future__ import annotations

import logging
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame

from tidemark.operators import drop_nulls, keep_allowed
from tidemark.schema import WATERMARK_DELAY
from tidemark.sources.suite import (
    CLICKSTREAM_SUITE,
    IN_SET,
    NOT_NULL,
    UNIQUE,
    Rule,
    SuiteError,
    column_of,
    load_suite,
)

log = logging.getLogger(__name__)


def clean_stream(
    events: DataFrame,
    suite: Any = CLICKSTREAM_SUITE,
    delay: str = WATERMARK_DELAY,
    event_time: str = "timestamp",
) -> DataFrame:
    """``clean`` on a stream without a watermark: each rule as a step, in the order the suite lists them.

    Uniqueness keeps the first row of a key that arrives, where the batch keeps the earliest one, and
    drops those whose time is less than ``delay`` after it; a key is remembered until the watermark is
    past its time by ``delay``, so state follows the rows of that span and not the stream. Rows behind the
    watermark are late: with a uniqueness rule they are dropped, as no state tells any more whether
    they are repeats. Rows without a time share the batch's rule: all null keys share one row.

    The state of a key is in one task's store; a hot key is one entry however many rows it has. Rules
    without a cleaning step are skipped with a note in the log, as on a batch.
    """
    rules = load_suite(suite).bind(events).rules
    if any(rule.kind == UNIQUE for rule in rules):
        events = events.withWatermark(column_of(events, event_time, "event_time"), delay)

    def step(current: DataFrame, rule: Rule) -> DataFrame:
        if rule.kind == NOT_NULL:
            return drop_nulls(current, rule.column)
        if rule.kind == UNIQUE:
            return current.dropDuplicatesWithinWatermark([rule.column])
        if rule.kind == IN_SET:
            return keep_allowed(current, rule.column, rule.value_set)
        log.info("no cleaning step for %s, the rule is only checked", rule.kind)
        return current

    if not events.isStreaming:
        raise SuiteError("clean_stream wants a stream; use clean for a table")
    return reduce(step, rules, events)

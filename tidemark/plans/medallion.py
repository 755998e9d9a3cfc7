"""The batch run: raw events to clean events to metrics."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row

from tidemark.operators import (
    clean,
    daily_active_users,
    gate,
    page_views,
    session_metrics,
    validate,
)
from tidemark.schema import (
    GOLD_DAU,
    GOLD_PAGE_VIEWS,
    GOLD_SESSIONS,
    GOLD_TABLES,
    PARTITION_COLUMNS,
    SILVER,
)
from tidemark.sources.suite import CLICKSTREAM_SUITE, load_suite


class Store(Protocol):
    """Where tables are replaced and read back; see :mod:`tidemark.sinks`."""

    def publish(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str: ...

    def read(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class BatchResult:
    report: list[Row]
    published: dict[str, str] = field(default_factory=dict)

    @property
    def validation_passed(self) -> bool:
        return all(row["success"] for row in self.report)


def build_silver(
    bronze: DataFrame, store: Store, suite: Any = CLICKSTREAM_SUITE, on_fail: str = "warn"
) -> BatchResult:
    """Check raw events, then replace the clean table. Failed rules only warn by default."""
    rules = load_suite(suite)
    report = gate(validate(bronze, rules), on_fail)
    version = store.publish(clean(bronze, rules), SILVER, PARTITION_COLUMNS)
    return BatchResult(report, {SILVER: version})


def gold_frames(silver: DataFrame) -> dict[str, DataFrame]:
    """The metric tables by name, not yet computed."""
    return {
        GOLD_DAU: daily_active_users(silver),
        GOLD_PAGE_VIEWS: page_views(silver),
        GOLD_SESSIONS: session_metrics(silver),
    }


def build_gold(
    silver: DataFrame, store: Store, names: Sequence[str] = tuple(GOLD_TABLES)
) -> dict[str, str]:
    """Replace the metric tables, or those named; each reads only the columns it needs.

    Give a stored table: a plan that still cleans would clean once per metric table.

    They don't depend on each other, so their jobs are submitted together and one
    fills the slots the last tasks of another leave idle. Each table is replaced whole,
    but not all three at once. No order is stored: the report queries sort anyway.
    """
    frames = {name: df for name, df in gold_frames(silver).items() if name in names}
    publish = inheritable_thread_target(silver.sparkSession)(store.publish)
    with ThreadPoolExecutor(len(frames)) as pool:
        running = {name: pool.submit(publish, df, name) for name, df in frames.items()}
    return {name: job.result() for name, job in running.items()}


def run_batch(
    bronze: DataFrame, store: Store, suite: Any = CLICKSTREAM_SUITE, on_fail: str = "warn"
) -> BatchResult:
    """Recompute everything. The metrics start only after the clean table is published,
    and read that published version instead of cleaning again."""
    result = build_silver(bronze, store, suite, on_fail)
    gold = build_gold(store.read(SILVER), store)
    return BatchResult(result.report, {**result.published, **gold})


def register_views(store: Store, names: Sequence[str] = (SILVER, *GOLD_TABLES)) -> None:
    """Make published tables available to SQL under their names, and sessions also as
    ``sessions``. A view keeps the version that was current when it was made."""
    for name in names:
        df = store.read(name)
        df.createOrReplaceTempView(name)
        if name == GOLD_SESSIONS:
            df.createOrReplaceTempView("sessions")

"""A plain-Python model of cleaning, checks and metrics for small inputs."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import UTC, datetime

from tidemark.schema import BRONZE_SCHEMA
from tidemark.sources import IN_SET, NOT_NULL, UNIQUE

COLUMNS = BRONZE_SCHEMA.fieldNames()


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text).replace(tzinfo=UTC)


def event(event_id, user_id, event_type, time="2024-01-02T00:00:00", **other) -> dict:
    when = at(time)
    parts = (None,) * 3 if when is None else (when.year, when.month, when.day)
    defaults = {"session_id": "s", "page": "/home", "device": "mobile"}
    row = {"event_id": event_id, "user_id": user_id, "event_type": event_type, "timestamp": when}
    return {**defaults, **row, **dict(zip(("year", "month", "day"), parts)), **other}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], BRONZE_SCHEMA)


def tuples(rows):
    """Rows as sorted tuples; times as zone-free UTC text."""

    def plain(value):
        if isinstance(value, datetime):
            value = value.astimezone(UTC) if value.tzinfo else value
            return value.replace(tzinfo=None).isoformat(timespec="microseconds")
        return value

    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def model_tuples(rows, columns=COLUMNS):
    return tuples([tuple(r[c] for c in columns) for r in rows])


def clean(rows, rules, order_by="timestamp"):
    for rule in rules:
        if rule.kind == NOT_NULL:
            rows = [r for r in rows if r[rule.column] is not None]
        elif rule.kind == IN_SET:
            rows = [r for r in rows if r[rule.column] in rule.value_set]
        else:
            groups = defaultdict(list)
            for r in rows:
                groups[r[rule.column]].append(r)
            rows = [min(g, key=lambda r: _order(r, rule.column, order_by)) for g in groups.values()]
    return rows


def _order(row, key, order_by):
    first = row[order_by]
    rest = [row[c] for c in COLUMNS if c not in (key, order_by)]
    return (first is None, first or 0, [(v is not None, v if v is not None else 0) for v in rest])


def check(rows, rules):
    """(position, element, missing, unexpected) per rule."""
    found = []
    for i, rule in enumerate(rules, 1):
        values = [r[rule.column] for r in rows]
        present = [v for v in values if v is not None]
        missing = len(values) - len(present)
        if rule.kind == NOT_NULL:
            bad = missing
        elif rule.kind == UNIQUE:
            bad = sum(n for n in Counter(present).values() if n > 1)
        else:
            bad = sum(v not in rule.value_set for v in present)
        found.append((i, len(values), missing, bad))
    return found


def daily_active_users(rows):
    days = defaultdict(set)
    for r in rows:
        days[r["year"], r["month"], r["day"]].add(r["user_id"])
    return [(*day, len(users - {None})) for day, users in days.items()]


def page_views(rows):
    return list(Counter(r["page"] for r in rows if r["event_type"] == "view").items())


def session_metrics(rows):
    sessions = defaultdict(list)
    for r in rows:
        sessions[r["session_id"]].append(r["timestamp"])
    found = []
    for session, times in sessions.items():
        known = [t for t in times if t is not None]
        start, end = min(known, default=None), max(known, default=None)
        length = int(end.timestamp() // 1 - start.timestamp() // 1) if known else None
        found.append((session, len(times), start, end, length))
    return found

from tidemark.sources.stream import read_stream
from tidemark.sources.suite import (
    BETWEEN,
    CLICKSTREAM_SUITE,
    COLUMN_EXISTS,
    COMPOUND,
    DECREASING,
    DISTINCT_CONTAIN,
    DISTINCT_EQUAL,
    DISTINCT_IN,
    INCREASING,
    IN_SET,
    LENGTHS,
    MATCHES,
    MEDIAN,
    NOT_IN_SET,
    NOT_NULL,
    NULL,
    PAIR_EQUAL,
    PAIR_GREATER,
    PAIR_IN,
    QUANTILES,
    ROW_COUNT,
    UNIQUE,
    Rule,
    Suite,
    SuiteError,
    load_suite,
)
from tidemark.sources.tables import read_events, read_table

__all__ = [
    "BETWEEN",
    "CLICKSTREAM_SUITE",
    "COLUMN_EXISTS",
    "COMPOUND",
    "DECREASING",
    "DISTINCT_CONTAIN",
    "DISTINCT_EQUAL",
    "DISTINCT_IN",
    "INCREASING",
    "IN_SET",
    "LENGTHS",
    "MATCHES",
    "MEDIAN",
    "NOT_IN_SET",
    "NOT_NULL",
    "NULL",
    "PAIR_EQUAL",
    "PAIR_GREATER",
    "PAIR_IN",
    "QUANTILES",
    "ROW_COUNT",
    "UNIQUE",
    "Rule",
    "Suite",
    "SuiteError",
    "load_suite",
    "read_events",
    "read_stream",
    "read_table",
]

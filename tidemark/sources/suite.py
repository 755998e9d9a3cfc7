"""Rule suites: a small driver-side config that checking and cleaning share."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schema import ALLOWED_EVENT_TYPES

# The rule names a suite file uses.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"

# The names of rules that are checked but have no cleaning step.
NOT_IN_SET = "expect_column_values_to_not_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
MATCHES = "expect_column_values_to_match_regex"
NULL = "expect_column_values_to_be_null"
LENGTHS = "expect_column_value_lengths_to_be_between"
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_EXISTS = "expect_column_to_exist"
INCREASING = "expect_column_values_to_be_increasing"
DECREASING = "expect_column_values_to_be_decreasing"
QUANTILES = "expect_column_quantile_values_to_be_between"
MEDIAN = "expect_column_median_to_be_between"
DISTINCT_IN = "expect_column_distinct_values_to_be_in_set"
DISTINCT_CONTAIN = "expect_column_distinct_values_to_contain_set"
DISTINCT_EQUAL = "expect_column_distinct_values_to_equal_set"
PAIR_GREATER = "expect_column_pair_values_a_to_be_greater_than_b"
PAIR_EQUAL = "expect_column_pair_values_to_be_equal"
PAIR_IN = "expect_column_pair_values_to_be_in_set"
COMPOUND = "expect_compound_columns_to_be_unique"

# Which rows a rule over several columns ignores.
IGNORE_ALL = ("both_values_are_missing", "all_values_are_missing")
IGNORE_ANY = ("either_value_is_missing", "any_value_is_missing")
IGNORE_NONE = ("neither", "never")

# Arguments each rule needs, and those it may have; any other argument is refused.
RANGE = {"min_value", "max_value"}
RULE_ARGUMENTS: dict[str, tuple[set[str], set[str]]] = {
    NOT_NULL: ({"column"}, {"mostly"}),
    UNIQUE: ({"column"}, {"mostly"}),
    IN_SET: ({"column", "value_set"}, {"mostly"}),
    NOT_IN_SET: ({"column", "value_set"}, {"mostly"}),
    BETWEEN: ({"column"}, {"mostly", *RANGE}),
    MATCHES: ({"column", "regex"}, {"mostly"}),
    NULL: ({"column"}, {"mostly"}),
    LENGTHS: ({"column"}, {"mostly", *RANGE}),
    ROW_COUNT: (set(), RANGE),
    COLUMN_EXISTS: ({"column"}, set()),
    INCREASING: ({"column", "order_by"}, {"strictly", "mostly"}),
    DECREASING: ({"column", "order_by"}, {"strictly", "mostly"}),
    QUANTILES: ({"column", "quantile_ranges"}, {"error", "exact"}),
    MEDIAN: ({"column"}, {"error", "exact", *RANGE}),
    DISTINCT_IN: ({"column", "value_set"}, set()),
    DISTINCT_CONTAIN: ({"column", "value_set"}, set()),
    DISTINCT_EQUAL: ({"column", "value_set"}, set()),
    PAIR_GREATER: ({"column_A", "column_B"}, {"or_equal", "ignore_row_if", "mostly"}),
    PAIR_EQUAL: ({"column_A", "column_B"}, {"ignore_row_if", "mostly"}),
    PAIR_IN: ({"column_A", "column_B", "value_pairs_set"}, {"ignore_row_if", "mostly"}),
    COMPOUND: ({"column_list"}, {"ignore_row_if", "mostly"}),
}
# Rules whose share of bad values is of all rows, not of the non-null ones.
OF_ALL_ROWS = (NOT_NULL, NULL)
# Rules about a table, not about each value.
OF_TABLE = (ROW_COUNT, COLUMN_EXISTS)
# Rules about the order, the quantiles or the set of a column's values.
ORDERED = (INCREASING, DECREASING)
OF_QUANTILES = (QUANTILES, MEDIAN)
OF_DISTINCT = (DISTINCT_IN, DISTINCT_CONTAIN, DISTINCT_EQUAL)
# Rules over two columns, and those for which equal keys are counted.
PAIRS = (PAIR_GREATER, PAIR_EQUAL, PAIR_IN)
KEYS = (UNIQUE, COMPOUND)

# The default suite for click events. The order matters to cleaning.
CLICKSTREAM_SUITE = {
    "expectation_suite_name": "clickstream",
    "expectations": [
        {"expectation_type": NOT_NULL, "kwargs": {"column": "user_id"}},
        {"expectation_type": UNIQUE, "kwargs": {"column": "event_id"}},
        {
            "expectation_type": IN_SET,
            "kwargs": {"column": "event_type", "value_set": ALLOWED_EVENT_TYPES},
        },
    ],
}


class SuiteError(ValueError):
    """The suite, or its fit to a table, is wrong."""


@dataclass(frozen=True)
class Rule:
    """One expectation. ``mostly`` is the share of values that must meet it.

    A rule over several columns has ``columns`` instead of ``column`` and ignores rows where
    ``all``, ``any`` or ``none`` of them are null. ``quantiles`` are (quantile, least, most);
    ``error`` is how far a quantile's rank may be off, as a share of the rows, unless ``exact``.
    """

    kind: str
    column: str | None = None
    value_set: tuple[Any, ...] = ()
    mostly: float = 1.0
    min_value: Any = None
    max_value: Any = None
    regex: str | None = None
    columns: tuple[str, ...] = ()
    order_by: str | None = None
    strictly: bool = False
    or_equal: bool = False
    quantiles: tuple[tuple[float, Any, Any], ...] = ()
    error: float = 0.0001
    exact: bool = False
    ignore: str = "all"

    @property
    def label(self) -> str | None:
        """The column, or the columns, as a report names them."""
        return ", ".join(self.columns) if self.columns else self.column

    @property
    def ranges(self) -> tuple[tuple[float, Any, Any], ...]:
        return ((0.5, self.min_value, self.max_value),) if self.kind == MEDIAN else self.quantiles

    def bind(self, df: DataFrame) -> Rule:
        """The same rule with its columns spelled as in ``df``, and what doesn't fit them refused."""
        if self.kind in OF_TABLE:
            return self
        if self.columns:
            return replace(self, columns=tuple(column_of(df, c, self.kind) for c in self.columns))
        column = column_of(df, self.column, self.kind)
        kind = df.schema[column].dataType
        if self.kind == MATCHES:
            check_regex(df.sparkSession, self.regex)
        if self.kind in OF_QUANTILES and not _has_quantiles(kind, self.exact):
            raise SuiteError(f"{self.kind}: {column} is {kind.simpleString()}, which has no quantiles here")
        if self.kind == BETWEEN and not isinstance(kind, T.StringType):
            for bound in (self.min_value, self.max_value):
                _check_bound(df.sparkSession, bound, kind)
        order_by = column_of(df, self.order_by, self.kind) if self.kind in ORDERED else None
        return replace(self, column=column, order_by=order_by)


def check_regex(spark: SparkSession, regex: str) -> None:
    """Refuse a pattern that the tasks would fail on; evaluated while planning, without a job."""
    try:
        spark.sql("SELECT '' RLIKE :regex", args={"regex": regex}).first()
    except PySparkException as wrong:
        raise SuiteError(f"not a regular expression: {regex!r}") from wrong


def _check_bound(spark: SparkSession, bound: Any, kind: T.DataType) -> None:
    if not isinstance(bound, str):
        return
    wanted = "double" if isinstance(kind, T.NumericType) else kind.simpleString()
    if spark.sql(f"SELECT try_cast(:bound AS {wanted})", args={"bound": bound}).first()[0] is None:
        raise SuiteError(f"{bound!r} can't be compared with {kind.simpleString()}")


def _has_quantiles(kind: T.DataType, exact: bool) -> bool:
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(kind, T.NumericType) or (not exact and isinstance(kind, times))


def column_of(df: DataFrame, name: str, of: str) -> str:
    """The column of ``df`` that a caller means, whatever the case of its letters."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == str(name).lower()]
    if len(found) != 1:
        raise SuiteError(f"{of}: no column {name!r} in {df.columns}")
    return found[0]


@dataclass(frozen=True)
class Suite:
    name: str
    rules: tuple[Rule, ...]

    def bind(self, df: DataFrame) -> Suite:
        return Suite(self.name, tuple(rule.bind(df) for rule in self.rules))


def load_suite(
    source: str | Path | Mapping[str, Any] | Suite = CLICKSTREAM_SUITE,
    spark: SparkSession | None = None,
) -> Suite:
    """Read a suite from a dict, a local JSON file, or (given ``spark``) any path Spark reads.

    Rule names and arguments are checked here, so a typo fails before any job runs; regular
    expressions too where there is a session, else when the suite meets a table.
    """
    if isinstance(source, Suite):
        return source
    suite = _parse(source if isinstance(source, Mapping) else _read(source, spark))
    if session := spark or SparkSession.getActiveSession():
        for rule in suite.rules:
            if rule.kind == MATCHES:
                check_regex(session, rule.regex)
    return suite


def _read(source: str | Path, spark: SparkSession | None) -> Any:
    if spark is not None and not Path(source).is_file():
        text = spark.read.text(str(source), wholetext=True).first()[0]
    else:
        text = Path(source).read_text(encoding="utf-8")
    return json.loads(text)


def _parse(document: Any) -> Suite:
    if not isinstance(document, Mapping) or not isinstance(document.get("expectations"), list):
        raise SuiteError("a suite needs a list named 'expectations'")
    rules = tuple(_parse_rule(i, e) for i, e in enumerate(document["expectations"], 1))
    return Suite(str(document.get("expectation_suite_name", "")), rules)


def _parse_rule(position: int, entry: Any) -> Rule:
    if not isinstance(entry, Mapping):
        raise SuiteError(f"rule {position}: not an object")
    kind = entry.get("expectation_type")
    if kind not in RULE_ARGUMENTS:
        raise SuiteError(f"rule {position}: unknown rule {kind!r}")
    kwargs = entry.get("kwargs")
    needed, optional = RULE_ARGUMENTS[kind]
    if not isinstance(kwargs, Mapping) or not needed <= set(kwargs) <= needed | optional:
        takes = sorted(needed) + [f"[{name}]" for name in sorted(optional)]
        raise SuiteError(f"rule {position}: {kind} takes {takes}, got {kwargs!r}")
    for name in needed & {"column", "regex", "order_by", "column_A", "column_B"}:
        if not isinstance(kwargs[name], str):
            raise SuiteError(f"rule {position}: {name} must be a string")
    for name in ("strictly", "or_equal", "exact"):
        if not isinstance(kwargs.get(name, False), bool):
            raise SuiteError(f"rule {position}: {name} must be true or false")
    values = kwargs.get("value_set", [])
    if not isinstance(values, (list, tuple)) or not all(map(_is_plain, values)):
        raise SuiteError(f"rule {position}: value_set must be a list of plain values")
    mostly = kwargs.get("mostly", 1.0)
    if isinstance(mostly, bool) or not isinstance(mostly, (int, float)) or not 0 <= mostly <= 1:
        raise SuiteError(f"rule {position}: mostly must be a number from 0 to 1")
    if not all(map(_is_plain, (kwargs.get(name) for name in RANGE))):
        raise SuiteError(f"rule {position}: min_value and max_value must be plain values")
    if optional >= RANGE and all(kwargs.get(name) is None for name in RANGE):
        raise SuiteError(f"rule {position}: give min_value, max_value or both")
    error = kwargs.get("error", Rule.error)
    if isinstance(error, bool) or not isinstance(error, (int, float)) or not 0 < error < 1:
        raise SuiteError(f"rule {position}: error must be a number between 0 and 1")
    if kind == PAIR_IN:
        values = _pairs(position, kwargs["value_pairs_set"])
    return Rule(
        kind,
        kwargs.get("column"),
        # Nulls never count as a value of the set, so one listed there changes nothing.
        tuple(v for v in values if v is not None),
        float(mostly),
        kwargs.get("min_value"),
        kwargs.get("max_value"),
        kwargs.get("regex"),
        _columns(position, kind, kwargs),
        kwargs.get("order_by"),
        kwargs.get("strictly", False),
        kwargs.get("or_equal", False),
        _quantiles(position, kwargs["quantile_ranges"]) if kind == QUANTILES else (),
        float(error),
        kwargs.get("exact", False),
        _ignored(position, kwargs.get("ignore_row_if")),
    )


def _columns(position: int, kind: str, kwargs: Mapping[str, Any]) -> tuple[str, ...]:
    if kind in PAIRS:
        return (kwargs["column_A"], kwargs["column_B"])
    names = kwargs.get("column_list", ())
    if kind == COMPOUND and (
        not isinstance(names, (list, tuple)) or len(names) < 2 or not all(isinstance(n, str) for n in names)
    ):
        raise SuiteError(f"rule {position}: column_list must name two columns or more")
    return tuple(names)


def _ignored(position: int, text: Any) -> str:
    for name, texts in (("all", (None, *IGNORE_ALL)), ("any", IGNORE_ANY), ("none", IGNORE_NONE)):
        if text in texts:
            return name
    raise SuiteError(f"rule {position}: ignore_row_if can't be {text!r}")


def _pairs(position: int, pairs: Any) -> list[tuple[Any, Any]]:
    good = isinstance(pairs, (list, tuple)) and all(
        isinstance(p, (list, tuple)) and len(p) == 2 and all(map(_is_plain, p)) for p in pairs
    )
    if not good:
        raise SuiteError(f"rule {position}: value_pairs_set must be a list of pairs of plain values")
    return [tuple(p) for p in pairs]


def _quantiles(position: int, given: Any) -> tuple[tuple[float, Any, Any], ...]:
    quantiles = given.get("quantiles") if isinstance(given, Mapping) else None
    ranges = given.get("value_ranges") if isinstance(given, Mapping) else None
    good = (
        isinstance(quantiles, (list, tuple))
        and isinstance(ranges, (list, tuple))
        and 0 < len(quantiles) == len(ranges)
        and all(isinstance(q, (int, float)) and not isinstance(q, bool) and 0 <= q <= 1 for q in quantiles)
        and all(isinstance(r, (list, tuple)) and len(r) == 2 and all(map(_is_plain, r)) for r in ranges)
    )
    if not good:
        raise SuiteError(f"rule {position}: quantile_ranges needs as many value_ranges of two as quantiles")
    return tuple((float(q), *r) for q, r in zip(quantiles, ranges, strict=True))


def _is_plain(value: Any) -> bool:
    return value is None or isinstance(value, (str, int, float, bool))

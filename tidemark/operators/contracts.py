"""Checking a table against a rule suite: one report row per rule."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named, percent, status_label
from tidemark.operators.clean import is_allowed
from tidemark.operators.families import (
    distinct_breaks,
    is_ignored,
    meets_pair,
    ordered_counts,
    quantiles_out_of_range,
)
from tidemark.sources.suite import (
    BETWEEN,
    CLICKSTREAM_SUITE,
    COLUMN_EXISTS,
    DISTINCT_IN,
    IN_SET,
    KEYS,
    LENGTHS,
    MATCHES,
    NOT_IN_SET,
    NOT_NULL,
    NULL,
    OF_ALL_ROWS,
    OF_DISTINCT,
    OF_QUANTILES,
    OF_TABLE,
    ORDERED,
    PAIRS,
    ROW_COUNT,
    Rule,
    SuiteError,
    load_suite,
)

log = logging.getLogger(__name__)
# Distinct values of a rule that a sample counts exactly.
TRACKED = 10_000


class ContractViolation(RuntimeError):
    """A rule failed and the gate was told to stop."""


def validate(df: DataFrame, suite: Any = CLICKSTREAM_SUITE, samples: int = 0) -> DataFrame:
    """Check every rule; one row per rule, ``position`` being its place in the suite.

    * not null: a null is unexpected.
    * in set: a non-null value outside the set is unexpected; nulls only count as
      missing, so they pass here though cleaning drops them.
    * unique: every member of a group of equal non-null values is unexpected, the
      first one too.

    * not in set, between, regex, length: a non-null value that breaks it is unexpected; a
      regex may match anywhere in the value, both ends of a range belong to it.
    * null: a value is unexpected.
    * row count, column exists: one unexpected "value" where the table breaks it.
    * increasing, decreasing: a value that breaks the order of those before it.
    * quantiles, median: quantiles outside their range.
    * distinct values: rows with a value that isn't listed, listed values that don't occur.
    * pairs of columns: rows that break it; ignored rows count as missing.
    * compound keys: as unique, over several columns whose nulls are equal; ignored rows count as missing.

    What can't be compared breaks a rule: text that is no number where a number is asked for, and NaN in a range.
    With ``samples`` the report has that column too: up to so many values that break a rule, as text, with their
    counts, from the same scan. The most frequent ones, exact up to ``TRACKED`` distinct values and estimated
    beyond; of unique rules, the most frequent key of each of so many hash buckets, exact.

    A rule succeeds when the share of values that meet it is at least its ``mostly``, which
    is all of them unless the suite says otherwise; with nothing to look at it succeeds. The
    share is of the non-null values, for both null rules of all. The input is read
    once for all rules but those about keys, which read it once per key, and about order, once each,
    so pass a stored table rather than a plan that is costly to repeat.
    """
    return _counts(df, suite, samples).withColumn("status", status_label(F.col("success")))


def profile(report: DataFrame) -> DataFrame:
    """A report's counts with percentages (null for an empty table); no further scan.

    ``unexpected_percent`` is of the values the rule looks at: the non-null ones,
    except that the null rules look at all.
    """
    elements, missing = F.col("element_count"), F.col("missing_count")
    unexpected = F.col("unexpected_count")
    looked_at = F.when(F.col("rule").isin(*OF_ALL_ROWS), elements).otherwise(elements - missing)
    return report.select(
        "position",
        "rule",
        "column",
        "element_count",
        "missing_count",
        percent(missing, elements).alias("missing_percent"),
        "unexpected_count",
        percent(unexpected, looked_at).alias("unexpected_percent"),
        percent(unexpected, elements).alias("unexpected_percent_total"),
    )


def unexpected_values(df: DataFrame, rule: Rule, limit: int | None = None) -> DataFrame:
    """The values that break a rule with their counts, as text whatever the column's type.

    All of them in no order, or with a ``limit`` the most frequent ones, sorted.
    """
    if not _has_values(rule):
        raise SuiteError(f"{rule.kind} has no values")
    rule = rule.bind(df)
    rows = df.filter(~_is_missing(rule) if rule.kind in KEYS else _is_unexpected(df, rule))
    keys = [named(c) for c in rule.columns or (rule.column,)]
    counted = rows.groupBy(*[k.alias(f"key_{i}") for i, k in enumerate(keys)])
    counted = counted.agg(F.count(F.lit(1)).alias("count"))
    if rule.kind in KEYS:
        counted = counted.filter(F.col("count") > 1)
    found = counted.select(_as_text([F.col(f"key_{i}") for i in range(len(keys))]).alias("value"), "count")
    if limit is None:
        return found
    return found.orderBy(F.desc("count"), F.asc("value")).limit(limit)


def verdict(report: DataFrame) -> DataFrame:
    """One row: whether every rule of a report succeeded."""
    passed = F.coalesce(F.bool_and("success"), F.lit(True))
    return report.agg(passed.alias("validation_passed"))


def gate(report: DataFrame, on_fail: str = "warn") -> list[Row]:
    """Run a report (a row per rule, so safe to collect) and act on failures.

    ``warn`` logs and goes on, ``raise`` stops with :class:`ContractViolation`.
    """
    if on_fail not in ("warn", "raise"):
        raise ValueError(f"on_fail must be 'warn' or 'raise', not {on_fail!r}")
    rows = sorted(report.collect(), key=lambda row: row["position"])
    failed = [row for row in rows if not row["success"]]
    for row in rows:
        log.info("[%s] %s on %s", row["status"], row["rule"], row["column"])
    if failed:
        text = ", ".join(f"{r['rule']}({r['column']}): {r['unexpected_count']}" for r in failed)
        if on_fail == "raise":
            raise ContractViolation(f"rules failed: {text}")
        log.warning("rules failed, going on with cleaning: %s", text)
    return rows


def _has_values(rule: Rule) -> bool:
    """Whether single values can break the rule."""
    return rule.kind not in (*OF_TABLE, *ORDERED, *OF_QUANTILES) and (
        rule.kind not in OF_DISTINCT or rule.kind == DISTINCT_IN
    )


def _as_text(values: Sequence[Column]) -> Column:
    """A value as text; several of them in brackets."""
    if len(values) == 1:
        return values[0].cast("string")
    texts = [F.coalesce(v.cast("string"), F.lit("null")) for v in values]
    return F.concat(F.lit("("), F.concat_ws(", ", *texts), F.lit(")"))


def _is_missing(rule: Rule) -> Column:
    return is_ignored(rule) if rule.columns else named(rule.column).isNull()


def _is_unexpected(df: DataFrame, rule: Rule) -> Column:
    if rule.kind in PAIRS:
        return ~is_ignored(rule) & ~F.coalesce(meets_pair(df, rule), F.lit(False))
    value = named(rule.column)
    if rule.kind == NOT_NULL:
        return value.isNull()
    if rule.kind == NULL:
        return value.isNotNull()
    return value.isNotNull() & ~F.coalesce(_meets(df, rule, value), F.lit(False))


def _meets(df: DataFrame, rule: Rule, value: Column) -> Column:
    if rule.kind == BETWEEN:
        return _between(value, rule, df.schema[rule.column].dataType)
    if rule.kind == LENGTHS:
        return _between(F.length(value), rule)
    if rule.kind == MATCHES:
        return value.rlike(rule.regex)
    assert rule.kind in (IN_SET, NOT_IN_SET, DISTINCT_IN)
    allowed = is_allowed(df, rule.column, rule.value_set)
    return ~F.coalesce(allowed, F.lit(False)) if rule.kind == NOT_IN_SET else allowed


def _between(value: Column, rule: Rule, kind: T.DataType | None = None) -> Column:
    """Whether a value lies in the rule's range. Text is compared with a number as a number, null if it is none."""
    ends = F.lit(True)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        ends = ~F.isnan(value)
    for bound, compare in ((rule.min_value, Column.__ge__), (rule.max_value, Column.__le__)):
        if bound is None:
            continue
        number = isinstance(bound, (int, float)) and not isinstance(bound, bool)
        if isinstance(kind, T.StringType) and not isinstance(bound, str):
            as_number = value.try_cast("double" if number else "boolean")
            ends = ends & compare(as_number, F.lit(bound)) & (~F.isnan(as_number) if number else F.lit(True))
        else:
            ends = ends & compare(value, F.lit(bound))
    return ends


def _counts(df: DataFrame, suite: Any, samples: int) -> DataFrame:
    """Element, missing and unexpected counts per rule, lazily.

    All rules but those about keys and order share one scan that shuffles a single partial row
    per task. Each key is scanned for by itself: keys are counted per task before
    the shuffle, so a hot key costs one row per task, and the exact number of rows in
    duplicate groups comes from the same pass that finds whether there are any.
    """
    placed = list(enumerate(load_suite(suite).bind(df).rules, 1))
    in_one_scan = [(i, rule) for i, rule in placed if rule.kind not in (*KEYS, *ORDERED)]
    by_key: dict[tuple, list[tuple[int, Rule]]] = {}
    for i, rule in placed:
        if rule.kind in KEYS:
            by_key.setdefault((rule.column, rule.columns, rule.ignore), []).append((i, rule))
    parts = [_unique_counts(df, rules, samples) for rules in by_key.values()]
    for i, rule in placed:
        if rule.kind in ORDERED:
            totals = tuple(F.col(c) for c in ("elements", "missing", "unexpected"))
            parts.append(_report_rows(ordered_counts(df, rule), [(i, rule, *totals, None)], samples))
    if in_one_scan:
        parts.insert(0, _row_wise_counts(df, in_one_scan, samples))
    if not parts:
        more = ", samples array<struct<value:string,count:bigint>>" if samples else ""
        return df.sparkSession.createDataFrame(
            [],
            "position int, rule string, column string, element_count bigint,"
            f" missing_count bigint, unexpected_count bigint, success boolean{more}",
        )
    return reduce(DataFrame.unionByName, parts)


def _row_wise_counts(df: DataFrame, placed: Sequence[tuple[int, Rule]], samples: int) -> DataFrame:
    totals = {"elements": F.count(F.lit(1))}
    for i, rule in placed:
        if rule.kind in OF_TABLE:
            broken = ~_table_meets(df, rule, totals["elements"])
            totals[f"missing_{i}"] = F.lit(0).cast("long")
            totals[f"unexpected_{i}"] = F.when(broken, F.lit(1)).otherwise(F.lit(0)).cast("long")
            continue
        totals[f"missing_{i}"] = F.count_if(_is_missing(rule))
        if rule.kind in OF_QUANTILES:
            totals[f"unexpected_{i}"] = quantiles_out_of_range(df, rule)
        elif rule.kind in OF_DISTINCT:
            totals[f"unexpected_{i}"] = distinct_breaks(df, rule)
        else:
            totals[f"unexpected_{i}"] = F.count_if(_is_unexpected(df, rule))
    given = {}
    if samples:
        # SQL only knows what is filtered by name, so values and verdicts become columns first.
        sampled = [(i, rule) for i, rule in placed if _has_values(rule)]
        for i, rule in sampled:
            given[f"value of rule {i}"] = _as_text([named(c) for c in rule.columns or (rule.column,)])
            given[f"rule {i} is broken"] = _is_unexpected(df, rule)
            totals[f"samples_{i}"] = F.expr(
                f"approx_top_k(`value of rule {i}`, {samples}, {max(TRACKED, samples)}) FILTER (WHERE `rule {i} is broken`)"
            )
    row = df.withColumns(given).agg(*[total.alias(name) for name, total in totals.items()])
    return _report_rows(
        row,
        [
            (
                i,
                rule,
                F.col("elements"),
                F.col(f"missing_{i}"),
                F.col(f"unexpected_{i}"),
                _pairs_of(f"samples_{i}", "item", "count") if f"samples_{i}" in totals else None,
            )
            for i, rule in placed
        ],
        samples,
    )


def _pairs_of(column: str, value: str, count: str) -> Column:
    pair = lambda x: F.struct(x[value].alias("value"), x[count].cast("long").alias("count"))
    return F.transform(column, pair)


def _table_meets(df: DataFrame, rule: Rule, rows: Column) -> Column:
    if rule.kind == ROW_COUNT:
        return _between(rows, rule)
    assert rule.kind == COLUMN_EXISTS
    return F.lit(rule.column.lower() in {c.lower() for c in df.columns})


def _unique_counts(df: DataFrame, placed: Sequence[tuple[int, Rule]], samples: int) -> DataFrame:
    rule = placed[0][1]
    names = rule.columns or (rule.column,)
    keys, n = [F.col(f"key_{i}") for i in range(len(names))], F.col("n")
    per_key = df.groupBy(*[named(c).alias(f"key_{i}") for i, c in enumerate(names)])
    per_key = per_key.agg(F.count(F.lit(1)).alias("n"))
    nulls = [key.isNull() for key in keys]
    ignored = F.lit(False) if rule.ignore == "none" else reduce(
        Column.__and__ if rule.ignore == "all" else Column.__or__, nulls
    )
    repeated = ~ignored & (n > 1)
    totals = [
        F.sum(n).alias("elements"),
        F.sum(F.when(ignored, n)).alias("missing"),
        F.sum(F.when(repeated, n)).alias("unexpected"),
    ]
    found = F.struct(n.alias("count"), _as_text(keys).alias("value"))
    for bucket in range(samples):
        inside = repeated & (F.pmod(F.xxhash64(*keys), F.lit(samples)) == bucket)
        totals.append(F.max(F.when(inside, found)).alias(f"sample_{bucket}"))
    row = per_key.agg(*totals).na.fill(0, ["elements", "missing", "unexpected"])
    some = None
    if samples:
        every = F.filter(F.array(*[F.col(f"sample_{b}") for b in range(samples)]), lambda x: x.isNotNull())
        row = row.withColumn("found", F.sort_array(every, asc=False))
        some = _pairs_of("found", "value", "count")
    counts = (F.col("elements"), F.col("missing"), F.col("unexpected"))
    return _report_rows(row, [(i, rule, *counts, some) for i, rule in placed], samples)


def _succeeds(rule: Rule, elements: Column, missing: Column, unexpected: Column) -> Column:
    if rule.mostly == 1:
        return unexpected == 0
    looked_at = elements if rule.kind in OF_ALL_ROWS else elements - missing
    share = (looked_at - unexpected) / looked_at
    return F.when(looked_at == 0, F.lit(True)).otherwise(share >= F.lit(rule.mostly))


def _report_rows(
    totals: DataFrame, lines: Sequence[tuple[int, Rule, Column, Column, Column, Column | None]], samples: int
) -> DataFrame:
    """Turn one row of totals into one row per rule."""
    none = F.array().cast("array<struct<value:string,count:bigint>>")
    structs = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(rule.kind).alias("rule"),
            F.lit(rule.label).cast("string").alias("column"),
            elements.alias("element_count"),
            missing.alias("missing_count"),
            unexpected.alias("unexpected_count"),
            _succeeds(rule, elements, missing, unexpected).alias("success"),
            *([(none if some is None else some).alias("samples")] if samples else []),
        )
        for position, rule, elements, missing, unexpected, some in lines
    ]
    return totals.select(F.inline(F.array(*structs)))

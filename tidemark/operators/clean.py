"""Cleaning: a rule suite applied to a table, in suite order."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from decimal import Context, Decimal, InvalidOperation
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named
from tidemark.sources.suite import (
    CLICKSTREAM_SUITE,
    IN_SET,
    NOT_NULL,
    UNIQUE,
    RULE_ARGUMENTS,
    Rule,
    SuiteError,
    column_of,
    load_suite,
)

log = logging.getLogger(__name__)
# Enough digits for any decimal column, so that no listed number is rounded.
EXACT = Context(prec=100)


def drop_nulls(df: DataFrame, column: str) -> DataFrame:
    """Drop rows where the column is null, or NaN as in ``dropna``. '' is not null.

    A plain ``IS NOT NULL`` reaches the Parquet scan; ``dropna`` does not.
    """
    present = named(column).isNotNull()
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        present = present & ~F.isnan(named(column))
    return df.filter(present)


def keep_first(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the earliest, ties broken by the rest of the row.

    ``order_by`` is ``timestamp`` by default, where the table has it; a column that it
    names and the table hasn't raises. The order covers every column, so only identical rows
    tie and any rerun, task retry or repartitioning keeps the same rows. A row without a value
    in ``order_by`` comes after those with one. All null keys share one row.

    ``row_number() = 1`` is cut to one row per key in each task *before* the
    shuffle, so a key that holds a third of the table sends one row per task.
    """
    if order_by is None:
        order_by = [c for c in df.columns if c.lower() == "timestamp"][:1]
    leading = [c for c in (column_of(df, c, "order_by") for c in order_by) if c != key]
    rest = [c for c in df.columns if c != key and c not in leading]
    order = [_sortable(df, c).asc_nulls_last() for c in leading]
    order += [_sortable(df, c).asc() for c in rest]
    first = Window.partitionBy(named(key)).orderBy(*(order or [named(key)]))
    rank = _unused_name(df, "row_rank")
    return (
        df.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).drop(rank)
    )


def _sortable(df: DataFrame, column: str) -> Column:
    """The column, or its text where Spark has no order for its type (maps, and what holds one)."""

    def unordered(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return unordered(kind.elementType)
        if isinstance(kind, T.StructType):
            return any(unordered(f.dataType) for f in kind)
        return isinstance(kind, (T.MapType, T.VariantType))

    value = named(column)
    return F.to_json(F.struct(value)) if unordered(df.schema[column].dataType) else value


def is_allowed(df: DataFrame, column: str, values: Sequence[Any]) -> Column:
    """Whether the value is one of ``values``, compared in the column's own type.

    A listed value that this type can't hold as it is matches nothing: a fraction for a whole
    number, a time of day for a date, anything but a boolean for a boolean. Float columns
    compare with the nearest float.
    """
    kind = df.schema[column].dataType
    fitting = [as_type(v, kind) for v in values]
    return named(column).isin([v for v in fitting if v is not None])


def as_type(value: Any, kind: T.DataType) -> Column | None:
    """A listed value as a literal of the type, or None if that loses something."""
    if isinstance(kind, T.StringType):
        return F.lit(value).cast(kind)
    if isinstance(kind, T.BooleanType) or isinstance(value, bool):
        both = isinstance(kind, T.BooleanType) and isinstance(value, bool)
        return F.lit(value) if both else None
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        try:
            number = Decimal(str(value).strip())
        except InvalidOperation:
            return None
        scale = kind.scale if isinstance(kind, T.DecimalType) else 0
        digits = kind.precision if isinstance(kind, T.DecimalType) else 19
        if not number.is_finite() or number.adjusted() >= digits - scale:
            return None
        if not number:
            return F.lit("0").try_cast(kind)
        if len(number.as_tuple().digits) > EXACT.prec or number.normalize(EXACT).as_tuple().exponent < -scale:
            return None
        return F.lit(format(number.quantize(Decimal(1).scaleb(-scale), context=EXACT), "f")).try_cast(kind)
    if isinstance(kind, T.DateType):
        day = F.lit(str(value)).try_cast(kind)
        return F.when(F.lit(str(value)).try_cast("timestamp_ntz") == day.cast("timestamp_ntz"), day)
    return F.lit(str(value) if isinstance(kind, T.DatetimeType) else value).try_cast(kind)


def keep_allowed(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Keep rows whose value is in the set; null is dropped, an empty set keeps none."""
    return df.filter(is_allowed(df, column, values))


def clean(
    df: DataFrame, suite: Any = CLICKSTREAM_SUITE, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Apply each rule as a cleaning step, in the order the suite lists them.

    Rules without such a step are only checked; they are skipped here with a note in the log.

    The order changes the result: with uniqueness before the set rule, a key whose
    kept row has a bad value disappears even if another copy was good.
    """

    def step(current: DataFrame, rule: Rule) -> DataFrame:
        if rule.kind == NOT_NULL:
            return drop_nulls(current, rule.column)
        if rule.kind == UNIQUE:
            return keep_first(current, rule.column, order_by)
        if rule.kind == IN_SET:
            return keep_allowed(current, rule.column, rule.value_set)
        if rule.kind not in RULE_ARGUMENTS:
            raise SuiteError(f"no cleaning step for rule {rule.kind!r}")
        log.info("no cleaning step for %s, the rule is only checked", rule.kind)
        return current

    return reduce(step, load_suite(suite).bind(df).rules, df)


def _unused_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name

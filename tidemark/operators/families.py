"""Rules beyond single values: order, quantiles, sets of distinct values, several columns.

Each is an aggregate that tasks compute in part and merge, with memory that follows the rule and not the
table: a sketch for quantiles, a bit per listed value for sets. Only the order needs rows side by side; it
takes them in ranges, and one value is carried from range to range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named
from tidemark.operators.clean import as_type
from tidemark.sources.suite import (
    DECREASING,
    DISTINCT_CONTAIN,
    DISTINCT_IN,
    PAIR_EQUAL,
    PAIR_IN,
    Rule,
)

BITS = 62


# ------------------------------------------------------------ several columns


def is_ignored(rule: Rule) -> Column:
    """Whether a rule over several columns leaves a row out because of its nulls."""
    nulls = [named(c).isNull() for c in rule.columns]
    if rule.ignore == "none":
        return F.lit(False)
    return reduce(and_ if rule.ignore == "all" else or_, nulls)


def meets_pair(df: DataFrame, rule: Rule) -> Column:
    """Whether a row's two values fit each other; null if that can't be told."""
    kinds = [df.schema[c].dataType for c in rule.columns]
    if rule.kind == PAIR_IN:
        return reduce(or_, [_is_pair(rule.columns, kinds, pair) for pair in rule.value_set], F.lit(False))
    a, b = (named(c) for c in rule.columns)
    texts = [isinstance(kind, T.StringType) for kind in kinds]
    if texts == [True, False]:
        a = a.try_cast(kinds[1])
    elif texts == [False, True]:
        b = b.try_cast(kinds[0])
    if rule.kind == PAIR_EQUAL:
        return a == b
    return a >= b if rule.or_equal else a > b


def _is_pair(columns: Sequence[str], kinds: Sequence[T.DataType], pair: tuple) -> Column:
    parts = []
    for column, kind, value in zip(columns, kinds, pair, strict=True):
        fitting = None if value is None else as_type(value, kind)
        if value is not None and fitting is None:
            return F.lit(False)
        parts.append(named(column).isNull() if value is None else named(column) == fitting)
    return F.coalesce(reduce(and_, parts), F.lit(False))


# ------------------------------------------------------------------ quantiles


def quantile_values(df: DataFrame, rule: Rule) -> Column:
    """The rule's quantiles as an array; values of the column, or between two of them if ``exact``."""
    value, wanted = named(rule.column), [q for q, _, _ in rule.ranges]
    if rule.exact:
        return F.percentile(value, wanted)
    return F.percentile_approx(value, wanted, math.ceil(1 / rule.error))


def is_in_range(df: DataFrame, rule: Rule, value: Column, least: object, most: object) -> Column:
    """Whether a quantile lies in its range, both ends in it; a range may be open on a side."""
    kind = df.schema[rule.column].dataType
    ends = F.lit(True)
    for bound, compare in ((least, Column.__ge__), (most, Column.__le__)):
        if bound is not None:
            number = isinstance(kind, T.NumericType)
            literal = F.lit(float(bound)) if number else F.lit(str(bound)).cast(kind)
            ends = ends & compare(value.cast("double") if number else value, literal)
    return ends


def quantiles_out_of_range(df: DataFrame, rule: Rule) -> Column:
    """How many quantiles are outside their range; none if there are no values."""
    found = quantile_values(df, rule)
    out = [
        F.when(is_in_range(df, rule, F.get(found, F.lit(i)), least, most), 0).otherwise(1)
        for i, (_, least, most) in enumerate(rule.ranges)
    ]
    return F.when(found.isNull(), F.lit(0)).otherwise(reduce(Column.__add__, out)).cast("long")


def observed_quantiles(df: DataFrame, rule: Rule) -> DataFrame:
    """One row per quantile of the rule, with its value in the table."""
    rule = rule.bind(df)
    row = df.agg(quantile_values(df, rule).alias("found"))
    lines = [
        F.struct(
            F.lit(q).alias("quantile"),
            F.get("found", F.lit(i)).alias("value"),
            is_in_range(df, rule, F.get("found", F.lit(i)), least, most).alias("success"),
        )
        for i, (q, least, most) in enumerate(rule.ranges)
    ]
    return row.select(F.inline(F.array(*lines)))


# ------------------------------------------------------------ distinct values


def distinct_breaks(df: DataFrame, rule: Rule) -> Column:
    """How often the set of the column's values breaks the rule: rows with a value that isn't listed, unless
    more may occur, and listed values that don't occur, unless some may lack."""
    kind, value = df.schema[rule.column].dataType, named(rule.column)
    fitting = [as_type(v, kind) for v in rule.value_set]
    odd = len({repr(v) for v, c in zip(rule.value_set, fitting, strict=True) if c is None})
    given = F.array(*[c for c in fitting if c is not None]) if len(fitting) > odd else F.array().cast(T.ArrayType(kind))
    listed = F.array_distinct(F.filter(given, lambda v: v.isNotNull()))
    place = F.array_position(listed, value)
    outside = F.count_if(value.isNotNull() & (place == 0))
    seen = F.lit(0)
    for first in range(0, len(fitting), BITS):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1 - first).cast("int"))
        word = F.bit_or(F.when(place.between(first + 1, first + BITS), bit))
        seen = seen + F.coalesce(F.bit_count(word), F.lit(0))
    lacking = F.size(listed) + F.size(F.filter(given, lambda v: v.isNull())) + odd - seen
    if rule.kind == DISTINCT_IN:
        return outside
    return (lacking if rule.kind == DISTINCT_CONTAIN else outside + lacking).cast("long")


# ---------------------------------------------------------------------- order


def ordered_counts(df: DataFrame, rule: Rule) -> DataFrame:
    """``elements``, ``missing`` and ``unexpected`` of a rule about order, in one row.

    Rows go by ``order_by``, those without it first, ties by the value so that they break nothing; nulls are
    skipped. A value is unexpected if the one before it is greater (smaller), or equal if ``strictly``. Equal rows
    are counted per task first, so a hot time or value is one row; the rest is dealt in ranges, where each
    row meets the one before it, and the last value of a range meets the first of the next.
    """
    value, n = F.col("value"), F.col("n")
    falling = rule.kind == DECREASING
    place = F.when(named(rule.column).isNotNull(), named(rule.order_by))
    rows = df.groupBy(place.alias("place"), named(rule.column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = [value.isNull().asc(), F.col("place").asc(), value.desc() if falling else value.asc()]
    dealt = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    side_by_side = Window.partitionBy("part").orderBy(*order)

    def breaks(later: Column, earlier: Column) -> Column:
        if rule.strictly:
            worse = later >= earlier if falling else later <= earlier
        else:
            worse = later > earlier if falling else later < earlier
        return F.when(worse, 1).otherwise(0)  # nothing before it: null, so no break

    broken = breaks(value, F.lag(value).over(side_by_side)) + (n - 1 if rule.strictly else 0)
    marked = dealt.withColumns({"broken": broken, "nth": F.row_number().over(side_by_side)})
    there = value.isNotNull()
    parts = marked.groupBy("part").agg(
        F.sum(n).alias("elements"),
        F.sum(F.when(~there, n)).alias("missing"),
        F.sum(F.when(there, F.col("broken"))).alias("broken"),
        F.max(F.when(F.col("nth") == 1, value)).alias("first"),
        F.max_by(value, F.when(there, F.col("nth"))).alias("last"),
    )
    ends = F.struct("part", "first", "last")
    row = parts.agg(
        F.sum("elements").alias("elements"),
        F.sum("missing").alias("missing"),
        F.sum("broken").alias("broken"),
        F.sort_array(F.collect_list(F.when(F.col("first").isNotNull(), ends))).alias("ends"),
    )
    kind = df.schema[rule.column].dataType
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast(kind).alias("last"))
    carried = F.aggregate(
        "ends",
        start,
        lambda so_far, end: F.struct(
            (so_far["n"] + breaks(end["first"], so_far["last"])).alias("n"), end["last"].alias("last")
        ),
        lambda so_far: so_far["n"],
    )
    none = F.lit(0).cast("long")
    return row.select(
        F.coalesce("elements", none).alias("elements"),
        F.coalesce("missing", none).alias("missing"),
        (F.coalesce("broken", none) + F.coalesce(carried, F.lit(0))).cast("long").alias("unexpected"),
    )

"""How rows are dealt to the tasks that write a partitioned table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named

# Without adaptive execution, a folder's rows go to this many tasks.
SPREAD = 8


def laid_out(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str] = (), files: int | None = None
) -> DataFrame:
    """Rows of one folder in few tasks, those of a hot folder in several.

    Without this every task of a wide plan would write a file into every folder. Adaptive
    execution splits hot folders and joins small ones by their size; where it is off, each
    folder's rows go to ``SPREAD`` tasks by a hash of the rest of the row.

    With ``order_by``, columns with ``-`` before the name for descending order, each file is sorted and
    the ranges of a folder's files only meet at their ends: ranges are dealt, equal values too by the rest of the
    row, so a hot value is several files. ``files`` is how many ranges there are at most, by default as many as
    shuffle partitions, which adaptive execution joins where they are small.
    """
    if order_by:
        return _in_ranges(df, partition_by, order_by, files)
    if not partition_by:
        return df
    columns = [named(c) for c in partition_by]
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *columns)
    rest = _hashable(df, partition_by)
    salt: Any = F.pmod(F.xxhash64(*rest), F.lit(SPREAD)) if rest else F.lit(0)
    return df.repartition(*columns, salt)


def _hashable(df: DataFrame, but: Sequence[str]) -> list[Column]:
    plain = (T.AtomicType, T.NullType)
    return [
        named(f.name)
        for f in df.schema
        if f.name not in but
        and isinstance(f.dataType, plain)
        and not isinstance(f.dataType, T.VariantType)
    ]


def _in_ranges(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], files: int | None
) -> DataFrame:
    folders = [named(c).asc() for c in partition_by]
    order = [named(c[1:]).desc() if c.startswith("-") else named(c).asc() for c in order_by]
    rest = _hashable(df, [*partition_by, *[c.removeprefix("-") for c in order_by]])
    ties = [F.xxhash64(*rest)] if rest else []
    dealt = [*folders, *order, *ties]
    ranges = df.repartitionByRange(*dealt) if files is None else df.repartitionByRange(files, *dealt)
    return ranges.sortWithinPartitions(*folders, *order)

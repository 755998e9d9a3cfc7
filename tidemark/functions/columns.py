"""Column expressions shared by the operators. All are JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """The top-level column of that name, even if it holds dots or backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def date_parts(timestamp: Column) -> dict[str, Column]:
    """Calendar parts in the session time zone; null in, null out."""
    return {
        "year": F.year(timestamp),
        "month": F.month(timestamp),
        "day": F.dayofmonth(timestamp),
    }


def with_date_parts(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Add ``year``, ``month`` and ``day``. Works on batch and stream alike."""
    return df.withColumns(date_parts(named(timestamp)))


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end, each cut to a whole second *before* subtracting.

    0.9 s to 1.1 s is therefore 1, not 0.
    """
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, null (not an error) when the whole is 0."""
    return F.try_divide(part * F.lit(100.0), whole)


def status_label(success: Column) -> Column:
    return F.when(success, "PASS").otherwise("FAIL")

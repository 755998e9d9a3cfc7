"""Batch scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schema import BRONZE_SCHEMA


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Scan a catalog table; a missing one raises Spark's error with its name."""
    return spark.table(table)


def read_events(
    spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """Scan a Parquet folder of events, as written by the streaming sink.

    The schema is passed in, so no footer is opened to infer it, the calendar parts
    come from the folder names as integers, and an empty folder is an empty table.
    In a folder a stream writes to, only files of committed micro-batches are read.
    """
    return spark.read.schema(schema).parquet(path)

"""Messages to the day-partitioned raw table."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import decode_events, named, with_date_parts
from tidemark.schema import BRONZE_SCHEMA, PARTITION_COLUMNS, WATERMARK_DELAY


def bronze_events(messages: DataFrame, watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """Decode messages and add calendar parts, on a stream or a batch.

    One message gives one row, malformed or late ones too. The watermark only reports
    event time in the query's progress: no step here keeps state, so none drops rows.
    """
    events = decode_events(messages)
    if watermark is not None:
        events = events.withWatermark("timestamp", watermark)
    return with_date_parts(events)


def create_bronze_table(
    spark: SparkSession, table: str, provider: str = "parquet", location: str | None = None
) -> None:
    """Create the partitioned raw table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BRONZE_SCHEMA)
    place = "" if location is None else f" LOCATION '{_escape(location)}'"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {provider}"
        f" PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}){place}"
    )


def write_bronze(
    events: DataFrame,
    checkpoint: str,
    *,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    trigger: Mapping[str, Any] | None = None,
    query_name: str | None = None,
    options: Mapping[str, str] | None = None,
    spread: int | None = None,
) -> StreamingQuery:
    """Start appending a stream to a table or to a folder; the caller waits for it.

    ``trigger`` holds the arguments of ``DataStreamWriter.trigger``; without it
    micro-batches follow each other as soon as possible. Rows are written by the tasks
    that read them, without a shuffle, which makes a file per task and day. For a backfill of
    many days, ``spread`` shuffles each micro-batch so that a day's rows go to that many tasks.
    ``options`` go to the writer. A restart on the same checkpoint goes on where
    the last committed micro-batch ended, and a batch that is redone replaces its files.
    """
    if (table is None) == (path is None):
        raise ValueError("give either table or path")
    rows = events.select(*[named(c) for c in BRONZE_SCHEMA.fieldNames()])
    if spread is not None:
        salt = F.pmod(F.xxhash64("event_id", "session_id", "timestamp"), F.lit(spread))
        rows = rows.repartition(*[named(c) for c in PARTITION_COLUMNS], salt)
    writer = (
        rows.writeStream.format(fmt)
        .options(**(options or {}))
        .outputMode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.toTable(table) if table is not None else writer.start(path)


def _escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")

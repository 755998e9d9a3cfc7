"""Streaming source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Open a stream of messages with a ``value`` column.

    For Kafka pass ``kafka.bootstrap.servers`` and ``subscribe``. A first start
    reads from the earliest offset unless ``startingOffsets`` says otherwise; later
    starts go on from the checkpoint. ``maxOffsetsPerTrigger`` bounds a micro-batch
    and ``minPartitions`` splits a hot topic partition over several tasks.

    File formats take ``path`` and ``schema``; all files present at the first start
    are read, ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch.
    """
    settings = dict(options or {})
    if fmt == "kafka":
        settings.setdefault("startingOffsets", "earliest")
    reader = spark.readStream.format(fmt).options(**settings)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()

"""JSON messages to events and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import named
from tidemark.schema import EVENT_SCHEMA

# to_json writes milliseconds by default, which would lose the last three digits.
MICROSECOND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def decode_events(
    messages: DataFrame, value: str = "value", schema: T.StructType = EVENT_SCHEMA
) -> DataFrame:
    """Decode a binary or string JSON column into flat event columns.

    The schema is fixed, never inferred. Each message gives exactly one row: what
    can't be read becomes null (a field that doesn't fit) or an all-null row
    (a message that isn't a JSON object). Batch and streaming input both work.
    """
    text = named(value).cast("string")
    return messages.select(F.from_json(text, schema).alias("data")).select("data.*")


def encode_events(
    events: DataFrame, key: str = "user_id", schema: T.StructType = EVENT_SCHEMA
) -> DataFrame:
    """The inverse of :func:`decode_events`: ``key`` string and ``value`` binary.

    Timestamps keep their microseconds, so encode then decode is exact.
    """
    payload = F.struct(*[named(c) for c in schema.fieldNames()])
    json = F.to_json(payload, {"timestampFormat": MICROSECOND_FORMAT})
    return events.select(named(key).alias("key"), json.cast("binary").alias("value"))

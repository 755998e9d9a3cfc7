"""Messages: what decoding does with good and bad input, and the exact round trip."""

from __future__ import annotations

import pytest

from model import at, event, frame, model_tuples, tuples
from pyspark.sql import functions as F
from tidemark.functions import decode_events, encode_events, with_date_parts
from tidemark.operators import session_metrics
from tidemark.schema import EVENT_SCHEMA
from tidemark.streaming import bronze_events

NOTHING = (None,) * 7
WELL_FORMED = (
    '{"event_id":"e","user_id":"u","session_id":"s","event_type":"view","page":"/home",'
    '"device":"mobile","timestamp":"2024-01-02T03:04:05.678901+02:00"}'
)


def only(**fields):
    return tuple(fields.get(c) for c in EVENT_SCHEMA.fieldNames())


CASES = {
    "well formed": (
        WELL_FORMED,
        ("e", "u", "s", "view", "/home", "mobile", at("2024-01-02T01:04:05.678901")),
    ),
    "time without offset": (
        '{"timestamp":"2024-01-02T03:04:05"}',
        only(timestamp=at("2024-01-02T03:04:05")),
    ),
    "time as epoch seconds": (
        '{"timestamp":1704164645}',
        only(timestamp=at("2024-01-02T03:04:05")),
    ),
    "unreadable time": ('{"event_id":"e","timestamp":"soon"}', only(event_id="e")),
    "number as id": ('{"event_id":17}', only(event_id="17")),
    "object as id": ('{"user_id":{"a":1}}', only(user_id='{"a":1}')),
    "extra field": ('{"event_id":"e","colour":"red"}', only(event_id="e")),
    "field in another case": ('{"EVENT_ID":"e","page":"/blog"}', only(page="/blog")),
    "no field": ("{}", NOTHING),
    "not JSON": ("junk", NOTHING),
    "truncated": (WELL_FORMED[:60], NOTHING),
    "JSON null": ("null", NOTHING),
    "array of one": (f"[{WELL_FORMED}]", NOTHING),
    "array of several": (f"[{WELL_FORMED},{WELL_FORMED}]", NOTHING),
    "empty text": ("", NOTHING),
    "null": (None, NOTHING),
}


@pytest.mark.parametrize("as_binary", [True, False])
def test_each_message_gives_one_row(spark, as_binary):
    names = list(CASES)
    messages = spark.createDataFrame([(CASES[n][0],) for n in names], "value string").coalesce(1)
    if as_binary:
        messages = messages.select(F.col("value").cast("binary"))
    found = decode_events(messages).withColumn("timestamp", F.col("timestamp").cast("string"))
    for name, row in zip(names, found.collect(), strict=True):
        expected = list(CASES[name][1])
        if expected[-1] is not None:
            expected[-1] = str(expected[-1].replace(tzinfo=None))
        assert list(row) == expected, name


def test_schema_is_fixed(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    assert decode_events(messages).schema == EVENT_SCHEMA


def test_utf8_text_survives(spark):
    rows = [event("é", "ü-日本", "view", "2024-01-02T03:04:05.000001", page='/"quoted"\n\\')]
    found = with_date_parts(decode_events(encode_events(frame(spark, rows))))
    assert tuples(found.collect()) == model_tuples(rows)


def test_round_trip_keeps_nulls_and_microseconds(spark):
    rows = [
        event("1", None, "view", "2024-01-02T03:04:05.123456"),
        event(None, "u", None, None, page=None, device=None, session_id=None),
        event("", "", "", "1969-12-31T23:59:59.999999"),
    ]
    found = with_date_parts(decode_events(encode_events(frame(spark, rows))))
    assert tuples(found.collect()) == model_tuples(rows)


def test_round_trip_is_exact_where_a_clock_hour_repeats(spark):
    rows = [event(t[11:13], "u", "view", t) for t in ("2024-11-03T05:30:00", "2024-11-03T06:30:00")]
    source = frame(spark, rows).select(*EVENT_SCHEMA.fieldNames())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = decode_events(encode_events(source))
        epochs = found.select("event_id", F.unix_timestamp("timestamp")).collect()
        length = session_metrics(found).first()["duration_seconds"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {tuple(r) for r in epochs} == {
        (r["event_id"], int(r["timestamp"].timestamp())) for r in rows
    }
    assert length == 3600


def test_message_key_is_the_user(spark):
    found = encode_events(frame(spark, [event("1", "u", "view"), event("2", None, "view")]))
    assert found.dtypes == [("key", "string"), ("value", "binary")]
    assert {r["key"] for r in found.collect()} == {"u", None}


def test_date_parts_follow_the_session_zone(spark):
    times = ("2024-01-01T00:30:00", None)
    rows = frame(spark, [event("1", "u", "view", t) for t in times]).drop("year", "month", "day")
    parts = with_date_parts(rows).select("year", "month", "day")
    assert {tuple(r) for r in parts.collect()} == {(2024, 1, 1), (None, None, None)}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        shifted = with_date_parts(rows).select("year", "month", "day")
        assert {tuple(r) for r in shifted.collect()} == {(2023, 12, 31), (None, None, None)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_decoding_parses_each_message_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    plan = bronze_events(messages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1

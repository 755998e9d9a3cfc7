from __future__ import annotations

import pytest

from model import at, event, frame, model_tuples, tuples
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from test_clean import hot_rows
from tidemark.functions import encode_events
from tidemark.operators import clean, daily_active_users, gate, session_metrics, validate
from tidemark.schema import BRONZE_SCHEMA
from tidemark.sources import NOT_NULL, Rule, Suite, SuiteError, read_events, read_stream, read_table
from tidemark.streaming import bronze_events, clean_stream, create_bronze_table, write_bronze

ONCE = {"availableNow": True}


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def lines(place, name, *texts):
    (place / "in" / name).write_text("\n".join(texts) + "\n")


def stream(spark, place, **options):
    return read_stream(spark, "text", options, str(place / "in"))


def ingest(spark, place, **options):
    query = write_bronze(
        bronze_events(stream(spark, place, **options)),
        str(place / "checkpoint"),
        path=str(place / "bronze"),
        trigger=ONCE,
    )
    query.awaitTermination()
    return read_events(spark, str(place / "bronze"))


def test_late_and_malformed_messages_stay_and_restarts_add_nothing(spark, place):
    lines(place, "1.txt", '{"event_id":"new","timestamp":"2024-01-02T12:00:00Z"}', "junk")
    ingest(spark, place)
    lines(place, "2.txt", '{"event_id":"late","timestamp":"2024-01-01T00:00:00Z"}')
    ingest(spark, place)
    for _ in range(2):
        found = ingest(spark, place)
        rows = found.select("event_id", "timestamp", "year", "month", "day").collect()
        assert tuples(rows) == tuples(
            [
                ("new", at("2024-01-02T12:00:00"), 2024, 1, 2),
                ("late", at("2024-01-01T00:00:00"), 2024, 1, 1),
                (None,) * 5,
            ]
        )
    assert found.schema == BRONZE_SCHEMA
    assert (place / "bronze" / "year=2024" / "month=1" / "day=2").is_dir()


def test_many_micro_batches_equal_the_batch(spark, place):
    rows = hot_rows(11)
    for i in range(4):
        part = encode_events(frame(spark, rows[i::4])).selectExpr("CAST(value AS STRING)")
        part.coalesce(1).write.mode("append").text(str(place / "in"))
    found = ingest(spark, place, maxFilesPerTrigger="1")
    assert tuples(found.collect()) == model_tuples(rows)
    batch = bronze_events(encode_events(frame(spark, rows)))
    assert tuples(clean(found).collect()) == tuples(clean(batch).collect())
    for metric in (daily_active_users, session_metrics):
        assert tuples(metric(clean(found)).collect()) == tuples(metric(clean(batch)).collect())


def test_a_failed_micro_batch_is_redone_without_duplicates(spark, place):
    rows = hot_rows(13, 90)
    rows[46]["page"] = "/poison"
    for i in range(3):
        part = encode_events(frame(spark, rows[i::3])).selectExpr("CAST(value AS STRING)")
        part.coalesce(1).write.mode("append").text(str(place / "in"))

    def start(events):
        return write_bronze(
            events, str(place / "checkpoint"), path=str(place / "bronze"), trigger=ONCE
        )

    events = bronze_events(stream(spark, place, maxFilesPerTrigger="1"))
    # Dies in the middle of the second micro-batch, after some of its rows.
    poisoned = F.col("page") == "/poison"
    lost = F.when(poisoned, F.raise_error(F.lit("executor lost"))).otherwise(F.col("page"))
    with pytest.raises(StreamingQueryException, match="executor lost"):
        start(events.withColumn("page", lost)).awaitTermination()
    start(events).awaitTermination()
    found = read_events(spark, str(place / "bronze"))
    assert tuples(found.collect()) == model_tuples(rows)


def test_a_batch_sees_the_files_of_when_it_was_opened(spark, place):
    lines(place, "1.txt", '{"event_id":"1","user_id":"u","event_type":"view"}')
    opened = ingest(spark, place)
    lines(place, "2.txt", '{"event_id":"1","user_id":"t","event_type":"view"}')
    later = ingest(spark, place)
    assert [r["user_id"] for r in clean(opened).collect()] == ["u"]
    assert gate(validate(opened), "raise")[1]["element_count"] == 1
    assert [r["user_id"] for r in clean(later).collect()] == ["t"]


def test_binary_messages_from_parquet(spark, place):
    rows = hot_rows(12, 50)
    messages = encode_events(frame(spark, rows))
    messages.write.mode("append").parquet(str(place / "in"))
    source = read_stream(spark, "parquet", path=str(place / "in"), schema=messages.schema)
    assert dict(source.dtypes)["value"] == "binary"
    query = write_bronze(
        bronze_events(source), str(place / "c"), path=str(place / "bronze"), trigger=ONCE
    )
    query.awaitTermination()
    assert tuples(read_events(spark, str(place / "bronze")).collect()) == model_tuples(rows)


def test_table_sink_appends_to_the_created_table(spark, place):
    table = "stream_target"
    for _ in range(2):
        create_bronze_table(spark, table, location=str(place / "it's"))
    assert read_table(spark, table).schema == BRONZE_SCHEMA
    assert read_table(spark, table).count() == 0
    rows = [event("1", "u", "view"), event("2", "u", "view", None)]
    for row in rows:
        text = encode_events(frame(spark, [row])).selectExpr("CAST(value AS STRING)").first()[0]
        lines(place, row["event_id"] + ".txt", text)
        write_bronze(
            bronze_events(stream(spark, place)), str(place / "c"), table=table, trigger=ONCE
        ).awaitTermination()
    assert tuples(read_table(spark, table).collect()) == model_tuples(rows)
    spark.sql(f"DROP TABLE {table}")


def test_default_trigger_runs_until_stopped(spark, place):
    lines(place, "1.txt", '{"event_id":"1"}')
    query = write_bronze(
        bronze_events(stream(spark, place), watermark=None),
        str(place / "c"),
        path=str(place / "bronze"),
        query_name="clicks",
    )
    try:
        assert query.name == "clicks" and query.isActive
        query.processAllAvailable()
        lines(place, "2.txt", '{"event_id":"2"}')
        query.processAllAvailable()
    finally:
        query.stop()
    found = read_events(spark, str(place / "bronze")).select("event_id")
    assert {r[0] for r in found.collect()} == {"1", "2"}


def test_watermark_reports_event_time(spark, place):
    lines(place, "1.txt", '{"timestamp":"2024-01-02T12:00:00Z"}')
    query = write_bronze(
        bronze_events(stream(spark, place)), str(place / "c"), path=str(place / "b"), trigger=ONCE
    )
    query.awaitTermination()
    times = [dict(p["eventTime"] or {}) for p in query.recentProgress]
    assert any(t.get("max") == "2024-01-02T12:00:00.000Z" for t in times)


def test_an_empty_stream_gives_an_empty_table(spark, place):
    lines(place, "1.txt", '{"event_id":"1"}')
    found = ingest(spark, place)
    assert found.filter("event_id IS NULL").count() == 0
    (place / "none").mkdir()
    assert read_events(spark, str(place / "none")).count() == 0


def test_one_target_is_needed(spark, place):
    events = bronze_events(stream(spark, place))
    for target in ({}, {"table": "t", "path": "p"}):
        with pytest.raises(ValueError, match="either"):
            write_bronze(events, "c", **target)


def test_kafka_is_the_default_source(spark, monkeypatch):
    """The connector isn't here; what reaches it is."""
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def load(self):
            return "stream"

    monkeypatch.setattr(type(spark), "readStream", property(lambda self: Reader()))
    options = {"kafka.bootstrap.servers": "host:9092", "subscribe": "clicks"}
    assert read_stream(spark, options=options) == "stream"
    assert asked == {"format": "kafka", "startingOffsets": "earliest", **options}
    read_stream(spark, options={**options, "startingOffsets": "latest"})
    assert asked["startingOffsets"] == "latest"


def test_missing_inputs_raise_with_their_name(spark, place):
    with pytest.raises(AnalysisException, match="no_such_table"):
        read_table(spark, "no_such_table")
    with pytest.raises(AnalysisException, match="no_such_folder"):
        read_events(spark, str(place / "no_such_folder"))


def test_queries_leave_no_table_behind(spark):
    import __spark_entry__ as driver

    before = {t.name for t in spark.catalog.listTables()}
    rows = driver.queries()["stream_bronze_table"](spark, "/root/testdata/sf0.001")
    assert rows.count() == 1100
    left = {t.name for t in spark.catalog.listTables() if not t.isTemporary}
    assert left <= before


# ------------------------------------------------------------ cleaning a stream


def message(event_id, time, user="u", kind="view"):
    return f'{{"event_id":"{event_id}","user_id":"{user}","event_type":"{kind}","timestamp":"2024-01-01T{time}Z"}}'


def ingest_clean(spark, place, suite=None):
    messages = bronze_events(stream(spark, place), watermark=None)
    rows = clean_stream(messages, *([suite] if suite else []))
    write_bronze(rows, str(place / "checkpoint"), path=str(place / "silver"), trigger=ONCE).awaitTermination()
    found = read_events(spark, str(place / "silver"))
    return sorted((r["event_id"], r["timestamp"].strftime("%H:%M")) for r in found.collect())


def test_a_stream_is_cleaned_across_batches_and_restarts(spark, place):
    lines(place, "1.txt", message("a", "10:00:00"), message("a", "10:01:00"), message("b", "10:00:00", kind="odd"), "junk")
    assert [i for i, _ in ingest_clean(spark, place)] == ["a"]
    kept = ingest_clean(spark, place)
    # The state outlives the query: a repeat is dropped after a restart, a new key isn't.
    lines(place, "2.txt", message("a", "10:05:00"), message("c", "10:30:00"))
    assert ingest_clean(spark, place) == sorted([*kept, ("c", "10:30")])
    # The watermark is at 10:20 now: what is older is late and dropped, repeated or not.
    lines(place, "3.txt", message("d", "10:10:00"), message("e", "10:25:00"), message("c", "10:31:00"))
    assert ingest_clean(spark, place) == sorted([*kept, ("c", "10:30"), ("e", "10:25")])


def test_without_uniqueness_no_row_is_late(spark, place):
    suite = Suite("", (Rule(NOT_NULL, "user_id"),))
    lines(place, "1.txt", message("a", "10:00:00"))
    ingest_clean(spark, place, suite)
    lines(place, "2.txt", message("a", "01:00:00"))
    assert ingest_clean(spark, place, suite) == [("a", "01:00"), ("a", "10:00")]


def test_a_table_is_no_stream(spark):
    with pytest.raises(SuiteError, match="wants a stream"):
        clean_stream(frame(spark, []))

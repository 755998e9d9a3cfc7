from __future__ import annotations

import pytest

import __spark_entry__ as driver
import model
from model import event, frame, tuples
from test_clean import hot_rows
from tidemark.operators import (
    daily_active_users,
    earliest_days,
    engagement,
    latest_days,
    page_views,
    session_metrics,
    session_sample,
    silver_sample,
    top_pages,
)

DAY = "2024-01-01T00:"


def sessions(spark):
    return frame(
        spark,
        [
            event("1", "u", "view", f"{DAY}00:00.9", session_id="s1"),
            event("2", "u", "view", f"{DAY}00:01.1", session_id="s1"),
            event("3", "u", "view", None, session_id="s2"),
            event("4", "u", "view", f"{DAY}00:05", session_id=None),
            event("5", "v", "view", f"{DAY}01:05", session_id=None),
        ],
    )


def test_session_metrics(spark):
    found = session_metrics(sessions(spark))
    assert found.columns == [
        "session_id",
        "events_in_session",
        "session_start",
        "session_end",
        "duration_seconds",
    ]
    lengths = found.select("session_id", "events_in_session", "duration_seconds")
    assert {tuple(r) for r in lengths.collect()} == {("s1", 2, 1), ("s2", 1, None), (None, 2, 60)}


def test_seconds_before_1970_are_cut_downwards(spark):
    rows = [
        event("1", "u", "view", "1969-12-31T23:59:58.900000"),
        event("2", "u", "view", "1969-12-31T23:59:59.100000"),
    ]
    assert tuples(session_metrics(frame(spark, rows)).collect()) == tuples(
        model.session_metrics(rows)
    )


def test_engagement_counts_named_sessions_but_averages_all(spark):
    found = engagement(session_metrics(sessions(spark)))
    assert found.columns == [
        "total_sessions",
        "avg_session_length_seconds",
        "max_clicks_in_one_session",
    ]
    assert found.collect() == [(2, 30.5, 2)]


def test_engagement_of_nothing(spark):
    assert engagement(session_metrics(frame(spark, []))).collect() == [(0, None, None)]


def test_daily_users_are_exact_and_keep_the_undated_day(spark):
    rows = [
        event("1", "u", "view"),
        event("2", "u", "click"),
        event("3", "v", "view"),
        event("4", "u", "view", None),
        event("5", None, "view", "2024-01-03T00:00:00"),
    ]
    found = daily_active_users(frame(spark, rows))
    assert found.dtypes[-1] == ("daily_active_users", "bigint")
    assert {tuple(r) for r in found.collect()} == {
        (2024, 1, 2, 2),
        (None, None, None, 1),
        (2024, 1, 3, 0),
    }


def test_page_views_count_views_of_exact_case(spark):
    rows = [
        event("1", "u", "view", page="/a"),
        event("2", "u", "view", page=None),
        event("3", "u", "View", page="/a"),
        event("4", "u", None, page="/a"),
        event("5", "u", "view", page=None),
    ]
    assert {tuple(r) for r in page_views(frame(spark, rows)).collect()} == {("/a", 1), (None, 2)}


@pytest.mark.parametrize("seed", range(3))
def test_skewed_input_equals_the_model(spark, seed):
    rows = hot_rows(seed)
    events = frame(spark, rows).repartition(11)
    assert tuples(daily_active_users(events).collect()) == tuples(model.daily_active_users(rows))
    assert tuples(page_views(events).collect()) == tuples(model.page_views(rows))
    found = session_metrics(events)
    assert tuples(found.collect()) == tuples(model.session_metrics(rows))
    assert sum(r["events_in_session"] for r in found.collect()) == len(rows)


def test_latest_days_put_the_undated_day_last(spark):
    days = [(2024, 1, 2, 5), (None, None, None, 9), (2023, 12, 31, 1), (2024, 1, 10, 2)]
    dau = spark.createDataFrame(days, "year int, month int, day int, daily_active_users bigint")
    assert latest_days(dau, 3).collect() == [days[3], days[0], days[2]]
    assert latest_days(dau).collect()[-1] == days[1]


def test_earliest_days_start_with_the_undated_day(spark):
    days = [(2024, 1, 2, 5), (None, None, None, 9), (2023, 12, 31, 1), (2024, 1, 10, 2)]
    dau = spark.createDataFrame(days, "year int, month int, day int, daily_active_users bigint")
    assert earliest_days(dau, 3).collect() == [days[1], days[2], days[0]]


def test_top_pages_break_ties_by_name(spark):
    rows = [("/b", 2), ("/a", 2), ("/c", 9)]
    views = spark.createDataFrame(rows, "page string, total_views long")
    assert top_pages(views, 2).collect() == [("/c", 9), ("/a", 2)]


def test_samples(spark):
    events = frame(spark, hot_rows(1))
    assert silver_sample(events).columns == ["user_id", "event_type", "page", "device", "timestamp"]
    assert silver_sample(events).count() == 10
    assert silver_sample(events, 0).count() == 0
    known = set(map(tuple, events.select(silver_sample(events).columns).collect()))
    assert set(map(tuple, silver_sample(events).collect())) <= known
    sample = session_sample(session_metrics(events))
    assert sample.columns == ["session_id", "events_in_session", "duration_seconds"]
    assert sample.count() == 5


def test_plans_combine_before_the_shuffle(spark, tmp_path):
    frame(spark, hot_rows(2)).write.partitionBy("year", "month", "day").parquet(str(tmp_path / "s"))
    silver = spark.read.parquet(str(tmp_path / "s"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    views = plan(page_views(silver))
    assert "EqualTo(event_type,view)" in views
    assert "ReadSchema: struct<event_type:string,page:string>" in views
    assert views.count("Exchange") == 1 and "partial_count" in views.split("Exchange")[1]
    dau = plan(daily_active_users(silver))
    assert "ReadSchema: struct<user_id:string>" in dau
    assert dau.count("Exchange") == 2
    assert "HashAggregate" in dau.split("Exchange")[2]
    lengths = plan(session_metrics(silver))
    assert "ReadSchema: struct<session_id:string,timestamp:timestamp>" in lengths
    assert lengths.count("Exchange") == 1 and "partial_min" in lengths.split("Exchange")[1]
    assert "TakeOrderedAndProject" in plan(top_pages(page_views(silver)))


def test_expected_numbers_at_sf001(spark):
    """The numbers of FIXTURES.md."""
    sf = "/root/testdata/sf0.01"
    bronze, silver = driver.bronze(spark, sf), driver.silver(spark, sf).cache()
    assert bronze.count() == 11_000
    report = {r["column"]: r for r in driver.validate(bronze).collect()}
    assert report["user_id"]["unexpected_count"] == 847
    assert report["event_id"]["unexpected_count"] == 2_000
    values = {tuple(r) for r in driver.unexpected_values(bronze, driver.IN_SET_RULE).collect()}
    assert len(values) == 2 and ("error", 2_217) in values
    assert silver.count() == 5_522
    dau = daily_active_users(silver)
    assert dau.count() == 30
    assert dau.filter("year = 2024 AND month = 1 AND day = 1").collect()[0][-1] == 101
    views = {r["page"]: r["total_views"] for r in page_views(silver).collect()}
    assert len(views) == 6 and views["/p0"] == 297
    found = session_metrics(silver)
    assert found.count() == 3_153
    one = found.filter("session_id = '0-20240101'").collect()[0]
    assert (one["events_in_session"], one["duration_seconds"]) == (3, 11_483)
    assert engagement(found).collect() == [(3_153, 17_084.56, 7)]
    silver.unpersist()

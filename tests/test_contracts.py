from __future__ import annotations

import logging

import pytest

import model
from model import event, frame
from test_clean import hot_rows
from tidemark.operators import (
    ContractViolation,
    gate,
    profile,
    unexpected_values,
    validate,
    verdict,
)
from tidemark.sources import IN_SET, NOT_NULL, UNIQUE, Rule, Suite, SuiteError, load_suite

REPORT_COLUMNS = [
    "position",
    "rule",
    "column",
    "element_count",
    "missing_count",
    "unexpected_count",
    "success",
    "status",
]
ROWS = [
    event("1", "u", "view"),
    event("1", "u", "click"),
    event("1", None, "error"),
    event("2", None, None),
    event(None, "u", "error"),
    event(None, "u", "signup"),
]


def counts(report):
    rows = report.orderBy("position").collect()
    return [
        (r["position"], r["element_count"], r["missing_count"], r["unexpected_count"]) for r in rows
    ]


def test_report(spark):
    report = validate(frame(spark, ROWS))
    assert report.columns == REPORT_COLUMNS
    assert [tuple(r) for r in report.orderBy("position").collect()] == [
        (1, NOT_NULL, "user_id", 6, 2, 2, False, "FAIL"),
        # All three rows of id 1 count, nulls are skipped.
        (2, UNIQUE, "event_id", 6, 2, 3, False, "FAIL"),
        # The null type is missing, not unexpected.
        (3, IN_SET, "event_type", 6, 1, 3, False, "FAIL"),
    ]
    assert verdict(report).collect() == [(False,)]


def test_good_rows_pass(spark):
    report = validate(frame(spark, [event("1", "u", "view"), event("2", "u", "scroll")]))
    assert {r["status"] for r in report.collect()} == {"PASS"}
    assert verdict(report).collect() == [(True,)]


def test_null_passes_the_set_rule(spark):
    report = validate(frame(spark, [event("1", "u", None)]))
    assert verdict(report).collect() == [(True,)]


def test_empty_table_passes_with_zeros(spark):
    report = validate(frame(spark, []))
    assert counts(report) == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
    assert verdict(report).collect() == [(True,)]
    percents = profile(report).select("missing_percent", "unexpected_percent_total")
    assert set(map(tuple, percents.collect())) == {(None, None)}


def test_empty_suite_passes(spark):
    report = validate(frame(spark, ROWS), Suite("", ()))
    assert report.columns == REPORT_COLUMNS
    assert report.collect() == []
    assert verdict(report).collect() == [(True,)]


def test_several_rules_of_a_kind(spark):
    suite = Suite(
        "",
        (
            Rule(UNIQUE, "user_id"),
            Rule(UNIQUE, "event_id"),
            Rule(NOT_NULL, "event_id"),
            Rule(IN_SET, "event_type", ()),
            Rule(IN_SET, "day", (2, "soon")),
            Rule(UNIQUE, "event_id"),
        ),
    )
    assert counts(validate(frame(spark, ROWS), suite)) == [
        (1, 6, 2, 4),
        (2, 6, 2, 3),
        (3, 6, 2, 2),
        (4, 6, 1, 5),
        (5, 6, 0, 0),
        (6, 6, 2, 3),
    ]


def test_profile(spark):
    found = {r["column"]: r.asDict() for r in profile(validate(frame(spark, ROWS))).collect()}
    types = found["event_type"]
    assert types["missing_percent"] == pytest.approx(100 / 6)
    assert types["unexpected_percent"] == pytest.approx(60)
    assert types["unexpected_percent_total"] == pytest.approx(50)
    users = found["user_id"]
    assert users["unexpected_percent"] == users["unexpected_percent_total"]


def test_unexpected_values(spark):
    df = frame(spark, ROWS)
    types = Rule(IN_SET, "event_type", ("view", "click"))
    assert unexpected_values(df, types).collect() == [("error", 2), ("signup", 1)]
    assert unexpected_values(df, types, 1).collect() == [("error", 2)]
    assert unexpected_values(df, Rule(UNIQUE, "event_id"), None).collect() == [("1", 3)]
    assert unexpected_values(df, Rule(NOT_NULL, "user_id")).collect() == [(None, 2)]
    assert unexpected_values(df, Rule(IN_SET, "day", ())).collect() == [("2", 6)]


def test_gate(spark, caplog):
    failing, passing = validate(frame(spark, ROWS)), validate(frame(spark, []))
    with caplog.at_level(logging.WARNING):
        rows = gate(failing)
    assert [r["position"] for r in rows] == [1, 2, 3]
    assert "unique(event_id): 3" in caplog.text
    with pytest.raises(ContractViolation, match="event_type"):
        gate(failing, "raise")
    assert all(r["success"] for r in gate(passing, "raise"))
    with pytest.raises(ValueError, match="on_fail"):
        gate(passing, "ignore")


def test_unknown_column(spark):
    with pytest.raises(SuiteError, match="no column"):
        validate(frame(spark, ROWS), Suite("", (Rule(NOT_NULL, "nobody"),)))


@pytest.mark.parametrize("seed", range(3))
def test_skewed_input_equals_the_model(spark, seed):
    rows = hot_rows(seed)
    assert counts(validate(frame(spark, rows).repartition(7))) == model.check(
        rows, load_suite().rules
    )


def test_plan_combines_before_each_shuffle(spark, tmp_path):
    frame(spark, ROWS).write.parquet(str(tmp_path / "bronze"))
    report = validate(spark.read.parquet(str(tmp_path / "bronze")))
    plan = report._jdf.queryExecution().executedPlan().toString()
    # One single-row exchange per scan and one by key; each scan reads its columns only.
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange SinglePartition") == 2
    assert "ReadSchema: struct<user_id:string,event_type:string>" in plan
    assert "ReadSchema: struct<event_id:string>" in plan
    assert "Join" not in plan and "Sort" not in plan

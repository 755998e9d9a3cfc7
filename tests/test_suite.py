from __future__ import annotations

import json

import pytest

from tidemark.schema import ALLOWED_EVENT_TYPES
from tidemark.sources import (
    BETWEEN,
    IN_SET,
    MATCHES,
    NOT_NULL,
    ROW_COUNT,
    UNIQUE,
    Rule,
    SuiteError,
    load_suite,
)


def suite_of(*expectations):
    return {"expectation_suite_name": "x", "expectations": list(expectations)}


def rule(kind, **kwargs):
    return {"expectation_type": kind, "kwargs": kwargs}


def test_default_suite():
    assert load_suite().rules == (
        Rule(NOT_NULL, "user_id"),
        Rule(UNIQUE, "event_id"),
        Rule(IN_SET, "event_type", tuple(ALLOWED_EVENT_TYPES)),
    )


def test_file_dict_and_uri_agree(spark, tmp_path):
    document = suite_of(rule(IN_SET, column="a", value_set=["x", None, 3]))
    file = tmp_path / "suite.json"
    file.write_text(json.dumps(document, indent=1))
    expected = load_suite(document)
    assert expected.rules == (Rule(IN_SET, "a", ("x", 3)),)
    assert load_suite(str(file)) == load_suite(file) == expected
    assert load_suite(file.as_uri(), spark) == expected
    assert load_suite(expected) is expected


@pytest.mark.parametrize(
    "document",
    [
        {},
        [],
        {"expectations": {}},
        suite_of("x"),
        suite_of(rule("expect_column_values_to_be_nice", column="a")),
        suite_of({"expectation_type": NOT_NULL}),
        suite_of(rule(NOT_NULL)),
        suite_of(rule(NOT_NULL, column=3)),
        suite_of(rule(NOT_NULL, column="a", mostly=2)),
        suite_of(rule(NOT_NULL, column="a", severity="high")),
        suite_of(rule(BETWEEN, column="a")),
        suite_of(rule(ROW_COUNT, column="a", min_value=1)),
        suite_of(rule(MATCHES, column="a", regex=1)),
        suite_of(rule(IN_SET, column="a")),
        suite_of(rule(IN_SET, column="a", value_set="view")),
        suite_of(rule(IN_SET, column="a", value_set=[["view"]])),
    ],
)
def test_wrong_suites_are_refused(tmp_path, document):
    file = tmp_path / "suite.json"
    file.write_text(json.dumps(document))
    with pytest.raises(SuiteError):
        load_suite(file)


def test_missing_file_raises(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_suite(tmp_path / "none.json")

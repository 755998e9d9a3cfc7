"""Properties over generated rows; each example is one Spark job over many rows."""

from __future__ import annotations

from datetime import UTC, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from model import COLUMNS, frame, model_tuples, tuples
from tidemark.functions import decode_events, encode_events, with_date_parts
from tidemark.operators import clean, session_metrics, validate, verdict
from tidemark.sources import IN_SET, NOT_NULL, UNIQUE, Rule, Suite

FEW = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

any_text = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=8)
few_texts = st.none() | st.sampled_from(["", "a", "b", "view", "click"])
times = st.none() | st.datetimes(
    datetime(1900, 1, 1), datetime(9999, 12, 31), timezones=st.just(UTC)
)
few_times = st.none() | st.sampled_from(
    [datetime(2024, 1, d, 0, 0, s, us, UTC) for d in (1, 2) for s in (0, 1) for us in (0, 999_999)]
)


@st.composite
def events(draw, texts, when):
    names = ["event_id", "user_id", "session_id", "event_type", "page", "device"]
    row = {name: draw(texts) for name in names}
    time = draw(when)
    parts = (None,) * 3 if time is None else (time.year, time.month, time.day)
    return {**row, "timestamp": time, **dict(zip(("year", "month", "day"), parts, strict=True))}


@FEW
@given(st.lists(events(any_text, times), max_size=60))
def test_encode_then_decode_is_exact(spark, rows):
    found = with_date_parts(decode_events(encode_events(frame(spark, rows))))
    assert tuples(found.collect()) == model_tuples(rows)


rules = st.lists(
    st.builds(Rule, st.sampled_from([NOT_NULL, UNIQUE]), st.sampled_from(COLUMNS[:6]))
    | st.builds(
        Rule,
        st.just(IN_SET),
        st.sampled_from(COLUMNS[:6]),
        st.lists(st.sampled_from(["", "a", "view"]), unique=True).map(tuple),
    ),
    max_size=4,
)


@FEW
@given(st.lists(events(few_texts, few_times), max_size=60), rules)
def test_any_suite_equals_the_model(spark, rows, chosen):
    suite, df = Suite("", tuple(chosen)), frame(spark, rows).repartition(5)
    expected = model.clean(rows, chosen)
    silver = clean(df, suite)
    assert tuples(silver.collect()) == model_tuples(expected)
    report = validate(df, suite).orderBy("position").collect()
    counts = ["position", "element_count", "missing_count", "unexpected_count"]
    assert [tuple(r[c] for c in counts) for r in report] == model.check(rows, chosen)
    assert tuples(session_metrics(silver).collect()) == tuples(model.session_metrics(expected))


@FEW
@given(st.lists(events(few_texts, few_times), max_size=60), rules)
def test_a_cleaned_table_passes_its_suite(spark, rows, chosen):
    suite = Suite("", tuple(chosen))
    silver = clean(frame(spark, rows), suite)
    assert verdict(validate(silver, suite)).collect() == [(True,)]

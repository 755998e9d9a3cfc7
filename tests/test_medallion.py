from __future__ import annotations

import json

import pytest

import model
from model import event, frame, model_tuples, tuples
from test_clean import hot_rows
from tidemark.__main__ import _parser, _store, main
from tidemark.functions import encode_events
from tidemark.operators import ContractViolation
from tidemark.plans import build_gold, register_views, run_batch
from tidemark.schema import GOLD_DAU, GOLD_PAGE_VIEWS, GOLD_SESSIONS, GOLD_TABLES, SILVER
from tidemark.sinks import CatalogStore, MissingTable, VersionedStore
from tidemark.sources import SuiteError, load_suite


@pytest.fixture
def store(spark, tmp_path):
    return VersionedStore(spark, str(tmp_path / "store"))


def check_tables(store, rows):
    silver = model.clean(rows, load_suite().rules)
    assert tuples(store.read(SILVER).collect()) == model_tuples(silver)
    for name, metric in (
        (GOLD_DAU, model.daily_active_users),
        (GOLD_PAGE_VIEWS, model.page_views),
        (GOLD_SESSIONS, model.session_metrics),
    ):
        assert tuples(store.read(name).collect()) == tuples(metric(silver)), name


def test_batch_publishes_all_tables(spark, store):
    rows = hot_rows(21)
    result = run_batch(frame(spark, rows), store)
    assert not result.validation_passed
    assert [r["position"] for r in result.report] == [1, 2, 3]
    assert list(result.published) == [SILVER, *GOLD_TABLES]
    check_tables(store, rows)


@pytest.mark.parametrize(
    "setting",
    [
        {"spark.sql.adaptive.enabled": "false"},
        {"spark.sql.ansi.enabled": "false"},
        {"spark.sql.caseSensitive": "true"},
        {"spark.sql.shuffle.partitions": "1"},
        {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"},
        {"spark.sql.optimizer.windowGroupLimitThreshold": "-1"},
        {"mapreduce.fileoutputcommitter.algorithm.version": "2"},
    ],
    ids=lambda setting: next(iter(setting)),
)
def test_results_do_not_depend_on_session_settings(spark, store, setting):
    rows = hot_rows(28)
    before = {name: spark.conf.get(name, None) for name in setting}
    for name, value in setting.items():
        spark.conf.set(name, value)
    try:
        run_batch(frame(spark, rows), store)
        check_tables(store, rows)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_rerun_replaces_instead_of_appending(spark, store):
    run_batch(frame(spark, hot_rows(22)), store)
    rows = hot_rows(23)
    for _ in range(2):
        run_batch(frame(spark, rows), store)
    check_tables(store, rows)


def test_clean_input_passes_the_strict_gate(spark, store):
    rows = [event("1", "u", "view"), event("2", "v", "scroll")]
    assert run_batch(frame(spark, rows), store, on_fail="raise").validation_passed
    check_tables(store, rows)


def test_the_strict_gate_stops_before_anything_is_written(spark, store):
    with pytest.raises(ContractViolation):
        run_batch(frame(spark, hot_rows(24)), store, on_fail="raise")
    for name in (SILVER, *GOLD_TABLES):
        with pytest.raises(MissingTable):
            store.read(name)


def test_metrics_do_not_start_if_silver_fails(spark, store, monkeypatch):
    publish, asked = store.publish, []

    def failing(df, name, partition_by=()):
        asked.append(name)
        if name == SILVER:
            raise OSError("disk gone")
        return publish(df, name, partition_by)

    monkeypatch.setattr(store, "publish", failing)
    with pytest.raises(OSError, match="disk gone"):
        run_batch(frame(spark, hot_rows(25)), store)
    assert asked == [SILVER]


def test_a_failing_metric_raises_and_the_others_are_published(spark, store, monkeypatch):
    rows = hot_rows(29)
    run_batch(frame(spark, []), store)
    publish = store.publish

    def failing(df, name, partition_by=()):
        if name == GOLD_PAGE_VIEWS:
            raise OSError("disk gone")
        return publish(df, name, partition_by)

    monkeypatch.setattr(store, "publish", failing)
    with pytest.raises(OSError, match="disk gone"):
        run_batch(frame(spark, rows), store)
    assert store.read(GOLD_PAGE_VIEWS).count() == 0
    assert store.read(GOLD_DAU).count() and store.read(GOLD_SESSIONS).count()


def test_own_suite(spark, store):
    rows = [event("1", "u", "view"), event("1", "u", "view")]
    result = run_batch(frame(spark, rows), store, {"expectations": []}, on_fail="raise")
    assert result.report == []
    assert store.read(SILVER).count() == 2


def test_empty_input(spark, store):
    assert run_batch(frame(spark, []), store).validation_passed
    assert all(store.read(name).count() == 0 for name in (SILVER, *GOLD_TABLES))


def test_views_for_sql(spark, store):
    run_batch(frame(spark, hot_rows(26)), store)
    register_views(store)
    total = "SELECT (SELECT sum(events_in_session) FROM sessions) = (SELECT count(*) FROM silver)"
    assert spark.sql(total).collect() == [(True,)]
    days = spark.sql("SELECT max(daily_active_users) FROM gold_dau").collect()
    expected = model.daily_active_users(model.clean(hot_rows(26), load_suite().rules))
    assert days == [(max(day[-1] for day in expected),)]


def test_gold_reads_only_what_is_given(spark, store):
    build_gold(frame(spark, [event("1", "u", "view")]), store)
    with pytest.raises(MissingTable):
        store.read(SILVER)


def test_command_line(spark, tmp_path, capfd):
    rows = hot_rows(27)
    source, bronze, root = (str(tmp_path / n) for n in ("in", "bronze", "store"))
    encode_events(frame(spark, rows)).write.parquet(source)
    ingest = ["ingest", "--format", "parquet", "--input", source, "--schema", "value binary"]
    main([*ingest, "--bronze", bronze, "--checkpoint", str(tmp_path / "c"), "--once"])
    cleaned = str(tmp_path / "cleaned")
    main([*ingest, "--bronze", cleaned, "--checkpoint", str(tmp_path / "c2"), "--once", "--clean"])
    kept = spark.read.parquet(cleaned)
    assert 0 < kept.count() == kept.select("event_id").distinct().count()
    assert kept.filter("user_id IS NULL").count() == 0
    main(["batch", "--bronze", bronze, "--store", root])
    store = VersionedStore(spark, root)
    check_tables(store, rows)
    main(["silver", "--bronze", bronze, "--store", root])
    main(["gold", "--store", root, "--keep", "1"])
    check_tables(store, rows)
    capfd.readouterr()
    main(["report", "--store", root, "--top", "3"])
    main(["validate", "--bronze", bronze])
    shown = capfd.readouterr().out
    for text in ("daily_active_users", "total_views", "total_sessions", "missing_percent", "error"):
        assert text in shown
    strict = ["validate", "--bronze", bronze, "--on-fail", "raise"]
    with pytest.raises(ContractViolation):
        main(strict)
    loose = tmp_path / "suite.json"
    loose.write_text(json.dumps({"expectations": []}))
    main([*strict, "--suite", str(loose)])
    loose.write_text(json.dumps({"expectations": [{"expectation_type": "x", "kwargs": {}}]}))
    with pytest.raises(SuiteError):
        main([*strict, "--suite", str(loose)])


def test_command_line_names_a_catalog(spark, tmp_path):
    args = _parser().parse_args(["gold", "--store", "catalog:local.clickstream"])
    store = _store(spark, args)
    assert isinstance(store, CatalogStore)
    assert (store.namespace, store.provider) == ("local.clickstream", "iceberg")
    args = _parser().parse_args(["gold", "--store", str(tmp_path), "--keep", "3"])
    assert (_store(spark, args).root, _store(spark, args).keep) == (str(tmp_path), 3)


def test_command_line_with_tables(spark, tmp_path):
    rows = [event("1", "u", "view"), event("2", "v", "scroll")]
    encode_events(frame(spark, rows)).write.parquet(str(tmp_path / "in"))
    source = ["--format", "parquet", "--input", str(tmp_path / "in"), "--schema", "value binary"]
    checkpoint = ["--checkpoint", str(tmp_path / "c"), "--once"]
    # The session catalog has no Iceberg, the default of a table.
    provider = ["--provider", "parquet", "--spread", "2", "--write-option", "compression=gzip"]
    main(["ingest", *source, "--bronze", "cli_bronze", *checkpoint, *provider])
    main(["batch", "--preview", "--bronze", "cli_bronze", "--store", str(tmp_path / "s"), "--on-fail", "raise"])
    check_tables(VersionedStore(spark, str(tmp_path / "s")), rows)
    spark.sql("DROP TABLE cli_bronze")


def test_command_line_shows_as_many_rows_as_asked_for(spark, tmp_path, capfd):
    rows = [
        event(str(i), f"u{i}", "view", f"2024-01-{i:02d}T00:00:00", page=f"/p{i}")
        for i in range(1, 31)
    ]
    rows += [event("1", "u1", "view")] * 2
    path, store = str(tmp_path / "b"), str(tmp_path / "s")
    frame(spark, rows).write.parquet(path)
    main(["batch", "--bronze", path, "--store", store])
    capfd.readouterr()
    main(["report", "--store", store, "--top", "30"])
    out = capfd.readouterr().out
    assert all(f"/p{i} " in out or f"/p{i}|" in out for i in range(1, 31)) and "only showing" not in out
    rule = {"expectation_type": "expect_column_values_to_not_be_null"}
    rules = [rule | {"kwargs": {"column": "page"}} for _ in range(24)]
    rules.append({"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "event_id"}})
    (tmp_path / "suite.json").write_text(json.dumps({"expectations": rules}))
    main(["validate", "--bronze", path, "--suite", str(tmp_path / "suite.json")])
    out = capfd.readouterr().out
    assert out.count("expect_column_values") == 25 and "only showing" not in out
    assert "|1    |3    |" in out


@pytest.mark.parametrize("wrong", [["--option", "x"], ["--once", "--every", "1 minute"]])
def test_wrong_arguments_are_named(wrong, capfd):
    with pytest.raises(SystemExit):
        _parser().parse_args(["ingest", "--bronze", "t", "--checkpoint", "c", *wrong])
    assert "usage" in capfd.readouterr().err


def test_repeated_cleaning_is_gone(spark):
    import __spark_entry__ as driver

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for name in ("engagement_sql", "publish_gold_sessions", "dq_silver_verdict", "silver_sample"):
        assert "Window" not in plan(driver.queries()[name](spark, "/root/testdata/sf0.001")), name
    keys = driver.queries()["dq_duplicate_keys"](spark, "/root/testdata/sf0.001")
    assert "rangepartitioning" not in plan(keys) and "Sort" not in plan(keys)

from __future__ import annotations

from pathlib import Path

import pytest

from model import event, frame, model_tuples, tuples
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from test_clean import hot_rows
from tidemark.operators import clean
from tidemark.schema import BRONZE_SCHEMA, PARTITION_COLUMNS, SILVER
from tidemark.sinks import CatalogStore, ConcurrentPublish, MissingTable, VersionedStore


@pytest.fixture
def root(tmp_path):
    return tmp_path / "store"


@pytest.fixture
def store(spark, root):
    return VersionedStore(spark, str(root))


def folders(root: Path, name: str):
    return sorted(p.name for p in (root / name / "data").iterdir())


def commits(root: Path, name: str):
    return sorted(p.name for p in (root / name / "commits").iterdir() if p.suffix == ".json")


def test_missing_table_is_named(store):
    with pytest.raises(MissingTable, match="gold_dau"):
        store.read("gold_dau")


def test_rerun_gives_the_same_table(spark, store, root):
    bronze = frame(spark, hot_rows(3))
    seen = []
    for _ in range(2):
        store.publish(clean(bronze), SILVER, PARTITION_COLUMNS)
        seen.append(tuples(store.read(SILVER).collect()))
    assert seen[0] == seen[1] == tuples(clean(bronze).collect())
    assert store.read(SILVER).schema == BRONZE_SCHEMA


def test_rows_partitions_and_nulls_come_back(spark, store, root):
    rows = [event("1", "u", "view"), event("2", "u", "view", None), event("3", "", None, page="")]
    path = store.publish(frame(spark, rows), SILVER, PARTITION_COLUMNS)
    assert tuples(store.read(SILVER).collect()) == model_tuples(rows)
    assert (Path(path) / "year=2024" / "month=1" / "day=2").is_dir()


def test_types_and_order_of_columns_come_back(spark, store):
    rows = [(7, 1, "x"), (None, 2, "y")]
    df = spark.createDataFrame(rows, "code long, `n.m` int, t string")
    store.publish(df, "codes", ["code"])
    found = store.read("codes")
    assert found.schema == df.schema
    assert tuples(found.collect()) == tuples(df.collect())


@pytest.mark.parametrize("partition_by", [[], PARTITION_COLUMNS])
def test_an_empty_table_can_be_read(spark, store, partition_by):
    store.publish(frame(spark, []), SILVER, partition_by)
    assert store.read(SILVER).schema == BRONZE_SCHEMA
    assert store.read(SILVER).count() == 0


def test_a_failing_write_leaves_the_old_version(spark, store, root):
    rows = [event("1", "u", "view")]
    store.publish(frame(spark, rows), SILVER, PARTITION_COLUMNS)
    before = folders(root, SILVER), commits(root, SILVER)
    broken = frame(spark, hot_rows(4)).withColumn(
        "page", F.when(F.col("user_id").isNull(), F.raise_error(F.lit("lost"))).otherwise("x")
    )
    with pytest.raises(Exception, match="lost"):
        store.publish(broken, SILVER, PARTITION_COLUMNS)
    assert tuples(store.read(SILVER).collect()) == model_tuples(rows)
    assert (folders(root, SILVER), commits(root, SILVER)) == before


def test_data_without_a_commit_is_not_a_version(spark, store, root):
    rows = [event("1", "u", "view")]
    store.publish(frame(spark, rows), SILVER)
    orphan = root / SILVER / "data" / "0000000002-dead"
    frame(spark, hot_rows(5)).write.parquet(str(orphan))
    assert tuples(store.read(SILVER).collect()) == model_tuples(rows)
    store.publish(frame(spark, []), SILVER)
    assert store.read(SILVER).count() == 0
    # It might belong to a publisher of the same version that is about to fail.
    assert orphan.is_dir()
    store.publish(frame(spark, rows), SILVER)
    assert not orphan.exists()
    assert [f.split("-")[0] for f in folders(root, SILVER)] == ["0000000002", "0000000003"]


def test_a_table_may_be_replaced_by_a_query_on_it(spark, store):
    store.publish(frame(spark, [event("1", "u", "view"), event("2", "u", "click")]), SILVER)
    store.publish(store.read(SILVER).filter("event_type = 'view'"), SILVER)
    assert [r["event_id"] for r in store.read(SILVER).collect()] == ["1"]


def test_old_versions_go_and_the_previous_one_stays(spark, store, root):
    store.publish(spark.range(1), "t")
    reader = None
    for n in (2, 3, 4):
        reader = store.read("t")
        store.publish(spark.range(n), "t")
    assert reader.count() == 3
    assert store.read("t").count() == 4
    assert commits(root, "t") == ["0000000003.json", "0000000004.json"]
    assert [f.split("-")[0] for f in folders(root, "t")] == ["0000000003", "0000000004"]


def test_keep_one(spark, root):
    store = VersionedStore(spark, str(root) + "/", keep=1)
    for n in (1, 2):
        store.publish(spark.range(n), "t")
    assert len(commits(root, "t")) == len(folders(root, "t")) == 1
    with pytest.raises(ValueError, match="keep"):
        VersionedStore(spark, str(root), keep=0)


def test_the_slower_of_two_publishers_fails_whole(spark, store, root, monkeypatch):
    store.publish(spark.range(1), "t")
    late = VersionedStore(spark, str(root))
    monkeypatch.setattr(late, "_versions", lambda name: [])
    with pytest.raises(ConcurrentPublish, match="version 1"):
        late.publish(spark.range(9), "t")
    assert store.read("t").count() == 1
    assert len(folders(root, "t")) == 1
    assert [p.name for p in (root / "t" / "commits").iterdir() if not p.name.endswith(".crc")] == [
        "0000000001.json"
    ]


def test_an_unclear_commit_keeps_the_data(spark, store, root, monkeypatch):
    """If the answer to the commit is lost, the version may exist and must be readable."""
    commit = store._commit

    def answer_lost(*args):
        commit(*args)
        raise OSError("connection lost")

    monkeypatch.setattr(store, "_commit", answer_lost)
    with pytest.raises(OSError, match="lost"):
        store.publish(spark.range(3), "t")
    assert store.read("t").count() == 3


@pytest.mark.parametrize(("gone", "warned"), [(0, False), (99, True)])
def test_a_version_removed_by_another_publisher_is_no_error(
    spark, store, root, caplog, monkeypatch, gone, warned
):
    for n in (1, 2):
        store.publish(spark.range(n), "t")
    (root / "t" / "data" / "notes").mkdir()
    listed = store._versions
    monkeypatch.setattr(store, "_versions", lambda name: [*listed(name), gone])
    store.publish(spark.range(3), "t")
    assert ("not removed" in caplog.text) == warned
    monkeypatch.undo()
    assert store.read("t").count() == 3
    assert (root / "t" / "data" / "notes").is_dir()


def test_partitioned_write_makes_few_files(spark, store):
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("event_id"), (F.col("id") % 7).cast("int").alias("day")
    )
    spread = rows.repartition(32, "event_id")
    path = store.publish(spread, "t", ["day"])
    assert len(list(Path(path).rglob("*.parquet"))) == 7


def test_a_hot_day_is_written_by_several_tasks(spark, store):
    """A third of the rows share one day; the other days stay in few files."""
    day = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20 + 2).cast("int")
    rows = spark.range(300_000).select(F.uuid().alias("event_id"), day.alias("day"))
    # Many more partitions than days, as on a cluster, so that days rarely share one.
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "500",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        path = store.publish(rows.repartition(32, "event_id"), "t", ["day"])
    finally:
        for name in settings:
            spark.conf.unset(name)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in Path(path).glob("day=*")}
    assert len(files) == 21
    assert files.pop("day=1") >= 4
    assert max(files.values()) <= 3
    assert store.read("t").count() == 300_000


def test_session_catalog_refuses_a_replace(spark):
    store = CatalogStore(spark, "default", "parquet")
    with pytest.raises(AnalysisException):
        store.publish(spark.range(1), "t")
    with pytest.raises(AnalysisException, match="never"):
        store.read("never")


def test_catalog_replace_asks_for_provider_and_partitions(spark, monkeypatch):
    calls = []

    class Writer:
        def __getattr__(self, name):
            def record(*args):
                calls.append((name, [str(a) for a in args]))
                return self

            return record

    def write_to(df, table):
        calls.append(("writeTo", [table]))
        return Writer()

    monkeypatch.setattr(type(spark.range(1)), "writeTo", write_to)
    assert issubclass(type(spark.range(1)), DataFrame)
    store = CatalogStore(spark, "lake.clicks")
    store.publish(frame(spark, []), SILVER, PARTITION_COLUMNS)
    store.publish(spark.range(1), "gold_dau")
    assert [name for name, _ in calls] == [
        "writeTo",
        "using",
        "partitionedBy",
        "createOrReplace",
        "writeTo",
        "using",
        "createOrReplace",
    ]
    assert calls[0] == ("writeTo", ["lake.clicks.silver"])
    assert calls[1] == ("using", ["iceberg"])
    assert len(calls[2][1]) == 3


def test_string_partitions_are_refused(spark, store):
    df = spark.createDataFrame([("", 1)], "code string, n int")
    with pytest.raises(ValueError, match="strings"):
        store.publish(df, "codes", ["code"])


def test_layout_without_adaptive_execution(spark, store):
    rows = hot_rows(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = store.publish(frame(spark, rows).repartition(8), SILVER, PARTITION_COLUMNS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tuples(store.read(SILVER).collect()) == model_tuples(rows)
    days = {p.parent for p in Path(path).rglob("*.parquet")}
    assert all(len(list(day.glob("*.parquet"))) <= 8 for day in days)


def test_catalog_writes_take_options_and_a_layout(spark, monkeypatch):
    seen = {}

    class Writer:
        def __getattr__(self, name):
            return lambda *a: seen.setdefault(name, []).append(a) or self

    def write_to(df, table):
        seen["plan"] = df._jdf.queryExecution().analyzed().toString()
        return Writer()

    rows = frame(spark, [event("1", "u", "view")])
    monkeypatch.setattr(type(rows), "writeTo", write_to)
    CatalogStore(spark, "c.ns").publish(rows, "t", PARTITION_COLUMNS, {"fanout-enabled": "true"})
    assert seen["option"] == [("fanout-enabled", "true")]
    assert "Rebalance" in seen["plan"] or "REBALANCE" in seen["plan"].upper()

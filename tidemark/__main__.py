"""Command line for ``spark-submit``; master, jars and memory come from the caller.

    python -m tidemark ingest --option kafka.bootstrap.servers=host:9092 \\
        --option subscribe=clicks --bronze /lake/bronze --checkpoint /lake/_ingest
    python -m tidemark batch --bronze /lake/bronze --store /lake/tables
    python -m tidemark report --store /lake/tables
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import (
    earliest_days,
    engagement,
    gate,
    latest_days,
    profile,
    session_sample,
    silver_sample,
    top_pages,
    validate,
)
from tidemark.plans import build_gold, build_silver, run_batch
from tidemark.schema import GOLD_DAU, GOLD_PAGE_VIEWS, GOLD_SESSIONS, SILVER, WATERMARK_DELAY
from tidemark.sinks import CatalogStore, VersionedStore
from tidemark.sources import (
    CLICKSTREAM_SUITE,
    load_suite,
    read_events,
    read_stream,
    read_table,
)
from tidemark.streaming import bronze_events, clean_stream, create_bronze_table, write_bronze

log = logging.getLogger("tidemark")
CATALOG_PREFIX = "catalog:"
# The option of a source that bounds a micro-batch.
MOST_PER_BATCH = {"kafka": "maxOffsetsPerTrigger"}


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    logging.basicConfig(format="%(levelname)s %(name)s: %(message)s")
    logging.getLogger("tidemark").setLevel(logging.INFO)
    spark = SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
    if not spark.sparkContext.getConf().contains("spark.sql.session.timeZone"):
        # Calendar days must not depend on the host.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    args.run(spark, args)


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    options = dict(args.option)
    if args.format in MOST_PER_BATCH and args.most_per_batch:
        options.setdefault(MOST_PER_BATCH[args.format], str(args.most_per_batch))
    messages = read_stream(spark, args.format, options, args.input, args.schema)
    provider = args.provider or ("parquet" if _is_path(args.bronze) else "iceberg")
    target: dict[str, Any] = {"path": args.bronze, "fmt": provider}
    if not _is_path(args.bronze):
        create_bronze_table(spark, args.bronze, provider)
        target = {"table": args.bronze, "fmt": provider}
    target |= {"options": dict(args.write_option), "spread": args.spread}
    trigger = {"processingTime": args.every} if args.every else None
    if args.once:
        trigger = {"availableNow": True}
    if args.clean:
        events = clean_stream(bronze_events(messages, watermark=None), load_suite(args.suite, spark), args.delay)
    else:
        events = bronze_events(messages)
    query = write_bronze(events, args.checkpoint, trigger=trigger, **target)
    query.awaitTermination()


def _validate(spark: SparkSession, args: argparse.Namespace) -> None:
    bronze, suite = _bronze(spark, args), load_suite(args.suite, spark)
    report = validate(bronze, suite, args.values)
    # A row per rule: held here so that nothing below checks the table again.
    rows = sorted(report.collect(), key=lambda row: row["position"])
    report = spark.createDataFrame(rows, report.schema)
    profile(report).orderBy("position").show(max(1, len(suite.rules)), truncate=False)
    for row in rows:
        if args.values and row["samples"]:
            log.info("%s on %s", row["rule"], row["column"])
            values = spark.createDataFrame(row["samples"], report.schema["samples"].dataType.elementType)
            values.show(args.values, truncate=False)
    gate(report, args.on_fail)


def _silver(spark: SparkSession, args: argparse.Namespace) -> None:
    suite = load_suite(args.suite, spark)
    store = _store(spark, args)
    build_silver(_bronze(spark, args), store, suite, args.on_fail)
    _preview(args, silver_sample(store.read(SILVER)))


def _gold(spark: SparkSession, args: argparse.Namespace) -> None:
    store = _store(spark, args)
    build_gold(store.read(SILVER), store)
    _preview_gold(args, store)


def _preview(args: argparse.Namespace, *samples: DataFrame) -> None:
    if args.preview:
        for sample in samples:
            sample.show(truncate=False)


def _preview_gold(args: argparse.Namespace, store: VersionedStore | CatalogStore) -> None:
    _preview(
        args,
        earliest_days(store.read(GOLD_DAU)),
        top_pages(store.read(GOLD_PAGE_VIEWS)),
        session_sample(store.read(GOLD_SESSIONS)),
    )


def _batch(spark: SparkSession, args: argparse.Namespace) -> None:
    suite = load_suite(args.suite, spark)
    store = _store(spark, args)
    run_batch(_bronze(spark, args), store, suite, args.on_fail)
    _preview(args, silver_sample(store.read(SILVER)))
    _preview_gold(args, store)


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    store = _store(spark, args)
    latest_days(store.read(GOLD_DAU), args.top).show(args.top, truncate=False)
    top_pages(store.read(GOLD_PAGE_VIEWS), args.top).show(args.top, truncate=False)
    engagement(store.read(GOLD_SESSIONS)).show(truncate=False)


def _pair(text: str) -> tuple[str, str]:
    key, equals, value = text.partition("=")
    if not key or not equals:
        raise argparse.ArgumentTypeError(f"{text!r} isn't KEY=VALUE")
    return key, value


def _is_path(name: str) -> bool:
    return "/" in name


def _bronze(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if _is_path(args.bronze):
        return read_events(spark, args.bronze)
    return read_table(spark, args.bronze)


def _store(spark: SparkSession, args: argparse.Namespace) -> VersionedStore | CatalogStore:
    if args.store.startswith(CATALOG_PREFIX):
        return CatalogStore(spark, args.store.removeprefix(CATALOG_PREFIX), args.provider)
    return VersionedStore(spark, args.store, args.keep)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description="Click-event tables on Spark")
    commands = parser.add_subparsers(dest="command", required=True)

    bronze = argparse.ArgumentParser(add_help=False)
    bronze.add_argument("--bronze", required=True, help="raw events: a path (with /) or a table")
    checks = argparse.ArgumentParser(add_help=False)
    checks.add_argument("--suite", default=CLICKSTREAM_SUITE, help="JSON rule suite")
    checks.add_argument("--on-fail", choices=["warn", "raise"], default="warn")
    store = argparse.ArgumentParser(add_help=False)
    store.add_argument("--store", required=True, help="root path, or catalog:<namespace>")
    store.add_argument("--provider", default="iceberg", help="table provider of the catalog")
    store.add_argument("--keep", type=int, default=2, help="versions kept under a root path")

    ingest = commands.add_parser("ingest", parents=[bronze], help="stream messages to raw events")
    ingest.add_argument("--format", default="kafka")
    pairs = {"action": "append", "type": _pair, "default": [], "metavar": "KEY=VALUE"}
    ingest.add_argument("--option", help="of the source", **pairs)
    ingest.add_argument("--write-option", help="of the raw table's writer", **pairs)
    ingest.add_argument(
        "--most-per-batch",
        type=int,
        default=50_000_000,
        help="Kafka offsets a micro-batch takes at most, 0 for all there are",
    )
    ingest.add_argument("--spread", type=int, help="tasks a day's rows go to, for a backfill")
    ingest.add_argument("--clean", action="store_true", help="clean rows by the suite as they arrive")
    ingest.add_argument("--suite", default=CLICKSTREAM_SUITE, help="JSON rule suite")
    ingest.add_argument("--delay", default=WATERMARK_DELAY, help="how late a repeat may come with --clean")
    ingest.add_argument("--input", help="path, for file formats")
    ingest.add_argument("--schema", help="DDL schema, for file formats")
    ingest.add_argument("--provider", help="format of the raw table: iceberg, parquet for a path")
    ingest.add_argument("--checkpoint", required=True)
    when = ingest.add_mutually_exclusive_group()
    when.add_argument("--every", help="trigger interval, as '1 minute'; default: at once")
    when.add_argument("--once", action="store_true", help="read what there is and stop")
    ingest.set_defaults(run=_ingest)

    for name, run, parents, text in (
        ("validate", _validate, [bronze, checks], "check raw events, write nothing"),
        ("silver", _silver, [bronze, checks, store], "replace the clean table"),
        ("gold", _gold, [store], "replace the metric tables"),
        ("batch", _batch, [bronze, checks, store], "silver, then gold"),
        ("report", _report, [store], "show the metrics"),
    ):
        commands.add_parser(name, parents=parents, help=text).set_defaults(run=run)
    commands.choices["report"].add_argument("--top", type=int, default=5)
    commands.choices["validate"].add_argument(
        "--values", type=int, default=20, help="bad values shown per rule, most frequent first"
    )
    for name in ("silver", "gold", "batch"):
        commands.choices[name].add_argument("--preview", action="store_true", help="show some rows")
    return parser


if __name__ == "__main__":
    main()

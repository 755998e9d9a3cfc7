"""

The ``events`` table becomes click events by the mapping of ``FIXTURES.md``: session,
page and device are derived, some user ids are nulled and some rows come twice, so that
checking and cleaning have something to find. All rows of the table take part.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import decode_events, encode_events, with_date_parts
from tidemark.operators import (
    clean,
    daily_active_users,
    drop_nulls,
    earliest_days,
    engagement,
    keep_allowed,
    keep_first,
    latest_days,
    observed_quantiles,
    page_views,
    profile,
    session_metrics,
    session_sample,
    silver_sample,
    top_pages,
    unexpected_values,
    validate,
    verdict,
)
from tidemark.plans import build_gold, register_views, run_batch
from tidemark.schema import (
    ALLOWED_EVENT_TYPES,
    GOLD_DAU,
    GOLD_PAGE_VIEWS,
    GOLD_SESSIONS,
    PARTITION_COLUMNS,
    SILVER,
)
from tidemark.sinks import VersionedStore
from tidemark.sinks.layout import laid_out
from tidemark.sources import (
    BETWEEN,
    COLUMN_EXISTS,
    COMPOUND,
    DECREASING,
    DISTINCT_CONTAIN,
    DISTINCT_EQUAL,
    DISTINCT_IN,
    INCREASING,
    IN_SET,
    LENGTHS,
    MATCHES,
    MEDIAN,
    NOT_IN_SET,
    NOT_NULL,
    NULL,
    PAIR_EQUAL,
    PAIR_GREATER,
    PAIR_IN,
    QUANTILES,
    ROW_COUNT,
    UNIQUE,
    Rule,
    Suite,
    load_suite,
    read_events,
    read_stream,
    read_table,
)
from tidemark.streaming import bronze_events, clean_stream, create_bronze_table, write_bronze

try:
    import corpus_pipeline
    from tidemark.llm import queries as llm
except ImportError as missing:
    # The subpackage, or a library that only it needs, isn't here: the rest goes on without its queries.
    logging.getLogger(__name__).warning("no queries on training data, %s is missing", missing.name)
    llm = corpus_pipeline = None

NOT_NULL_RULE = Rule(NOT_NULL, "user_id")
UNIQUE_RULE = Rule(UNIQUE, "event_id")
IN_SET_RULE = Rule(IN_SET, "event_type", tuple(ALLOWED_EVENT_TYPES))
SUITE_FILE = Path(__file__).resolve().parent / "conf" / "clickstream_suite.json"
# Listed fractions that the columns can't hold must match nothing.
NUMERIC_SUITE = Suite(
    "numeric",
    (Rule(IN_SET, "whole", (1.5, 2, "3", 4.0, 0.4)), Rule(IN_SET, "amount", (0.5, 1, 1.04, "1.5"))),
)
CHECK_ONLY = {
    "not_in_set": Rule(NOT_IN_SET, "device", ("tablet", "tv")),
    "between": Rule(BETWEEN, "timestamp", min_value="2024-01-05", max_value="2024-01-20"),
    "regex": Rule(MATCHES, "page", regex="[0-3]$"),
    "null": Rule(NULL, "user_id"),
    "lengths": Rule(LENGTHS, "event_id", min_value=2, max_value=4),
    "row_count": Rule(ROW_COUNT, min_value=1, max_value=100),
    "column_exists": Rule(COLUMN_EXISTS, "Session_ID"),
    "mostly": Rule(NOT_NULL, "user_id", mostly=0.9),
    "distinct_in_set": Rule(DISTINCT_IN, "event_type", ("click", "view", "purchase")),
    "distinct_contain_set": Rule(DISTINCT_CONTAIN, "event_type", ("click", "view", "refund")),
    "distinct_equal_set": Rule(DISTINCT_EQUAL, "device", ("mobile", "desktop", "tablet")),
    "pair_greater": Rule(PAIR_GREATER, columns=("day", "user_id"), ignore="any"),
    "pair_in_set": Rule(
        PAIR_IN, value_set=(("click", "mobile"), ("view", "tablet")), columns=("event_type", "device"), mostly=0.2
    ),
    "pair_equal": Rule(PAIR_EQUAL, columns=("user_id", "event_id"), mostly=0.1),
    "compound_unique": Rule(COMPOUND, columns=("session_id", "page")),
    "increasing": Rule(INCREASING, "timestamp", order_by="event_id"),
}
QUANTILE_RULES = (
    Rule(QUANTILES, "value", quantiles=((0.1, 0, 10), (0.5, 50, None), (0.9, None, 500)), error=0.00001),
    Rule(MEDIAN, "ts", min_value="2024-01-10", max_value="2024-01-20", error=0.00001),
    Rule(MEDIAN, "value", min_value=0, exact=True),
)
# Text that is compared with numbers; most of it is none.
TEXT_RULES = (
    Rule(BETWEEN, "user_id", min_value=100, max_value=500.5),
    Rule(BETWEEN, "session_id", max_value=1),
    Rule(BETWEEN, "page", min_value="/p2"),
)
SAMPLED_RULES = (
    IN_SET_RULE,
    Rule(NOT_IN_SET, "device", ("tablet", "tv")),
    Rule(MATCHES, "page", regex="[0-3]$"),
    Rule(PAIR_GREATER, columns=("month", "day"), ignore="none"),
)


# ------------------------------------------------------------------ inputs


def map_events(events: DataFrame) -> DataFrame:
    """``events`` rows as click events, batch or stream, one scan."""
    return events.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS STRING) END AS user_id",
        "concat_ws('-', user_id, date_format(ts, 'yyyyMMdd')) AS session_id",
        "event_type",
        "concat('/p', CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 6) AS page",
        "CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "explode(array_repeat(1, IF(event_id % 10 = 0, 2, 1))) AS copy",
    ).drop("copy")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return map_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_date_parts(click_events(spark, sf_dir))


def skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events where a third share one event id, another third has no session and a
    fifth has no time (and so no day)."""
    return bronze(spark, sf_dir).selectExpr(
        "IF(event_id % 3 = 0, 'hot', event_id) AS event_id",
        "user_id",
        "IF(event_id % 3 = 1, NULL, session_id) AS session_id",
        "event_type",
        "page",
        "device",
        "IF(event_id % 5 = 0, NULL, timestamp) AS timestamp",
        *[f"IF(event_id % 5 = 0, NULL, {part}) AS {part}" for part in PARTITION_COLUMNS],
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be null as text: a comparison through floats can't keep both."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def malformed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, seven of eight spoilt in a way of their own."""
    text = "CAST(value AS STRING)"
    kind = f"CAST(regexp_extract({text}, '[0-9]+', 0) AS BIGINT) % 8"
    return encode_events(click_events(spark, sf_dir)).selectExpr(
        f"""CAST(CASE {kind}
            WHEN 0 THEN left({text}, length({text}) - 5)
            WHEN 1 THEN concat('[', {text}, ']')
            WHEN 2 THEN regexp_replace({text}, '"timestamp":".*"', '"timestamp":"soon"')
            WHEN 3 THEN 'null'
            WHEN 4 THEN ''
            WHEN 5 THEN NULL
            WHEN 6 THEN replace({text}, '"event_type"', '"EVENT_TYPE"')
            ELSE {text} END AS BINARY) AS value"""
    )


def numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole and a decimal column, with nulls."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "CAST(IF(event_id % 7 = 0, NULL, user_id % 10) AS INT) AS whole",
        "CAST(event_id % 5 AS DECIMAL(5, 0)) / 2 AS half",
    ).selectExpr("event_id", "whole", "CAST(half AS DECIMAL(6, 1)) AS amount")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(bronze(spark, sf_dir))


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder the session names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    folder = f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    # The result reads from it lazily, so it goes with the session and not before.
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of JSON messages, read by the file source."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # As a glob the path may be one file (plain, the source wants a folder) or a folder.
    path = f"{sf_dir}/{{events.parquet}}"
    return encode_events(map_events(read_stream(spark, "parquet", path=path, schema=schema)))


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream all messages into a raw folder, then scan it."""
    work = scratch(spark)
    stream = bronze_events(message_stream(spark, sf_dir))
    write_bronze(
        stream, f"{work}/checkpoint", path=f"{work}/bronze", trigger={"availableNow": True}
    ).awaitTermination()
    return read_events(spark, f"{work}/bronze")


def ingest_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream all messages into a table created beforehand, then scan it."""
    work, table = scratch(spark), f"tidemark_bronze_{uuid.uuid4().hex}"
    create_bronze_table(spark, table, location=f"{work}/bronze")
    write_bronze(
        bronze_events(message_stream(spark, sf_dir)),
        f"{work}/checkpoint",
        table=table,
        trigger={"availableNow": True},
    ).awaitTermination()
    rows = read_table(spark, table)
    # The files stay until the session ends; the plan has found them, so the name can go.
    spark.sql(f"DROP TABLE {table}")
    return rows


def publish_silver_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace the clean table twice; the second run must change nothing."""
    store = VersionedStore(spark, scratch(spark))
    for _ in range(2):
        store.publish(silver(spark, sf_dir), SILVER, PARTITION_COLUMNS)
    return store.read(SILVER)


def ingest_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean all messages as they arrive, then scan what was written."""
    work = scratch(spark)
    stream = clean_stream(bronze_events(message_stream(spark, sf_dir), watermark=None))
    write_bronze(
        stream, f"{work}/checkpoint", path=f"{work}/silver", trigger={"availableNow": True}
    ).awaitTermination()
    return read_events(spark, f"{work}/silver")


def ordered_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions stored with the largest first; the rows of each file, how many come before a larger one
    of its file, and how many files reach into the range of the file before."""
    path = f"{scratch(spark)}/sessions"
    laid_out(session_metrics(silver(spark, sf_dir)), [], ["-events_in_session"], 8).write.parquet(path)
    rows = spark.read.parquet(path).select(
        "events_in_session", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("id")
    )
    size = F.col("events_in_session")
    unsorted = F.lead("events_in_session").over(Window.partitionBy("file").orderBy("id")) > size
    per_file = rows.withColumn("unsorted", unsorted).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("unsorted").alias("unsorted"), F.min(size).alias("least"), F.max(size).alias("most")
    )
    before = F.min("least").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return per_file.withColumn("overlaps", F.coalesce(F.col("most") > before, F.lit(False))).agg(
        F.sum("n").alias("n_sessions"), F.sum("unsorted").alias("n_unsorted"), F.count_if("overlaps").alias("n_overlaps")
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def quantiles_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quantiles of the rules over ``value``, each with its rule."""
    found = [
        observed_quantiles(raw_events(spark, sf_dir), rule).select(F.lit(i).alias("position"), "*")
        for i, rule in enumerate(QUANTILE_RULES, 1)
        if rule.column == "value"
    ]
    return reduce(DataFrame.unionByName, found)


def published_silver(spark: SparkSession, sf_dir: str) -> VersionedStore:
    store = VersionedStore(spark, scratch(spark))
    store.publish(silver(spark, sf_dir), SILVER, PARTITION_COLUMNS)
    return store


def published_sessions(spark: SparkSession, sf_dir: str) -> VersionedStore:
    store = published_silver(spark, sf_dir)
    build_gold(store.read(SILVER), store, [GOLD_SESSIONS])
    return store


def sampled_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = published_silver(spark, sf_dir).read(SILVER)
    return found_in(silver_sample(table), table)


def sampled_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = published_sessions(spark, sf_dir).read(GOLD_SESSIONS)
    return found_in(session_sample(table), table)


def found_in(sample: DataFrame, table: DataFrame) -> DataFrame:
    """How many rows a sample has, and how many of them the table has: the same for any sample."""
    names = sample.columns
    there = table.select(*names).distinct().select(*[F.col(c).alias(f"own_{c}") for c in names])
    same = [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in names]
    rows = sample.join(there.withColumn("found", F.lit(1)), same, "left")
    return rows.agg(F.count(F.lit(1)).alias("n_sampled"), F.count("found").alias("n_found"))


def batch_run(spark: SparkSession, sf_dir: str) -> VersionedStore:
    store = VersionedStore(spark, scratch(spark))
    run_batch(bronze(spark, sf_dir), store)
    return store


def engagement_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engagement report as SQL over the view of the published sessions."""
    register_views(published_sessions(spark, sf_dir), [GOLD_SESSIONS])
    return spark.sql(ENGAGEMENT_SQL.format(avg="duration_seconds"))


# The names of the report's columns.
ENGAGEMENT_SQL = """
    SELECT count(session_id) AS total_sessions,
           round(avg({avg}), 2) AS avg_session_length_seconds,
           max(events_in_session) AS max_clicks_in_one_session
    FROM sessions"""


# ----------------------------------------------------------------- queries


def entry(spark: SparkSession) -> DataFrame:
    """Daily active users over cleaned events."""
    return daily_active_users(silver(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    report = Suite("report", (NOT_NULL_RULE, UNIQUE_RULE, IN_SET_RULE))
    dau = lambda s, d: daily_active_users(silver(s, d))
    views = lambda s, d: page_views(silver(s, d))
    sessions = lambda s, d: session_metrics(silver(s, d))
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # messages
        "encode_events": lambda s, d: encode_events(click_events(s, d)).withColumn(
            "value", F.col("value").cast("string")
        ),
        "decode_events": lambda s, d: decode_events(encode_events(click_events(s, d))),
        "decode_malformed": lambda s, d: decode_events(malformed_messages(s, d)),
        "date_parts": lambda s, d: bronze(s, d).select("event_id", *PARTITION_COLUMNS),
        # streaming
        "stream_bronze": ingest,
        "stream_bronze_table": ingest_to_table,
        "stream_silver": lambda s, d: clean(ingest(s, d)),
        "stream_clean": ingest_clean,
        "stream_gold_dau": lambda s, d: daily_active_users(clean(ingest(s, d))),
        # checks
        "dq_not_null": lambda s, d: validate(bronze(s, d), Suite("", (NOT_NULL_RULE,))),
        "dq_unique": lambda s, d: validate(bronze(s, d), Suite("", (UNIQUE_RULE,))),
        "dq_in_set": lambda s, d: validate(bronze(s, d), Suite("", (IN_SET_RULE,))),
        "dq_report": lambda s, d: validate(bronze(s, d), report),
        "dq_verdict": lambda s, d: verdict(validate(bronze(s, d), report)),
        "dq_silver_verdict": lambda s, d: verdict(
            validate(published_silver(s, d).read(SILVER), report)
        ),
        "dq_profile": lambda s, d: profile(validate(bronze(s, d), report)),
        "dq_unexpected_values": lambda s, d: unexpected_values(bronze(s, d), IN_SET_RULE),
        "dq_duplicate_keys": lambda s, d: unexpected_values(bronze(s, d), UNIQUE_RULE),
        "dq_top_duplicate_keys": lambda s, d: unexpected_values(bronze(s, d), UNIQUE_RULE, 20),
        "dq_in_set_numeric": lambda s, d: validate(numeric(s, d), NUMERIC_SUITE),
        "dq_suite_file": lambda s, d: validate(bronze(s, d), load_suite(SUITE_FILE, s)),
        **{
            f"dq_{name}": lambda s, d, rule=rule: validate(bronze(s, d), Suite("", (rule,)))
            for name, rule in CHECK_ONLY.items()
        },
        "dq_quantiles": lambda s, d: validate(raw_events(s, d), Suite("", QUANTILE_RULES)),
        "dq_quantile_values": quantiles_seen,
        "dq_decreasing": lambda s, d: validate(
            raw_events(s, d), Suite("", (Rule(DECREASING, "user_id", order_by="ts", strictly=True),))
        ),
        "dq_between_text": lambda s, d: validate(bronze(s, d), Suite("", TEXT_RULES)),
        "dq_samples": lambda s, d: validate(bronze(s, d), Suite("", SAMPLED_RULES), 40).select(
            "position", F.inline("samples")
        ),
        # cleaning
        "clean_not_null": lambda s, d: drop_nulls(bronze(s, d), "user_id"),
        "clean_unique": lambda s, d: keep_first(bronze(s, d), "event_id"),
        "clean_in_set": lambda s, d: keep_allowed(
            bronze(s, d), "event_type", ALLOWED_EVENT_TYPES
        ),
        "clean_in_set_numeric": lambda s, d: keep_allowed(
            keep_allowed(numeric(s, d), "whole", NUMERIC_SUITE.rules[0].value_set),
            "amount",
            NUMERIC_SUITE.rules[1].value_set,
        ),
        "clean_first_event_per_session": lambda s, d: keep_first(bronze(s, d), "session_id"),
        "silver": silver,
        "silver_set_before_unique": lambda s, d: clean(
            bronze(s, d), Suite("", (IN_SET_RULE, Rule(UNIQUE, "session_id")))
        ),
        "silver_unique_before_set": lambda s, d: clean(
            bronze(s, d), Suite("", (Rule(UNIQUE, "session_id"), IN_SET_RULE))
        ),
        # the same on skewed input
        "skewed_dq_report": lambda s, d: validate(skewed(s, d), report),
        "skewed_dq_compound_unique": lambda s, d: validate(
            skewed(s, d), Suite("", (CHECK_ONLY["compound_unique"],))
        ),
        "skewed_dq_increasing": lambda s, d: validate(
            skewed(s, d), Suite("", (CHECK_ONLY["increasing"],))
        ),
        "skewed_silver": lambda s, d: as_text(clean(skewed(s, d), report), *PARTITION_COLUMNS),
        "skewed_dau": lambda s, d: as_text(daily_active_users(skewed(s, d)), *PARTITION_COLUMNS),
        "skewed_sessions": lambda s, d: as_text(
            session_metrics(skewed(s, d)), "duration_seconds"
        ),
        "skewed_engagement": lambda s, d: engagement(session_metrics(skewed(s, d))),
        # metrics and reports
        "gold_dau": dau,
        "gold_page_views": views,
        "gold_sessions": sessions,
        "latest_days": lambda s, d: latest_days(dau(s, d)),
        "earliest_days": lambda s, d: earliest_days(dau(s, d)),
        "top_pages": lambda s, d: top_pages(views(s, d)),
        "engagement": lambda s, d: engagement(sessions(s, d)),
        "engagement_sql": engagement_by_sql,
        "silver_sample": sampled_silver,
        "session_sample": sampled_sessions,
        # publishing
        "publish_twice": publish_silver_twice,
        "publish_gold_sessions": lambda s, d: published_sessions(s, d).read(GOLD_SESSIONS),
        "ordered_sessions": ordered_sessions,
        "batch_silver": lambda s, d: batch_run(s, d).read(SILVER),
        "batch_latest_days": lambda s, d: latest_days(batch_run(s, d).read(GOLD_DAU)),
        "batch_top_pages": lambda s, d: top_pages(batch_run(s, d).read(GOLD_PAGE_VIEWS)),
    }
    found = {name: _zoneless(query) for name, query in found.items()}
    if llm is not None:
        found |= {**llm.queries(), "pipeline": corpus_pipeline.run}
    return found


def _zoneless(
    query: Callable[[SparkSession, str], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    """Give times without zone, as the SQL twins do, whatever zone the caller runs in."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})

    return run


# --------------------------------------------------------------- SQL twins

BRONZE_SQL = """
WITH mapped AS (
    SELECT event_id AS n,
           CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
           CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
           event_type,
           '/p' || CAST(CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 6 AS VARCHAR) AS page,
           CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
               AS device,
           ts AS "timestamp",
           CAST(year(ts) AS INTEGER) AS "year",
           CAST(month(ts) AS INTEGER) AS "month",
           CAST(day(ts) AS INTEGER) AS "day"
    FROM events
), bronze AS (
    SELECT * EXCLUDE (n) FROM mapped
    UNION ALL
    SELECT * EXCLUDE (n) FROM mapped WHERE n % 10 = 0
)"""


SKEWED_SQL = (
    BRONZE_SQL.replace("bronze AS (", "plain AS (")
    + """, bronze AS (
    SELECT CASE WHEN n % 3 = 0 THEN 'hot' ELSE event_id END AS event_id, user_id,
           CASE WHEN n % 3 <> 1 THEN session_id END AS session_id, event_type, page, device,
           CASE WHEN n % 5 <> 0 THEN "timestamp" END AS "timestamp",
           CASE WHEN n % 5 <> 0 THEN "year" END AS "year",
           CASE WHEN n % 5 <> 0 THEN "month" END AS "month",
           CASE WHEN n % 5 <> 0 THEN "day" END AS "day"
    FROM (SELECT CAST(event_id AS BIGINT) AS n, * FROM plain))"""
)


def _first_per(key: str, source: str) -> str:
    order = [
        c
        for c in ("user_id", "event_id", "session_id", "event_type", "page", "device")
        if c != key
    ]
    order = ['"timestamp" NULLS LAST'] + [f"{c} NULLS FIRST" for c in order]
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key}"
        f" ORDER BY {', '.join(order)}) AS rn FROM {source}) WHERE rn = 1"
    )


IN_SET_SQL = "event_type IN ('click', 'view', 'purchase', 'scroll')"
SILVER_STEPS = f""", named AS (SELECT * FROM bronze WHERE user_id IS NOT NULL),
kept AS ({_first_per("event_id", "named")}),
silver AS (SELECT * FROM kept WHERE {IN_SET_SQL})"""
CHECK_STEPS = f""", checks AS (
    SELECT 1 AS position, '{NOT_NULL}' AS rule, 'user_id' AS "column",
           count(*) AS element_count,
           count(*) FILTER (WHERE user_id IS NULL) AS missing_count,
           count(*) FILTER (WHERE user_id IS NULL) AS unexpected_count
    FROM bronze
    UNION ALL
    SELECT 2, '{UNIQUE}', 'event_id', CAST(coalesce(sum(n), 0) AS BIGINT),
           CAST(coalesce(sum(n) FILTER (WHERE event_id IS NULL), 0) AS BIGINT),
           CAST(coalesce(sum(n) FILTER (WHERE event_id IS NOT NULL AND n > 1), 0) AS BIGINT)
    FROM (SELECT event_id, count(*) AS n FROM bronze GROUP BY event_id)
    UNION ALL
    SELECT 3, '{IN_SET}', 'event_type', count(*),
           count(*) FILTER (WHERE event_type IS NULL),
           count(*) FILTER (WHERE NOT {IN_SET_SQL})
    FROM bronze)"""
REPORT_STEPS = f"""{CHECK_STEPS}
SELECT *, unexpected_count = 0 AS success,
       CASE WHEN unexpected_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM checks"""


def _dau_steps(source: str) -> str:
    return f""", dau AS (
    SELECT "year", "month", "day", count(DISTINCT user_id) AS daily_active_users
    FROM {source} GROUP BY "year", "month", "day")"""


def _view_steps(source: str) -> str:
    return f""", views AS (
    SELECT page, count(*) AS total_views FROM {source} WHERE event_type = 'view' GROUP BY page)"""


def _session_steps(source: str) -> str:
    return f""", sessions AS (
    SELECT session_id, events_in_session, session_start, session_end,
           CAST(floor(epoch(session_end)) - floor(epoch(session_start)) AS BIGINT)
               AS duration_seconds
    FROM (SELECT session_id, count(*) AS events_in_session, min("timestamp") AS session_start,
                 max("timestamp") AS session_end
          FROM {source} GROUP BY session_id))"""


SILVER_SQL = BRONZE_SQL + SILVER_STEPS
CHECKS_SQL = BRONZE_SQL + CHECK_STEPS
REPORT_SQL = BRONZE_SQL + REPORT_STEPS
DAU_SQL = SILVER_SQL + _dau_steps("silver")
VIEWS_SQL = SILVER_SQL + _view_steps("silver")
SESSIONS_SQL = SILVER_SQL + _session_steps("silver")


def _single_rule(position: int) -> str:
    return REPORT_SQL.replace("SELECT *,", "SELECT 1 AS position, * EXCLUDE (position),") + (
        f" WHERE position = {position}"
    )


NUMERIC_SQL = """WITH numeric AS (
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(user_id % 10 AS INTEGER) END AS whole,
           CAST((event_id % 5) / 2.0 AS DECIMAL(6, 1)) AS amount FROM events)"""


def _rule_row(
    position: int, kind: str, column: str, missing: str, bad: str, mostly: float = 1, source: str = "bronze"
) -> str:
    """The report row of one rule; ``bad`` holds of the values that break it."""
    n = f"count(*) FILTER (WHERE {bad})" if "count(" not in bad else f"CAST({bad} AS BIGINT)"
    looked_at = "count(*)" if kind in (NOT_NULL, NULL) else f"(count(*) - {missing})"
    ok = f"({looked_at} - {n}) / {looked_at} >= {mostly}" if mostly < 1 else f"{n} = 0"
    return f"""SELECT {position} AS position, '{kind}' AS rule, CAST({column} AS VARCHAR) AS "column",
        count(*) AS element_count, CAST({missing} AS BIGINT) AS missing_count,
        {n} AS unexpected_count, {ok} AS success,
        CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"""


def _nulls(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NULL)"


CHECK_ONLY_SQL = {
    "not_in_set": (NOT_IN_SET, "'device'", _nulls("device"), "device IN ('tablet', 'tv')"),
    "between": (
        BETWEEN,
        "'timestamp'",
        _nulls('"timestamp"'),
        """"timestamp" < '2024-01-05' OR "timestamp" > '2024-01-20'""",
    ),
    "regex": (MATCHES, "'page'", _nulls("page"), "NOT regexp_matches(page, '[0-3]$')"),
    "null": (NULL, "'user_id'", _nulls("user_id"), "user_id IS NOT NULL"),
    "lengths": (LENGTHS, "'event_id'", _nulls("event_id"), "length(event_id) NOT BETWEEN 2 AND 4"),
    "row_count": (ROW_COUNT, "NULL", "0", "CASE WHEN count(*) BETWEEN 1 AND 100 THEN 0 ELSE 1 END"),
    "column_exists": (COLUMN_EXISTS, "'Session_ID'", "0", "false"),
    "mostly": (NOT_NULL, "'user_id'", _nulls("user_id"), "user_id IS NULL", 0.9),
    "distinct_in_set": (
        DISTINCT_IN,
        "'event_type'",
        _nulls("event_type"),
        "event_type NOT IN ('click', 'view', 'purchase')",
    ),
    "distinct_contain_set": (
        DISTINCT_CONTAIN,
        "'event_type'",
        _nulls("event_type"),
        "3 - count(DISTINCT event_type) FILTER (WHERE event_type IN ('click', 'view', 'refund'))",
    ),
    "distinct_equal_set": (
        DISTINCT_EQUAL,
        "'device'",
        _nulls("device"),
        "3 - count(DISTINCT device) FILTER (WHERE device IN ('mobile', 'desktop', 'tablet'))"
        " + count(*) FILTER (WHERE device NOT IN ('mobile', 'desktop', 'tablet'))",
    ),
    "pair_greater": (
        PAIR_GREATER,
        "'day, user_id'",
        'count(*) FILTER (WHERE "day" IS NULL OR user_id IS NULL)',
        '"day" <= TRY_CAST(user_id AS INTEGER)',
    ),
    "pair_in_set": (
        PAIR_IN,
        "'event_type, device'",
        "count(*) FILTER (WHERE event_type IS NULL AND device IS NULL)",
        "(event_type, device) NOT IN (('click', 'mobile'), ('view', 'tablet'))",
        0.2,
    ),
    "pair_equal": (
        PAIR_EQUAL,
        "'user_id, event_id'",
        "count(*) FILTER (WHERE user_id IS NULL AND event_id IS NULL)",
        "coalesce(user_id <> event_id, true)",
        0.1,
    ),
}


def _compound(source: str) -> str:
    return f"""{source}, keys AS (
            SELECT session_id, page, count(*) AS n FROM bronze GROUP BY session_id, page),
        totals AS (
            SELECT CAST(sum(n) AS BIGINT) AS element_count,
                   CAST(coalesce(sum(n) FILTER (WHERE session_id IS NULL AND page IS NULL), 0) AS BIGINT)
                       AS missing_count,
                   CAST(coalesce(sum(n) FILTER (WHERE n > 1 AND (session_id IS NOT NULL OR page IS NOT NULL)), 0)
                       AS BIGINT) AS unexpected_count
            FROM keys)
        SELECT 1 AS position, '{COMPOUND}' AS rule, 'session_id, page' AS "column", *,
               unexpected_count = 0 AS success,
               CASE WHEN unexpected_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM totals"""


def _ordered(source: str, table: str, kind: str, column: str, order: str, ties: str, broken: str) -> str:
    return f"""{source} steps AS (
            SELECT {column} AS value, lag({column}) OVER (ORDER BY {order} NULLS FIRST, {column} {ties}) AS earlier
            FROM {table} WHERE {column} IS NOT NULL),
        totals AS (
            SELECT (SELECT count(*) FROM {table}) AS element_count,
                   (SELECT count(*) - count({column}) FROM {table}) AS missing_count,
                   (SELECT count(*) FROM steps WHERE value {broken} earlier) AS unexpected_count)
        SELECT 1 AS position, '{kind}' AS rule, '{column.strip('"')}' AS "column", *, unexpected_count = 0 AS success,
               CASE WHEN unexpected_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM totals"""


def oracle_sql() -> dict[str, str]:
    columns = 'event_id, user_id, session_id, event_type, page, device, "timestamp"'
    all_bronze = f"{BRONZE_SQL} SELECT * FROM bronze"
    all_silver = f"{SILVER_SQL} SELECT * FROM silver"
    all_dau = f"{DAU_SQL} SELECT * FROM dau"
    all_sessions = f"{SESSIONS_SQL} SELECT * FROM sessions"
    latest = f'{DAU_SQL} SELECT * FROM dau ORDER BY "year" DESC, "month" DESC, "day" DESC LIMIT 5'
    top = f"{VIEWS_SQL} SELECT * FROM views ORDER BY total_views DESC, page LIMIT 5"
    engagement_sql = ENGAGEMENT_SQL.format(avg="CAST(duration_seconds AS DOUBLE)")
    engaged = SESSIONS_SQL + engagement_sql
    day_text = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in PARTITION_COLUMNS)
    skewed_sessions = SKEWED_SQL + _session_steps("bronze")
    per_session = _first_per("session_id", "bronze")
    twins = {
        "encode_events": f"""{BRONZE_SQL}
            SELECT user_id AS key,
                   '{{"event_id":"' || event_id
                   || CASE WHEN user_id IS NULL THEN '' ELSE '","user_id":"' || user_id END
                   || '","session_id":"' || session_id || '","event_type":"' || event_type
                   || '","page":"' || page || '","device":"' || device || '","timestamp":"'
                   || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') || '"}}' AS value
            FROM bronze""",
        "decode_events": f"{BRONZE_SQL} SELECT {columns} FROM bronze",
        "decode_malformed": f"""{BRONZE_SQL}, spoilt AS (
                SELECT *, CAST(event_id AS BIGINT) % 8 AS kind FROM bronze)
            SELECT CASE WHEN kind IN (2, 6, 7) THEN event_id END AS event_id,
                   CASE WHEN kind IN (2, 6, 7) THEN user_id END AS user_id,
                   CASE WHEN kind IN (2, 6, 7) THEN session_id END AS session_id,
                   CASE WHEN kind IN (2, 7) THEN event_type END AS event_type,
                   CASE WHEN kind IN (2, 6, 7) THEN page END AS page,
                   CASE WHEN kind IN (2, 6, 7) THEN device END AS device,
                   CASE WHEN kind IN (6, 7) THEN "timestamp" END AS "timestamp"
            FROM spoilt""",
        "date_parts": f'{BRONZE_SQL} SELECT event_id, "year", "month", "day" FROM bronze',
        "stream_bronze": all_bronze,
        "stream_bronze_table": all_bronze,
        "stream_silver": all_silver,
        "stream_gold_dau": all_dau,
        "dq_not_null": _single_rule(1),
        "dq_unique": _single_rule(2),
        "dq_in_set": _single_rule(3),
        "dq_report": REPORT_SQL,
        "dq_verdict": f"{CHECKS_SQL} SELECT bool_and(unexpected_count = 0) AS validation_passed"
        " FROM checks",
        "dq_silver_verdict": f"""{SILVER_SQL}
            SELECT count(*) = count(user_id) AND count(event_id) = count(DISTINCT event_id)
                   AND count(*) FILTER (WHERE NOT {IN_SET_SQL}) = 0 AS validation_passed
            FROM silver""",
        "dq_profile": f"""{CHECKS_SQL}, wide AS (
                SELECT *, CAST(element_count AS DOUBLE) AS e, missing_count * 100.0::DOUBLE AS m,
                       unexpected_count * 100.0::DOUBLE AS u,
                       CASE position WHEN 1 THEN element_count
                            ELSE element_count - missing_count END AS looked_at
                FROM checks)
            SELECT position, rule, "column", element_count, missing_count,
                   m / nullif(e, 0) AS missing_percent, unexpected_count,
                   u / nullif(looked_at, 0) AS unexpected_percent,
                   u / nullif(e, 0) AS unexpected_percent_total
            FROM wide""",
        "dq_unexpected_values": f"""{BRONZE_SQL}
            SELECT event_type AS value, count(*) AS count FROM bronze WHERE NOT {IN_SET_SQL}
            GROUP BY event_type""",
        "dq_top_duplicate_keys": f"""{BRONZE_SQL}
            SELECT event_id AS value, count(*) AS count FROM bronze WHERE event_id IS NOT NULL
            GROUP BY event_id HAVING count(*) > 1 ORDER BY count DESC, value LIMIT 20""",
        "dq_in_set_numeric": f"{NUMERIC_SQL} " + " UNION ALL ".join(
            _rule_row(i, IN_SET, f"'{c}'", f"count(*) FILTER (WHERE {c} IS NULL)", f"{c} NOT IN ({v})", source="numeric")
            for i, c, v in ((1, "whole", "2, 3, 4"), (2, "amount", "0.5, 1, 1.5"))
        ),
        "clean_in_set_numeric": f"{NUMERIC_SQL} SELECT event_id, whole, amount FROM numeric"
        " WHERE whole IN (2, 3, 4) AND amount IN (0.5, 1, 1.5)",
        **{f"dq_{name}": f"{BRONZE_SQL} {_rule_row(1, *parts)}" for name, parts in CHECK_ONLY_SQL.items()},
        "dq_compound_unique": _compound(BRONZE_SQL),
        "skewed_dq_compound_unique": _compound(SKEWED_SQL),
        "dq_increasing": _ordered(
            BRONZE_SQL + ",", "bronze", INCREASING, '"timestamp"', "event_id", "ASC", "<"
        ),
        "skewed_dq_increasing": _ordered(
            SKEWED_SQL + ",", "bronze", INCREASING, '"timestamp"', "event_id", "ASC", "<"
        ),
        "dq_decreasing": _ordered("WITH", "events", DECREASING, "user_id", "ts", "DESC", ">="),
        "dq_quantiles": "WITH q AS (SELECT quantile_disc(value, [0.1, 0.5, 0.9]) AS v, quantile_disc(ts, 0.5) AS m,"
        " quantile_cont(value, 0.5) AS e FROM events) "
        + " UNION ALL ".join(
            _rule_row(
                i,
                kind,
                f"'{c}'",
                _nulls(c),
                f"(SELECT {bad} FROM q) + 0 * count(*)",
                source="events",
            )
            for i, kind, c, bad in (
                (1, QUANTILES, "value", "if(v[1] BETWEEN 0 AND 10, 0, 1) + if(v[2] >= 50, 0, 1) + if(v[3] <= 500, 0, 1)"),
                (2, MEDIAN, "ts", "if(m BETWEEN '2024-01-10' AND '2024-01-20', 0, 1)"),
                (3, MEDIAN, "value", "if(e >= 0, 0, 1)"),
            )
        ),
        "dq_quantile_values": """
            SELECT 1 AS position, unnest([0.1, 0.5, 0.9])::DOUBLE AS quantile,
                   unnest(quantile_disc(value, [0.1, 0.5, 0.9])) AS value,
                   unnest([quantile_disc(value, 0.1) BETWEEN 0 AND 10, quantile_disc(value, 0.5) >= 50,
                           quantile_disc(value, 0.9) <= 500]) AS success FROM events
            UNION ALL
            SELECT 3, 0.5, quantile_cont(value, 0.5), quantile_cont(value, 0.5) >= 0 FROM events""",
        "dq_between_text": f"{BRONZE_SQL} "
        + " UNION ALL ".join(
            _rule_row(i, BETWEEN, f"'{c}'", _nulls(c), f"{c} IS NOT NULL AND NOT coalesce({good}, false)")
            for i, c, good in (
                (1, "user_id", "TRY_CAST(user_id AS DOUBLE) BETWEEN 100 AND 500.5"),
                (2, "session_id", "TRY_CAST(session_id AS DOUBLE) <= 1"),
                (3, "page", "page >= '/p2'"),
            )
        ),
        "dq_samples": f"""{BRONZE_SQL}
            SELECT 1 AS position, event_type AS value, count(*) AS count FROM bronze WHERE NOT {IN_SET_SQL} GROUP BY ALL
            UNION ALL SELECT 2, device, count(*) FROM bronze WHERE device IN ('tablet', 'tv') GROUP BY ALL
            UNION ALL SELECT 3, page, count(*) FROM bronze WHERE NOT regexp_matches(page, '[0-3]$') GROUP BY ALL
            UNION ALL SELECT 4, '(' || "month" || ', ' || "day" || ')', count(*) FROM bronze WHERE "month" <= "day"
                GROUP BY ALL""",
        "stream_clean": all_silver,
        "ordered_sessions": f"{SESSIONS_SQL} SELECT count(*) AS n_sessions, CAST(0 AS BIGINT) AS n_unsorted,"
        " CAST(0 AS BIGINT) AS n_overlaps FROM sessions",
        "dq_suite_file": f"""{CHECKS_SQL}, parts AS (
                {_rule_row(1, COLUMN_EXISTS, "'event_id'", "0", "false")}
                UNION ALL SELECT position + 1, rule, "column", element_count, missing_count,
                    unexpected_count, unexpected_count = 0,
                    CASE WHEN unexpected_count = 0 THEN 'PASS' ELSE 'FAIL' END FROM checks
                UNION ALL {_rule_row(5, MATCHES, "'page'", "count(*) FILTER (WHERE page IS NULL)",
                                     "NOT regexp_matches(page, '^/p[0-9]+$')", 0.99)})
            SELECT * FROM parts""",
        "silver_sample": f"{SILVER_SQL} SELECT least(10, count(*)) AS n_sampled,"
        " least(10, count(*)) AS n_found FROM silver",
        "session_sample": f"{SESSIONS_SQL} SELECT least(5, count(*)) AS n_sampled,"
        " least(5, count(*)) AS n_found FROM sessions",
        "dq_duplicate_keys": f"""{BRONZE_SQL}
            SELECT event_id AS value, count(*) AS count FROM bronze WHERE event_id IS NOT NULL
            GROUP BY event_id HAVING count(*) > 1""",
        "clean_not_null": f"{BRONZE_SQL} SELECT * FROM bronze WHERE user_id IS NOT NULL",
        "clean_unique": f"{BRONZE_SQL} {_first_per('event_id', 'bronze')}",
        "clean_in_set": f"{BRONZE_SQL} SELECT * FROM bronze WHERE {IN_SET_SQL}",
        "clean_first_event_per_session": f"{BRONZE_SQL} {per_session}",
        "silver": all_silver,
        "silver_set_before_unique": f"""{BRONZE_SQL},
            allowed AS (SELECT * FROM bronze WHERE {IN_SET_SQL})
            {_first_per("session_id", "allowed")}""",
        "silver_unique_before_set": f"""{BRONZE_SQL}, first_events AS ({per_session})
            SELECT * FROM first_events WHERE {IN_SET_SQL}""",
        "skewed_dq_report": SKEWED_SQL + REPORT_STEPS,
        "skewed_silver": f"{SKEWED_SQL}{SILVER_STEPS} SELECT * REPLACE ({day_text}) FROM silver",
        "skewed_dau": f"{SKEWED_SQL}{_dau_steps('bronze')} SELECT * REPLACE ({day_text}) FROM dau",
        "skewed_sessions": f"""{skewed_sessions}
            SELECT * REPLACE (CAST(duration_seconds AS VARCHAR) AS duration_seconds)
            FROM sessions""",
        "skewed_engagement": skewed_sessions + engagement_sql,
        "gold_dau": all_dau,
        "gold_page_views": f"{VIEWS_SQL} SELECT * FROM views",
        "gold_sessions": all_sessions,
        "latest_days": latest,
        "earliest_days": f'{DAU_SQL} SELECT * FROM dau ORDER BY "year" NULLS FIRST,'
        ' "month" NULLS FIRST, "day" NULLS FIRST LIMIT 5',
        "top_pages": top,
        "engagement": engaged,
        "engagement_sql": engaged,
        "publish_twice": all_silver,
        "publish_gold_sessions": all_sessions,
        "batch_silver": all_silver,
        "batch_latest_days": latest,
        "batch_top_pages": top,
    }
    if llm is not None:
        twins |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return twins

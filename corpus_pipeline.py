"""A corpus from raw documents to token counts: each stage takes the documents its predecessor kept,
written as Parquet and read again.

What a stage writes for itself in the shared folder is deleted when the stage after it is called by the same thread
over the same folder of tables with documents that don't read from it, as its result has been written
by then; the rest when the session ends.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import get_ident

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontaminate, quality_rules, simhash, suffix_dedup
from tidemark.llm.common import drop_folders, noted_folders, staged
from tidemark.llm.queries import VOCABULARY


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: By folder of tables and thread: the stage that ran last and the folders it left.
_left: dict[tuple[str, int], tuple[str, list[str]]] = {}


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _stage(f: Stage, after: str | None) -> Stage:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        run = (sf_dir, get_ident())
        last, left = _left.pop(run, (None, []))
        read = docs.inputFiles() if left else []
        if last == after and not any(folder in file for folder in map(_name, left) for file in read):
            drop_folders(spark, left)
        with noted_folders() as made:
            result = f(spark, docs, sf_dir)
        _left[run] = (f.__name__, made)
        return result

    return run_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id."""
    return simhash.keep_first(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that the corpus repeats; ``n_chars`` follows the
    text. A document of which nothing stays stays as an empty one."""
    cleaned = suffix_dedup.remove_repeats(docs, as_text=True)
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("text").isNotNull(), F.length("text")).cast(kind)
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return byte_bpe.encode_and_decode(
        docs.select("doc_id", "text"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _stage(quality, None)),
    ("simhash", _stage(near_duplicates, "quality")),
    ("suffix_dedup", _stage(repeats, "near_duplicates")),
    ("decontamination", _stage(contamination, "repeats")),
    ("byte_bpe", _stage(tokens, "contamination")),
]

#: Components over links, 64-bit hashes and tokens aren't for SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with noted_folders() as made:
            docs = staged(stage(spark, docs, sf_dir), name)
        drop_folders(spark, before)
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)

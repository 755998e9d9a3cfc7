"""Quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled texts. What a text
gains by the one over the other, as a share of the sizes, is near to the log-odds of its class but for
scale and offset, which a logistic calibration on other labelled texts gives.

Learning takes about ``TRAIN_ROWS`` labelled rows per class of texts of at most ``TRAIN_BYTES``,
chosen by a hash of the id at a rate that follows from the count of labelled ids, then, where ids have several
texts, by a hash of id, text and label at a rate that follows from the count of those: this much reaches the
driver, equal rows once. Half build the dictionaries, half calibrate. Learning scans the documents twice,
scoring is one scan over whole texts without a shuffle.

Defined cases: null and empty texts score like the calibration's offset, no gain either way; rows
with several labels are learned from with each, equal rows once; labels without text or id are skipped; with one class
only, every text gets that class's share; with no labels 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import releasing, small_batches
from tidemark.llm.language import remainder

TRAIN_ROWS = 1_200
TRAIN_BYTES = 1 << 16
DICTIONARY = 112 << 10
LEVEL = 3


def build_dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY:] or b"\0" * 8


class Gain:
    """The difference of the compressed sizes with the bad and with the good dictionary, as a share
    of their sum."""

    def __init__(self, good: bytes, bad: bytes):
        self.press = []
        for content in (good, bad):
            own = zstandard.ZstdCompressionDict(content)
            own.precompute_compress(level=LEVEL)
            self.press.append(
                zstandard.ZstdCompressor(dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False)
            )

    def __call__(self, text: bytes) -> float:
        if not text:
            return 0.0
        good, bad = (len(p.compress(text)) for p in self.press)
        return (bad - good) / (bad + good)


def calibrate(gains: np.ndarray, labels: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic regression by Newton's method, slightly regularised. Classes
    weigh alike, so that scores are 0.5 where good and bad texts are as likely to gain so much."""
    if len(set(labels.tolist())) < 2:
        share = labels.mean() if len(labels) else 0.5
        return 0.0, math.log((share + 1e-3) / (1 - share + 1e-3))
    x = np.stack([gains, np.ones(len(gains))], axis=1)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (weight * (labels - p)) - 1e-3 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def learn(rows: list[tuple[int, bytes, int]]) -> tuple[bytes, bytes, float, float]:
    """Dictionaries, slope and offset from rows of id, text and label. Half of each class, in the
    order of the ids' hashes, builds the dictionaries."""
    rows = sorted(rows, key=lambda r: (r[0] * 0x9E3779B97F4A7C15 % 2**64, r[1], r[2]))
    by_class = {k: [t for _, t, label in rows if label == k and t] for k in (0, 1)}
    good, bad = (build_dictionary(by_class[k][::2]) for k in (1, 0))
    gain = Gain(good, bad)
    other = [(gain(t), k) for k in (0, 1) for t in by_class[k][1::2]]
    gains, labels = np.array([g for g, _ in other]), np.array([k for _, k in other], float)
    return good, bad, *calibrate(gains, labels)


def _share(counted: DataFrame, kind: str, train_rows: int) -> Column:
    """For each class the share of the rows of ``counted`` that are about ``train_rows``."""
    rate = F.lit(0.0)
    for r in counted.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).collect():
        rate = F.when(F.col(kind) == r[kind], F.lit(min(1.0, train_rows / r["n"]))).otherwise(rate)
    return rate


def chosen(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> list[tuple[int, bytes, int]]:
    """About ``train_rows`` labelled texts of each class at most, whatever the rows of an id."""
    labels = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "quality")
    below = lambda key, rate: F.pmod(key, F.lit(1 << 30)) < rate * (1 << 30)
    rate = _share(labels.distinct(), "quality", train_rows)
    few = labels.filter(below(F.xxhash64("doc_id"), rate)).distinct()
    texts = docs.filter(F.octet_length("text") <= TRAIN_BYTES).select(F.col("doc_id").cast("long"), "text")
    own = F.xxhash64("doc_id", "text", "quality").alias("own")
    rows = texts.join(F.broadcast(few), "doc_id").select("doc_id", "text", "quality", own)
    # Numbers first: an id with many texts is thinned out before any text travels.
    rate = _share(rows.select("quality", "own").distinct(), "quality", train_rows)
    found = rows.filter(below(F.col("own"), rate)).select("doc_id", "text", "quality").distinct().collect()
    return [(r["doc_id"], r["text"].encode(), r["quality"]) for r in found]


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row; learned from the labels
    that aren't held out."""
    own = F.coalesce(remainder(F.col("doc_id"), folds) == held_out, F.lit(False))
    good, bad, slope, offset = learn(chosen(docs, labels.filter(~own), train_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = Gain(good, bad)
        for batch in small_batches(batches, "text", 1 << 22):
            texts = batch.column("text").cast(pa.binary())
            logit = [slope * gain(t.as_py() or b"") + offset for t in texts]
            score = 1 / (1 + np.exp(-np.clip(np.array(logit, float), -40, 40)))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("held_out"), "text")
    return rows.mapInArrow(releasing(run), "doc_id long, held_out boolean, score double, predicted int")

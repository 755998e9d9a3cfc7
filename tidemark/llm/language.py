"""Language identification by rank-order profiles.

A profile lists the most frequent n-grams (one to three characters of a word with its edges),
most frequent first. A text belongs to the language whose profile is nearest by out-of-place
distance: the sum over the text's profile of how far apart the ranks are, or ``PROFILE`` where the
language's profile lacks the n-gram.

Profiles are learned from about ``TRAIN_ROWS`` rows of each of the ``MOST_LANGUAGES`` languages that have most rows,
chosen by a hash of the id at a rate that follows from the rows' count; they are the only thing collected,
``PROFILE`` numbers per language, so a column with millions of different labels costs no more. Profiles are sent to
tasks as one sorted list of n-grams, so that a text is compared with all languages at once. Prediction is one scan
without a shuffle; texts of any length are counted a stretch at a time.

Defined cases: null texts and texts without a letter are ``und`` with score 0; rows without a language
or id aren't learned from; rows of languages beyond the bound get the nearest one within; ties go to the language first in the alphabet; with nothing to learn from
all rows are ``und``; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import releasing, small_batches

PROFILE = 300
TRAIN_ROWS = 2_000
#: Languages that are learned, those with most rows; equal numbers by name.
MOST_LANGUAGES = 1_000
#: Characters that are counted at once.
STRETCH = 1 << 20
UNKNOWN = "und"


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each character itself plus two if it is a letter, else one: the edge of a word."""
    table = np.arange(2, 0x110002, dtype=np.uint64)
    table[[not chr(c).isalpha() for c in range(0x110000)]] = 1
    return table


def ngrams(text: str, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers, and how often each occurs."""
    text, shift = text.lower(), np.uint64(21)
    keys, counts, held = np.empty(0, np.uint64), np.empty(0, np.int64), np.array([1], np.uint64)
    for begin in range(0, len(text) + 1, stretch):
        part = text[begin : begin + stretch].encode("utf-32-le", "replace")
        codes = np.concatenate([held, _letters()[np.frombuffer(part, np.uint32)]])
        if begin + stretch > len(text):
            codes = np.append(codes, np.uint64(1))
        codes = codes[np.append(True, (codes[1:] != 1) | (codes[:-1] != 1))]
        # The last two of the stretch before are there for what they begin, and were counted.
        new = codes[len(held) :]
        two = codes[:-1] << shift | codes[1:]
        three = (two[:-1] << shift | codes[2:])[codes[1:-1] != 1]
        if len(held) > 1:
            two = two[1:]
        found, n = np.unique(np.concatenate([new[new != 1], two, three]), return_counts=True)
        if len(keys):
            keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, n])).astype(np.int64)
        else:
            keys, counts = found, n
        held = codes[-2:]
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, ties by number."""
    return keys[np.lexsort((keys, -counts))[:most]]


class Profiles:
    """The n-grams of all languages in one sorted list, with language and rank of each."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.names = sorted(profiles)
        sizes = [len(profiles[name]) for name in self.names]
        keys = np.array([k for name in self.names for k in profiles[name]], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.language = keys[order], np.repeat(np.arange(len(sizes)), sizes)[order]
        self.rank = np.concatenate([np.arange(n) for n in sizes])[order] if sizes else keys

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The nearest language and a score, 1 for no distance, 0 for the largest."""
        own = ranked(*ngrams(text or ""))
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        begin, end = (np.searchsorted(self.keys, own, side) for side in ("left", "right"))
        n = end - begin
        at = np.repeat(begin - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(int(n.sum()))
        far = np.abs(self.rank[at] - np.repeat(np.arange(len(own)), n))
        near = np.bincount(self.language[at], weights=np.maximum(0, PROFILE - far), minlength=len(self.names))
        best = int(np.argmax(near))  # the first in the alphabet of those as near
        return self.names[best], float(near[best]) / (PROFILE * len(own))


def learn_profiles(
    rows: DataFrame, train_rows: int = TRAIN_ROWS, languages: int = MOST_LANGUAGES
) -> dict[str, list[int]]:
    """Profiles of rows of ``doc_id``, ``lang``, ``text``."""
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    most = [(r["lang"], r["n"]) for r in counted.orderBy(F.desc("n"), "lang").limit(languages).collect()]
    # ``languages`` rows at most, whatever the table; rows of other languages go here.
    rates = rows.sparkSession.createDataFrame([(k, min(1.0, train_rows / n)) for k, n in most], "lang string, rate double")
    own = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = rows.join(F.broadcast(rates), "lang").filter(own < F.col("rate") * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 22):
            found: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found.setdefault(lang, []).append(ngrams(text))
            for lang, parts in found.items():
                keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.record_batch(
                    [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "key", "n"]
                )

    grams = chosen.select("lang", "text").mapInArrow(releasing(run), "lang string, key long, n long")
    total = grams.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    top = total.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: r["rank"]):
        profiles.setdefault(r["lang"], []).append(r["key"])
    return profiles


def identify(
    docs: DataFrame, folds: int = 4, held_out: int = 2, train_rows: int = TRAIN_ROWS, languages: int = MOST_LANGUAGES
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row; learned from the rows
    that aren't held out."""
    own = F.coalesce(remainder(F.col("doc_id"), folds) == held_out, F.lit(False))
    profiles = learn_profiles(docs.filter(~own).select("doc_id", "lang", "text"), train_rows, languages)
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(sent.value)
        for batch in small_batches(batches, "text", 1 << 22):
            found = [model.nearest(t.as_py()) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("held_out"), "text")
    return rows.mapInArrow(releasing(run), "doc_id long, held_out boolean, lang_pred string, score double")

"""Sharding and the quality classifier against plain runs of the same steps, and columns with odd names."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    compression,
    decontaminate,
    html_text,
    language,
    line_dedup,
    quality_rules,
    queries,
    sharding,
    simhash,
    suffix_dedup,
    token_alignment,
    warc,
)

SF = "/root/testdata/sf0.001"


# -------------------------------------------------------------------- sharding


@pytest.mark.parametrize("slice_rows", [20_000, 13])
def test_sharding_equals_a_plain_run(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(sharding, "SLICE_ROWS", slice_rows)
    stored, real = {}, sharding.staged
    monkeypatch.setattr(sharding, "staged", lambda df, name: stored.setdefault(name, real(df, name)))
    docs = spark.range(700).selectExpr("id % 300 AS doc_id", "id AS n").repartition(6)
    got = {r["n"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(docs, 8, seed=5).collect()}
    rows = stored["rows"].select(
        "row.n", "part", "at", F.xxhash64(F.lit(5), "at").alias("first"), F.xxhash64(F.lit(6), "at").alias("second")
    ).collect()
    parts = {p: sorted([r for r in rows if r["part"] == p], key=lambda r: (r["first"], r["at"])) for p in {r["part"] for r in rows}}
    matrix = sharding.communication_matrix([len(parts[p]) for p in sorted(parts)], sharding.exact_sizes(700, 8), 5)
    shards = [[] for _ in range(8)]
    for p, sent in zip(sorted(parts), matrix, strict=True):
        begin = 0
        for k, n in enumerate(sent):
            shards[k] += parts[p][begin : begin + n]
            begin += n
    slices = max(1, math.ceil(700 / 8 / slice_rows))
    for k, own in enumerate(shards):
        own.sort(key=lambda r: (r["second"] % slices, r["second"], r["at"]))
        for slot, r in enumerate(own):
            assert got[r["n"]] == (k, slot)


def test_sizes_and_checksums_equal_zlib(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.shards(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))


# ---------------------------------------------------------- quality classifier


def plain_scores(texts, rows):
    """Scores of texts, learned from rows of id, text and label, without numpy and Newton's method."""
    rows = sorted(rows, key=lambda r: (r[0] * 0x9E3779B97F4A7C15 % 2**64, r[1], r[2]))
    packed = {}
    for label in (0, 1):
        own = [t for _, t, k in rows if k == label and t][::2]
        try:
            content = zstandard.train_dictionary(112 << 10, own, level=3).as_bytes()
        except zstandard.ZstdError:
            content = b"\n".join(own)[-(112 << 10) :]
        packed[label] = zstandard.ZstdCompressionDict(content)

    def gain(text):
        if not text:
            return 0.0
        size = {}
        for label, content in packed.items():
            press = zstandard.ZstdCompressor(level=3, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False)
            size[label] = len(press.compress(text))
        return (size[0] - size[1]) / (size[0] + size[1])

    pairs = [(gain(t), k) for label in (0, 1) for t, k in [(t, k) for _, t, k in rows if k == label and t][1::2]]
    share = sum(k for _, k in pairs) / len(pairs)
    weights = {1: 0.5 / share, 0: 0.5 / (1 - share)}

    def slope_of(a, b):
        da, db = -1e-3 * a, -1e-3 * b
        for x, k in pairs:
            p = 1 / (1 + math.exp(-(a * x + b)))
            da += weights[k] * (k - p) * x
            db += weights[k] * (k - p)
        return da, db

    # The offset that is best for a slope, by bisection, and the slope by bisection around it.
    def offset(a):
        low, high = -60.0, 60.0
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if slope_of(a, mid)[1] > 0 else (low, mid)
        return (low + high) / 2

    low, high = -3000.0, 3000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if slope_of(mid, offset(mid))[0] > 0 else (low, mid)
    a = (low + high) / 2
    b = offset(a)
    return [1 / (1 + math.exp(-(a * gain(t) + b))) for t in texts]


def test_scores_equal_a_plain_run(spark):
    rng = random.Random(11)
    good, bad = "the of and house water light".split(), "xx yy zz buy now 1234".split()
    rows = []
    for i in range(160):
        label = int(i % 4 > 0)
        words = rng.choices((good if label else bad) * 4 + good + bad, k=rng.randint(5, 50))
        rows.append((i, " ".join(words), label))
    texts = [t for _, t, _ in rows] + ["", None, "buy now", "the house " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in compression.score_quality(docs, labels).collect()}
    learned = [(i, t.encode(), k) for i, t, k in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    want = plain_scores([(t or "").encode() for t in texts], learned)
    for i, score in enumerate(want):
        assert found[i]["score"] == pytest.approx(score, abs=1e-5)
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.5)
    assert np.ptp(want) > 0.5


# ---------------------------------------------------------------- odd names


def test_names_with_dots_are_names(spark):
    docs = spark.createDataFrame(
        [(1, "some text of a document\nand a line of it", "en", "v", 4), (2, None, None, None, None), (1, "some text of a document\nand a line of it", "en", "v", 4)],
        "doc_id long, text string, lang string, `a.b` string, n_chars int",
    )
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"), "`a.b`")
    items = spark.createDataFrame([(1, "a text that no document has in it")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    spec, model = queries.public_tokenizers.path("byte_bpe_50k.json"), queries.public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = queries.public_tokenizers.path(queries.VOCABULARY)
    results = {
        "ledger": quality_rules.ledger(docs),
        "good": quality_rules.keep_good(docs),
        "bpe": byte_bpe.encode_and_decode(docs, vocabulary, queries.public_tokenizers.PATTERN),
        "simhash": simhash.near_duplicates(docs),
        "first": simhash.keep_first(docs),
        "repeats": suffix_dedup.remove_repeats(docs),
        "as text": suffix_dedup.remove_repeats(docs, as_text=True),
        "clean": decontaminate.keep_clean(docs, items),
        "items": decontaminate.contained_items(docs, items),
        "language": language.identify(docs),
        "quality": compression.score_quality(docs, labels),
        "shards": sharding.shuffle_into_shards(docs, 2),
        "lines": line_dedup.drop_repeated_lines(docs),
        "tokens": token_alignment.align(docs, spec, model),
        "html": html_text.extract(pages),
        "warc": warc.round_trip(pages),
    }
    dropped = {"simhash", "items", "language", "quality", "html", "warc"}
    for name, df in results.items():
        rows = df.collect()
        assert ("a.b" in df.columns) == (name not in dropped), name
        if name in ("as text", "clean", "shards", "lines", "tokens", "repeats", "bpe", "ledger"):
            assert sorted((r["a.b"] or "") for r in rows) == ["", "v", "v"], name

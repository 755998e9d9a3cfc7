"""Benchmark decontamination by size-partitioned MinHash containment search.

An item of m word shingles is contained in a document that has a given share t of them. Whichever
the others are, such a document has one of any (1 - t) m + 1 of the item's shingles; the item's
signature are those of the smallest hashes. Items are partitioned by size, and the largest size
of a partition says how many hashes its signatures have. A document, however long, is probed with
all its shingles, so a hit can't be missed; hits are verified by exact containment of shingles.

Documents are scanned once per block of items and never shuffled. Equal items are counted first and travel
once; their pairs are repeated where they are found. A block has about ``BLOCK_BYTES`` of item text at most: only
this much is sent to tasks at a time, more items take more scans.

Words are runs of characters other than the six ASCII white space ones, A-Z lower-cased.

Defined cases: an item of fewer words than a shingle is one shingle of all its words; items
without words and null texts match nothing; repeated items and documents match one by one; an
empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.llm.common import releasing, small_batches, staged
from tidemark.llm.pfp import Block, mixed

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_BYTES = 16 << 20
BATCH = 1 << 20
#: Pairs of repeated items that are passed on at once.
ROWS = 1 << 16
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, width: int) -> set[bytes]:
    words = text.lower().split()
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, widths: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each width, hashes of all shingles of the texts and the text of each."""
    block = Block(_LOWER[data], offsets, 0)
    word = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(word & (edge[:-1] | ~np.append(False, word[:-1])))
    end = np.flatnonzero(word & (edge[1:] | ~np.append(word[1:], False))) + 1
    hashes, texts = block.hashes(start, end), block.text_of(start)
    found = {}
    for width in widths:
        n = max(0, len(start) - width + 1)
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total = total * _STEP + hashes[k : n + k]
        whole = texts[:n] == texts[width - 1 :][:n]
        found[width] = mixed(total)[whole], texts[:n][whole]
    return found


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def _distinct(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and their texts, ordered by text, then hash, each pair once."""
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    return hashes[new], texts[new]


class Index:
    """Signatures of a block of items by shingle width."""

    def __init__(self, items: list[bytes], threshold: float, width: int):
        self.items, self.threshold = items, threshold
        self.width = [min(width, len(t.lower().split())) for t in items]
        groups = defaultdict(list)
        for i, w in enumerate(self.width):
            if w:
                groups[w].append(i)
        self.tables = {}
        for w, members in groups.items():
            hashes, texts = shingle_hashes(*_flat([items[i] for i in members]), [w])[w]
            hashes, texts = _distinct(hashes, texts)
            ends = np.searchsorted(texts, np.arange(len(members) + 1))
            keys, who = [], []
            for i, begin, end in zip(members, ends[:-1], ends[1:], strict=True):
                h = hashes[begin:end]
                partition_top = 1 << len(h).bit_length()  # sizes of a partition: below this
                signature = h[: int((1 - threshold) * partition_top + 1e-9) + 1]
                keys.append(signature)
                who.append(np.full(len(signature), i))
            keys, who = np.concatenate(keys), np.concatenate(who)
            order = np.argsort(keys, kind="stable")
            sieve = np.zeros(1 << 16, bool)
            sieve[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.tables[w] = keys[order], who[order], sieve

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """Pairs of a text and an item that share a hash of the item's signature."""
        found = set()
        for w, (hashes, texts) in shingle_hashes(data, offsets, [*self.tables]).items():
            keys, who, sieve = self.tables[w]
            maybe = np.flatnonzero(sieve[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            low = np.searchsorted(keys, hashes[maybe], "left")
            high = np.searchsorted(keys, hashes[maybe], "right")
            some = high > low
            # A shingle that a text repeats is looked up once.
            for t, begin, end in {*zip(texts[maybe][some].tolist(), low[some].tolist(), high[some].tolist(), strict=True)}:
                found.update((t, i) for i in who[begin:end].tolist())
        return found

    def shared(self, text: bytes, item: int, seen: dict[int, set[bytes]]) -> tuple[int, int]:
        """Distinct shingles of the item, in the text and in all."""
        w = self.width[item]
        if w not in seen:
            seen[w] = shingles(text, w)
        own = shingles(self.items[item], w)
        return len(own & seen[w]), len(own)


def _found(batch: pa.RecordBatch, index: Index) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, shared shingles and the item's shingles of each verified hit."""
    texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
    by_text = defaultdict(list)
    for t, i in index.hits(*_flat(texts)):
        by_text[t].append(i)
    for t, items in sorted(by_text.items()):
        seen: dict[int, set[bytes]] = {}
        for i in sorted(items):
            n, of = index.shared(texts[t], i, seen)
            if n >= index.threshold * of - 1e-9:
                yield t, i, n, of


def _blocks(items: DataFrame) -> Iterator[tuple[list[tuple], bool]]:
    """Ids, texts and numbers of equal rows of the items, a block of distinct rows at a time, and whether
    it is the only one."""
    texts = items.filter("text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    texts = texts.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("n"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    if blocks > 1:
        texts = staged(texts, "items")
    for k in range(blocks):
        block = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [tuple(r) for r in block.collect()], blocks == 1


def _repeated(rows: list[tuple], counts: list[int]) -> Iterator[pa.RecordBatch]:
    """The rows, each as often as its count says, ``ROWS`` at a time."""
    columns = [pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True)) or [[]] * 4]
    ends = np.cumsum(counts, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, max(1, total), ROWS):
        at = pa.array(np.searchsorted(ends, np.arange(begin, min(begin + ROWS, total)), "right"))
        yield pa.record_batch([c.take(at) for c in columns], names=["doc_id", "item_id", "n_shared", "n_item"])


def _matches(rows: DataFrame, items: list[tuple], threshold: float, width: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = [i for i, *_ in sent.value], [n for *_, n in sent.value]
        index = Index([t.encode() for _, t, _ in sent.value], threshold, width)
        for batch in small_batches(batches, "text", BATCH):
            doc_ids = batch.column("doc_id")
            hits = [*_found(batch, index)]
            out = [(doc_ids[t].as_py(), ids[i], n, of) for t, i, n, of in hits]
            yield from _repeated(out, [counts[i] for _, i, *_ in hits])

    found = rows.mapInArrow(releasing(run), "doc_id long, item_id long, n_shared long, n_item long")
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    width: int = SHINGLE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared``, ``n_item`` (distinct shingles) and ``containment`` for
    each pair with at least the given containment."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = []
    for block, only in _blocks(items):
        own = _matches(rows, block, threshold, width)
        found.append(own if only else staged(own, "matches"))
    return reduce(DataFrame.union, found)


def keep_clean(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = SHINGLE, text: str = "text"
) -> DataFrame:
    """The documents that contain no item, with all columns; rows are judged where they are."""
    whole = F.struct(*map(named, docs.columns)).alias("row")
    rows = docs.select(whole, F.col(text).alias("text"))
    for block, only in _blocks(items):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        rows = rows.mapInArrow(releasing(_cleaner(sent, threshold, width)), rows.schema)
        rows = rows if only else staged(rows, "clean")
    return rows.select("row.*")


def _cleaner(sent: Broadcast, threshold: float, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index([t.encode() for _, t, _ in sent.value], threshold, width)
        for batch in small_batches(batches, "text", BATCH):
            clean = np.ones(batch.num_rows, bool)
            clean[[t for t, *_ in _found(batch, index)]] = False
            yield batch.filter(pa.array(clean))

    return run

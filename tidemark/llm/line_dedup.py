"""Lines that several documents share, kept in one of them: two Bloom filters, then an exact check.

1. Tasks hash the keys of lines, each once per document, and send them in packed runs to the part of the hash
   space they belong to, each hash once per run however many documents of it have the line.
2. Per part, two filters see the runs go by: hashes that the once-seen one has already go into the twice-seen one.
   Both have a fixed size, so a line that a third of all documents have takes no more memory than any other. At
   the end the twice-seen filter is folded in halves while it is sparse.
3. Lines that the twice-seen filters know are suspected. Where these are small (``SHIPPED``), tasks get them all
   and only documents with such lines are written and travel; else hashes go to the filters by part.
4. Of suspected lines the SHA-256 of the key and the document travel: documents are counted exactly, and all but
   the largest id lose the line. Counts are combined before each shuffle, and the answers to a line are salted.

Defined cases: null and empty texts are one empty line; lines of any length are one key each, and a
task holds a text as a whole, some five times its bytes; documents are told apart by id, so rows that repeat an id
count once, and all rows of the largest id keep the line; a null id is smaller than all others; an
empty table gives an empty result; columns of the output's names are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named
from tidemark.llm.common import power_of_two, releasing, small_batches, staged

BLANKS = b" \t\n\x0b\x0c\r"
#: Text per part of the hash space, and the least number of parts.
PART_BYTES, LEAST_PARTS = 256 << 20, 16
#: Hashes that a task holds before it sends them.
RUN = 1 << 22
#: Bytes of filters up to which every task gets them.
SHIPPED = 64 << 20
PROBES = 4
GROUP = 1 << 22
SALTS = 16
OUTPUT = ("n_lines", "n_dropped", "kept")


# ---------------------------------------------------------------- keys of lines


def keys_of(text: bytes, least_chars: int) -> Iterator[tuple[int, bytes]]:
    """Number and key of each line that is long enough to count."""
    for i, line in enumerate(text.lower().split(b"\n")):  # of bytes: A to Z only
        key = line.strip(BLANKS)
        if len(key) >= least_chars:
            long_enough = len(key) >= 4 * least_chars or key.isascii()
            if long_enough or len(key.decode(errors="replace")) >= least_chars:
                yield i, key


def hashes_of(text: bytes, least_chars: int) -> np.ndarray:
    found = {xxhash.xxh3_64_intdigest(key) for _, key in keys_of(text, least_chars)}
    return np.fromiter(found, np.uint64, len(found))


def texts_in(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text").cast(pa.binary()):
        yield text.as_py() or b""


# -------------------------------------------------------------------- filters


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def places(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of each hash, before they are cut to a filter's size."""
    first = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
    step = (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    for i in range(PROBES):
        yield first + np.uint64(i) * step


class Bloom:
    """A filter of a power of two bits."""

    def __init__(self, bits: int):
        self.bytes, self.mask = np.zeros(bits // 8, np.uint8), np.uint64(bits - 1)

    def add(self, hashes: np.ndarray) -> None:
        for at in places(hashes):
            at &= self.mask
            np.bitwise_or.at(self.bytes, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in places(hashes):
            at &= self.mask
            found &= (self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    def folded(self) -> bytes:
        """The smallest filter that knows the same hashes and has at most a quarter of its bits set."""
        own = self.bytes
        while len(own) > 8 and int(np.bitwise_count(own).sum()) <= len(own):
            own = own[: len(own) // 2] | own[len(own) // 2 :]
        return own.tobytes()


class Filters:
    """The twice-seen filters of all parts, side by side."""

    def __init__(self, parts: int, rows: list[tuple[int, bytes]]):
        self.parts = parts
        self.begin, self.mask = np.zeros(parts, np.uint64), np.zeros(parts, np.uint64)
        pieces, n = [b"\0"], 1
        for part, own in rows:
            self.begin[part], self.mask[part] = 8 * n, 8 * len(own) - 1
            pieces.append(own)
            n += len(own)
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        part = part_of(hashes, self.parts)
        found = np.ones(len(hashes), bool)
        for at in places(hashes):
            at = (at & self.mask[part]) + self.begin[part]
            found &= (self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


# ------------------------------------------------------------------- the steps


def _runs(rows: DataFrame, parts: int, least_chars: int) -> DataFrame:
    """Per part, the distinct hashes of many documents and those that at least two of them have."""

    def packed(found: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(found), return_counts=True)
        ends = np.searchsorted(part_of(hashes, parts), np.arange(parts), "right")
        begins = np.concatenate([[0], ends[:-1]])
        full = np.flatnonzero(ends > begins)
        once = [hashes[begins[p] : ends[p]].tobytes() for p in full]
        twice = [hashes[begins[p] : ends[p]][counts[begins[p] : ends[p]] > 1].tobytes() for p in full]
        columns = [pa.array(full, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())]
        return pa.record_batch(columns, names=["part", "once", "twice"])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in small_batches(batches, "text", GROUP):
            for text in texts_in(batch):
                hashes = hashes_of(text, least_chars)
                found.append(hashes)
                n += len(hashes)
            if n >= RUN:
                yield packed(found)
                found, n = [], 0
        if n:
            yield packed(found)

    return rows.select("text").mapInArrow(run, "part long, once binary, twice binary")


def _filters(runs: DataFrame, bits: int) -> DataFrame:
    """The twice-seen filter of every part that has one."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, once, twice = None, None, None

        def result() -> Iterator[pa.RecordBatch]:
            if part is not None and twice.bytes.any():
                yield pa.record_batch([pa.array([part]), pa.array([twice.folded()])], names=["part", "bits"])

        for batch in batches:
            for i in range(batch.num_rows):
                if (own := batch.column("part")[i].as_py()) != part:
                    yield from result()
                    part, once, twice = own, Bloom(bits), Bloom(bits)
                hashes = np.frombuffer(batch.column("once")[i].as_buffer(), np.uint64)
                seen = once.has(hashes)
                twice.add(hashes[seen])
                twice.add(np.frombuffer(batch.column("twice")[i].as_buffer(), np.uint64))
                once.add(hashes[~seen])
        yield from result()

    dealt = runs.repartition("part").sortWithinPartitions("part")
    return staged(dealt.mapInArrow(run, "part long, bits binary"), "filters")


def _suspected(rows: DataFrame, filters: Filters, least_chars: int, wanted: bool) -> DataFrame:
    """Rows with suspected lines (or without), and the digests of those."""
    shipped = rows.sparkSession.sparkContext.broadcast(filters)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", GROUP):
            found = []
            for text in texts_in(batch):
                keys = list({key for _, key in keys_of(text, least_chars)})
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                which = np.flatnonzero(shipped.value.has(hashes))
                found.append([hashlib.sha256(keys[k]).digest() for k in which] if wanted else which.size)
            mask = pa.array([bool(f) == wanted for f in found], pa.bool_())
            if wanted:
                batch = batch.append_column("suspects", pa.array(found, pa.list_(pa.binary())))
            yield batch.filter(mask)

    schema = T.StructType(list(rows.schema))
    return rows.mapInArrow(run, schema.add("suspects", T.ArrayType(T.BinaryType())) if wanted else schema)


def _suspected_by_part(rows: DataFrame, filters: DataFrame, parts: int, least_chars: int) -> DataFrame:
    """Suspected lines where the filters are too large for every task: hashes travel to their part's filter."""

    @releasing
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", GROUP):
            for row, text in enumerate(texts_in(batch)):
                keys = list({key for _, key in keys_of(text, least_chars)})
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                take = pa.array([row] * len(keys), pa.int64())
                columns = [batch.column(c).take(take) for c in ("id", "text_key")]
                columns += [pa.array(part_of(hashes, parts)), pa.array(hashes.astype(np.int64))]
                columns.append(pa.array([hashlib.sha256(k).digest() for k in keys], pa.binary()))
                yield pa.record_batch(columns, names=["id", "text_key", "part", "hash", "digest"])

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_key long, part long, hash long, digest binary"
    sent = rows.select("id", "text_key", "text").mapInArrow(lines, schema)

    @releasing
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = None, None
        for batch in batches:
            names = ["id", "text_key", "digest"]
            numbers, bits = batch.column("part").to_numpy(), batch.column("bits")
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                if end > begin and numbers[begin] != part:
                    part, known = numbers[begin], None
                filters_here = pc.drop_null(bits.slice(begin, end - begin))
                for own in filters_here:  # salts repeat a part's filter
                    known = Bloom(8 * len(own.as_py()))
                    known.bytes = np.frombuffer(own.as_py(), np.uint8)
                if known is None:
                    continue
                rest = batch.slice(begin + len(filters_here), end - begin - len(filters_here))
                hashes = rest.column("hash").to_numpy().astype(np.uint64)
                yield rest.filter(pa.array(known.has(hashes))).select(names)

    salt = F.pmod("text_key", F.lit(SALTS)).cast("int")
    own = filters.select("part", "bits", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    both = sent.withColumn("salt", salt).unionByName(own, allowMissingColumns=True)
    dealt = both.repartition("part", "salt").sortWithinPartitions("part", F.col("bits").isNull())
    return dealt.mapInArrow(check, f"id {kind}, text_key long, digest binary")


def _losing(pairs: DataFrame, least_docs: int) -> DataFrame:
    """Of suspected lines and documents, those that must go: per row of the table, a set of digests."""
    counted = pairs.groupBy("digest", "id").agg(F.lit(1).alias("one")).groupBy("digest")
    repeated = counted.agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
    repeated = repeated.filter(F.col("n_docs") >= least_docs)
    salts = F.array(*[F.lit(i) for i in range(SALTS)])
    repeated = repeated.select("digest", "keeper", F.explode(salts).alias("salt"))
    salted = pairs.withColumn("salt", F.pmod("text_key", F.lit(SALTS)).cast("int"))
    lost = salted.join(repeated, ["digest", "salt"]).filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy(F.col("id").alias("lost_id"), F.col("text_key").alias("lost_key")).agg(
        F.collect_set("digest").alias("lost")
    )


def _rewritten(rows: DataFrame, others: list[str], least_chars: int) -> DataFrame:
    """Rows with what is left of their text; ``lost`` has the digests of the lines that go."""
    has_lost = "lost" in rows.columns

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", GROUP):
            n_lines, n_dropped, kept = [], [], []
            lost_of = batch.column("lost").to_pylist() if has_lost else [None] * batch.num_rows
            for text, lost in zip(texts_in(batch), lost_of, strict=True):
                lines, gone = text.split(b"\n"), set()
                if lost:
                    lost = set(lost)
                    gone = {i for i, key in keys_of(text, least_chars) if hashlib.sha256(key).digest() in lost}
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
                kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
            own = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.record_batch([*[batch.column(c) for c in others], *own], names=[*others, *OUTPUT])

    schema = T.StructType([rows.schema[c] for c in others])
    return rows.mapInArrow(run, schema.add("n_lines", "long").add("n_dropped", "long").add("kept", "string"))


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    least_chars: int = 20,
    least_docs: int = 3,
    shipped: int = SHIPPED,
) -> DataFrame:
    """``docs`` with ``n_lines`` of the whole text, ``n_dropped`` of them and ``kept``, the text without those.

    A line's key is the line without blanks at both ends, A to Z in lower case. A key of at least ``least_chars``
    characters found in at least ``least_docs`` documents loses its lines except in the largest id.
    ``shipped`` bounds what is broadcast.
    """
    if least_docs < 2:
        raise ValueError("least_docs must be two or more: a line of one document isn't repeated")
    others = [c for c in docs.columns if c.lower() not in OUTPUT]
    given = {f"c{i}": c for i, c in enumerate(others)}  # own names can't clash with extra columns
    rows = docs.select(
        *[named(c).alias(n) for n, c in given.items()],
        named(doc_id).alias("id"),
        named(text).cast("string").alias("text"),
        F.xxhash64(named(text).cast("string")).alias("text_key"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-total // PART_BYTES))
    bits = 1 << max(10, power_of_two(10 * total / parts / least_chars))
    filters = _filters(_runs(rows, parts, least_chars), bits)
    size = filters.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    done = None
    if size <= shipped:
        known = Filters(parts, [(r["part"], bytes(r["bits"])) for r in filters.collect()])
        rows_left = staged(_suspected(rows, known, least_chars, True), "suspected")
        done = _rewritten(_suspected(rows, known, least_chars, False), list(given), least_chars)
        pairs = rows_left.select("id", "text_key", F.explode("suspects").alias("digest"))
    else:
        rows_left = rows
        pairs = staged(_suspected_by_part(rows, filters, parts, least_chars), "pairs")
    lost = _losing(pairs, least_docs)
    same = F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("text_key") == F.col("lost_key"))
    joined = rows_left.join(lost, same, "left").select(*given, "text", "lost")
    result = _rewritten(joined, list(given), least_chars)
    if done is not None:
        result = result.unionByName(done)
    return result.select(*[F.col(n).alias(c) for n, c in given.items()], *OUTPUT)

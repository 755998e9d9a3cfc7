"""Alignment of two tokenizers over a corpus, and how often each pair of tokens overlaps in all of it.

Tokens of a byte-level BPE (A) and of a sentence-piece model with byte fallback (B) become byte ranges of the same
text. Byte offsets at which both end cut them into groups; a link joins two tokens whose ranges overlap.

External counting: a link's record is its pair of ids and its document, in one number with the B id first.

1. Tasks encode texts, sort the records of many documents and write them as runs, zstd frames, one run per
   radix: the B id decides which of ``RADIXES``, a number that need not grow, as the vocabularies bound the pairs.
2. Runs are merged per radix by a heap of their frames, first those of one salt, then the results: sums per pair in
   order of the B id. So all pairs of a B id come together, and their maximum is known when the id ends.
3. Counts meet the runs of their radix, salt by salt: each record gets its pair's count, what documents have of
   these is summed and returns to them.

The number of salts follows the size of the runs, so no task gets more than its share of a pair that all
documents have; a run names a pair once. Texts are split at single spaces between other characters, where both
tokenizers end a token whatever comes before and after; each distinct piece is encoded and aligned once
while it is remembered. Long texts are encoded a stretch at a time.

Defined cases: null and empty texts, and texts that the tokens of either tokenizer don't give back, have no
tokens: zeros and empty groups; rows are documents, repeated ones count as often as they come; an empty table gives
an empty result; columns of the output's names are replaced. A stretch without such spaces is held as a whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.functions import named
from tidemark.llm.byte_bpe import byte_characters
from tidemark.llm.common import releasing, small_batches, staged

RADIXES = 64
#: Links of a run over all radixes, and records of a frame.
RUN, FRAME = 1 << 21, 1 << 16
#: Bytes of text that are encoded at once, and of pieces that a worker remembers.
GROUP, REMEMBERED = 1 << 20, 128 << 20
#: Bytes of runs that a task merges at once, and of runs per radix and salt.
MERGED, SALTED = 32 << 20, 128 << 20
CUT = re.compile(r"(?<=\S) (?=\S)")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
OUTPUT = (*COUNTS, "n_best", "count_sum", "groups", "groups_sha256")


# ------------------------------------------------------------------ tokens


class Aligner:
    """Aligned pieces of text, each distinct one once while it is remembered."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        back = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(back.get(c, 0) for c in token)
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces
        ]
        if any("▁" in p.lstrip("▁") for _, p in pieces):
            raise ValueError("tokens of the piece model may run on after a space: texts can't be split there")
        bits = [(len(table) - 1).bit_length() for table in (self.bytes_a, self.bytes_b)]
        self.row_bits, self.shift_b = min(32, 64 - sum(bits)), bits[0]
        if self.row_bits < 16:
            raise ValueError("the vocabularies are too large for records of 64 bits")
        self.sizes = [np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b)]
        self.digits = [_digits(len(table)) for table in (self.bytes_a, self.bytes_b)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.counts = np.zeros((1024, len(COUNTS)), np.int64)
        self.good, self.groups, self.links, self.held = [], [], [], 0

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode and align pieces that aren't known; each has a space before it."""
        new = [p for p in set(pieces) if p not in self.known]
        if not new:
            return
        a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in new], add_special_tokens=False)]
        b = self.b.encode(new, num_threads=1)
        wanted = [(" " + p).encode() for p in new]
        sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
        good = self.given_back(a, b, wanted, sizes)
        if not good.all():
            none: list[int] = []
            a, b = ([x if g else none for x, g in zip(ids, good, strict=True)] for ids in (a, b))
        counts, groups, links = self.aligned(a, b, np.where(good, sizes, 0))
        n = len(self.known)
        while n + len(new) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.counts[n : n + len(new)] = counts
        self.known.update(zip(new, range(n, n + len(new)), strict=True))
        self.good += good.tolist()
        self.groups += groups
        self.links += links
        self.held += 300 * len(new) + 4 * int(sizes.sum()) + sum(map(len, groups)) + sum(map(len, links))

    def given_back(self, a: list[list[int]], b: list[list[int]], wanted: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Whether the tokens of both sides are the piece, byte for byte."""
        good, every = np.ones(len(wanted), bool), b"".join(wanted)
        for ids, table in ((a, self.bytes_a), (b, self.bytes_b)):
            tokens = [b"".join(map(table.__getitem__, x)) for x in ids]
            if b"".join(tokens) != every or (np.fromiter(map(len, tokens), np.int64, len(tokens)) != sizes).any():
                good &= np.fromiter((x == y for x, y in zip(tokens, wanted, strict=True)), bool, len(tokens))
        return good

    def aligned(self, a: list[list[int]], b: list[list[int]], sizes: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """Counts, groups and links of pieces, given the ids and the bytes of each."""
        n = [np.fromiter(map(len, side), np.int64, len(side)) for side in (a, b)]
        ids = [np.fromiter(chain.from_iterable(side), np.int64, int(k.sum())) for side, k in zip((a, b), n, strict=True)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids, strict=True)]
        bounds = np.sort(np.concatenate(ends), kind="stable")
        bounds = bounds[np.diff(bounds, prepend=-1) > 0]
        at = [np.searchsorted(e, bounds) for e in ends]
        piece_ends = np.cumsum(sizes)
        piece = np.searchsorted(piece_ends, bounds)
        both = (ends[0][at[0]] == bounds) & (ends[1][at[1]] == bounds) if len(bounds) else np.zeros(0, bool)
        common = bounds[both]
        counts = np.stack(
            [
                *n,
                np.bincount(piece[both], minlength=len(a)),
                np.bincount(piece, minlength=len(a)),
            ],
            axis=1,
        )
        pairs = (ids[1][at[1]].astype(np.uint64) << np.uint64(self.shift_b)) | ids[0][at[0]].astype(np.uint64)
        text = (pairs << np.uint64(self.row_bits)).tobytes()
        cuts = (8 * np.concatenate([[0], np.cumsum(counts[:, 3])])).tolist()
        links = [text[i:j] for i, j in pairwise(cuts)]
        return counts, self._written(ids, ends, common, counts), links

    def _written(self, ids: list[np.ndarray], ends: list[np.ndarray], common: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The groups of each piece as text: a row of digits and a sign for each token, in order."""
        group = [np.searchsorted(common, e) for e in ends]
        until = [np.searchsorted(e, common, "right") for e in ends]
        before = np.concatenate([[0], until[1]])
        place = [np.arange(len(ids[0])) + before[group[0]], np.arange(len(ids[1])) + until[0][group[1]]]
        width = max(d.shape[1] for d in self.digits) + 1
        rows = np.zeros((len(ids[0]) + len(ids[1]), width), np.uint8)
        for side, last in ((0, b"|"), (1, b";")):
            digits = self.digits[side][ids[side]]
            rows[place[side], : digits.shape[1]] = digits
            ends_group = common[group[side]] == ends[side]
            rows[place[side], -1] = np.where(ends_group, last[0], b","[0])
        n = counts[:, 0] + counts[:, 1]
        last_rows = (np.cumsum(n) - 1)[n > 0]
        rows[last_rows, -1] = 0
        used = np.concatenate([[0], np.cumsum(np.count_nonzero(rows, axis=1))])
        text = rows[rows != 0].tobytes()
        ends_of = used[np.cumsum(n)]
        begins = np.concatenate([[0], ends_of[:-1]])
        return [text[i:j] for i, j in zip(begins.tolist(), ends_of.tolist(), strict=True)]


def _digits(n: int) -> np.ndarray:
    """The decimal digits of 0 to n - 1 as characters, zero bytes after them."""
    text = np.arange(n).astype(f"S{len(str(n - 1))}")
    return np.frombuffer(text.tobytes(), np.uint8).reshape(n, -1)


@lru_cache(maxsize=2)
def _aligner(spec: str, model: bytes) -> Aligner:
    return Aligner(spec, model)


def stretches(text: str, most: int = GROUP) -> Iterator[str]:
    """A text cut at some of the spaces where pieces begin, without these spaces."""
    begin = 0
    while len(text) - begin > most and (cut := CUT.search(text, begin + most)):
        yield text[begin : cut.start()]
        begin = cut.start() + 1
    yield text[begin:]


class Document:
    """What is known of a document while its stretches are aligned."""

    def __init__(self, wants_groups: bool):
        self.good, self.counts, self.hash, self.any = True, np.zeros(len(COUNTS), np.int64), hashlib.sha256(), False
        self.links: list[bytes] = []
        self.groups: list[bytes] | None = [] if wants_groups else None

    def add(self, aligner: Aligner, pieces: list[str]) -> None:
        ids = [aligner.known[p] for p in pieces]
        self.good = self.good and all(map(aligner.good.__getitem__, ids))
        if not self.good:
            return
        self.counts += aligner.counts[ids].sum(axis=0)
        text = b";".join(map(aligner.groups.__getitem__, ids))
        self.hash.update(b";" + text if self.any else text)
        self.any = True
        self.links.append(b"".join(map(aligner.links.__getitem__, ids)))
        if self.groups is not None:
            self.groups.append(text)

    def result(self) -> tuple[np.ndarray, np.ndarray, str, str]:
        """Counts, links, digest and text of the groups."""
        if not self.good or not self.any:
            return np.zeros(len(COUNTS), np.int64), np.zeros(0, np.uint64), "", ""
        text = b";".join(self.groups).decode() if self.groups is not None else ""
        return self.counts, np.frombuffer(b"".join(self.links), np.uint64), self.hash.hexdigest(), text


# -------------------------------------------------------------------- runs


def pack(*columns: np.ndarray) -> bytes:
    """Frames of sorted numbers, the differences of the first column, and numbers that go with them."""
    out = []
    for i in range(0, len(columns[0]), FRAME):
        first, *rest = (c[i : i + FRAME].astype(np.uint64) for c in columns)
        frame = zstandard.compress(b"".join([np.diff(first, prepend=np.uint64(0)).tobytes(), *[c.tobytes() for c in rest]]), 1)
        out += [struct.pack("<II", len(frame), len(first)), frame]
    return b"".join(out)


def frames(run: bytes) -> Iterator[np.ndarray]:
    """The columns of each frame of a run."""
    at = 0
    while at < len(run):
        size, n = struct.unpack_from("<II", run, at)
        columns = np.frombuffer(zstandard.decompress(run[at + 8 : at + 8 + size]), np.uint64).reshape(-1, n).copy()
        columns[0] = np.cumsum(columns[0])
        yield columns
        at += 8 + size


def summed(keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Sorted keys, each once, and the sum of its numbers."""
    if not len(keys):
        return np.zeros((2, 0), np.uint64)
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return np.stack([keys[begins], np.add.reduceat(numbers, begins)])


def pairs_of(run: bytes, row_bits: int) -> Iterator[np.ndarray]:
    """The frames of a run of records without their documents: pairs and counts."""
    for words, numbers in frames(run):
        yield summed(words >> np.uint64(row_bits), numbers)


def merged(runs: list[Iterator[np.ndarray]]) -> Iterator[np.ndarray]:
    """Pairs in order with their sums over all runs. A heap has the last pair of each run's frame: up to the
    smallest of these, all that there is has been read."""
    heap, held = [], {}

    def read(i: int) -> None:
        for frame in runs[i]:
            if frame.shape[1]:
                held[i] = frame
                heapq.heappush(heap, (int(frame[0, -1]), i))
                return
        held.pop(i, None)

    for i in range(len(runs)):
        read(i)
    while heap:
        most, taken = heap[0][0], []
        for i, frame in held.items():
            if n := int(np.searchsorted(frame[0], np.uint64(most), "right")):
                taken.append(frame[:, :n])
                held[i] = frame[:, n:]
        while heap and heap[0][0] == most:
            read(heapq.heappop(heap)[1])
        every = np.concatenate(taken, axis=1)
        order = np.argsort(every[0], kind="stable")
        yield summed(every[0][order], every[1][order])


def with_best(sums: Iterable[np.ndarray], shift_b: int) -> Iterator[np.ndarray]:
    """Pairs, counts and whether the count is the highest of the B id; an id is kept back until it ends."""
    rest = np.zeros((2, 0), np.uint64)
    for part in sums:
        every = np.concatenate([rest, part], axis=1)
        b = every[0] >> np.uint64(shift_b)
        n = int(np.searchsorted(b, b[-1]))
        rest = every[:, n:]
        if n:
            yield _best(every[:, :n], shift_b)
    if rest.shape[1]:
        yield _best(rest, shift_b)


def _best(part: np.ndarray, shift_b: int) -> np.ndarray:
    b = part[0] >> np.uint64(shift_b)
    begins = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    most = np.repeat(np.maximum.reduceat(part[1], begins), np.diff(np.append(begins, len(b))))
    return np.stack([part[0], part[1], (part[1] == most).astype(np.uint64)])


# ------------------------------------------------------------------- steps


def _encoded(rows: DataFrame, others: list[str], spec: str, model: bytes, wants_groups: bool) -> DataFrame:
    """Two kinds of rows: documents with what is counted in each, and runs of records."""
    shipped = rows.sparkSession.sparkContext.broadcast((spec, model))
    schema = T.StructType([T.StructField(rows.schema[c].name, rows.schema[c].dataType) for c in others])
    for name in ("block", "row", *COUNTS):
        schema.add(name, "long")
    schema.add("groups_sha256", "string").add("groups", "string").add("radix", "integer").add("run", "binary")

    def empty(n: int, name: str) -> pa.Array:
        return pa.nulls(n, kinds[name])

    kinds: dict[str, pa.DataType] = {}

    def table(n: int, columns: dict) -> pa.RecordBatch:
        names = schema.names
        return pa.record_batch([columns[c] if c in columns else empty(n, c) for c in names], names=names)

    def sorted_runs(found: list[np.ndarray], block: int, aligner: Aligner) -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(found), return_counts=True)
        b = words >> np.uint64(aligner.shift_b + aligner.row_bits)
        radix = (b * np.uint64(0x9E3779B1) >> np.uint64(16)) % np.uint64(RADIXES)
        order = np.argsort(radix, kind="stable")
        cuts = np.searchsorted(radix[order], np.arange(RADIXES + 1))
        full = [r for r in range(RADIXES) if cuts[r] < cuts[r + 1]]
        runs = [pack(words[order[cuts[r] : cuts[r + 1]]], counts[order[cuts[r] : cuts[r + 1]]]) for r in full]
        columns = {"block": pa.array([block] * len(full), pa.int64()), "radix": pa.array(full, pa.int32()), "run": pa.array(runs, pa.binary())}
        return table(len(full), columns)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shipped.value)
        block, row, found, n_links = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in small_batches(batches, "text", GROUP):
            if not kinds:
                kinds.update({f.name: f.type for f in batch.schema}, **dict.fromkeys(("block", "row", *COUNTS), pa.int64()))
                kinds.update(groups_sha256=pa.string(), groups=pa.string(), radix=pa.int32(), run=pa.binary())
            if aligner.held > REMEMBERED:
                aligner.forget()
            documents = _documents(aligner, [t.as_py() for t in batch.column("text")], wants_groups)
            results = [d.result() for d in documents]
            columns = {c: batch.column(c) for c in others}
            columns["block"] = pa.array([block] * len(results), pa.int64())
            columns["row"] = pa.array(range(row, row + len(results)), pa.int64())
            for i, name in enumerate(COUNTS):
                columns[name] = pa.array([int(r[0][i]) for r in results], pa.int64())
            columns["groups_sha256"] = pa.array([r[2] for r in results], pa.string())
            if wants_groups:
                columns["groups"] = pa.array([r[3] for r in results], pa.string())
            yield table(len(results), columns)
            for i, result in enumerate(results):
                if len(result[1]):
                    found.append(result[1] | np.uint64(row + i))
                    n_links += len(result[1])
            row += len(results)
            if n_links >= RUN or row >= 1 << (aligner.row_bits - 1):
                if found:
                    yield sorted_runs(found, block, aligner)
                block, row, found, n_links = block + 1, 0, [], 0
        if found:
            yield sorted_runs(found, block, aligner)
        aligner.forget()

    return rows.mapInArrow(run, schema)


def _documents(aligner: Aligner, texts: list[str | None], wants_groups: bool) -> list[Document]:
    """The documents of a batch. Pieces of all texts are learned together, those of a long one by stretches."""
    found = [Document(wants_groups) for _ in texts]
    if len(texts) == 1 and texts[0]:
        for stretch in stretches(texts[0]):
            pieces = CUT.split(stretch)
            if aligner.held > REMEMBERED:
                aligner.forget()
            aligner.learn(pieces)
            found[0].add(aligner, pieces)
        return found
    split = [CUT.split(t) if t else None for t in texts]
    aligner.learn({p for pieces in split if pieces for p in pieces})
    for document, pieces in zip(found, split, strict=True):
        if pieces:
            document.add(aligner, pieces)
    return found


def _totals(runs: DataFrame, by: tuple[str, ...], row_bits: int) -> DataFrame:
    """One run of pairs and sums per key; ``row_bits`` is 0 where the given runs have no documents."""
    wanted = [f"{c} int" for c in by]

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, most = None, [], 0, MERGED

        def one() -> bytes:
            return b"".join(pack(*part) for part in merged([pairs_of(r, 0 if own else row_bits) for r, own in held]))

        def result() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [pa.array([k], pa.int32()) for k in key] + [pa.array([one()], pa.binary())]
                yield pa.record_batch(columns, names=[*by, "run"])

        for batch in batches:
            for i in range(batch.num_rows):
                if (own := tuple(batch.column(c)[i].as_py() for c in by)) != key:
                    yield from result()
                    key, held, size, most = own, [], 0, MERGED
                held.append((batch.column("run")[i].as_py(), False))
                size += len(held[-1][0])
                if size > most:
                    held = [(one(), True)]
                    size = len(held[0][0])
                    most = max(MERGED, 2 * size)
        yield from result()

    dealt = runs.select(*by, "run").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, ", ".join([*wanted, "run binary"]))


def _counted(totals: DataFrame, shift_b: int) -> DataFrame:
    """Per radix, the pairs with their counts and whether these are the highest of the B id."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                best = with_best(frames(batch.column("run")[i].as_py()), shift_b)
                own = b"".join(pack(*part) for part in best)
                yield pa.record_batch([batch.column("radix").slice(i, 1), pa.array([own], pa.binary())], names=["radix", "counts"])

    return totals.mapInArrow(run, "radix int, counts binary")


def _contributions(runs: DataFrame, counted: DataFrame, salts: int, row_bits: int) -> DataFrame:
    """What the pairs of a radix add to each document: links of the highest count, and the sum of counts."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radix, pairs, counts, best = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("radix")[i].as_py()
                if (given := batch.column("counts")[i].as_py()) is not None:
                    if own != radix:
                        radix = own
                        pairs, counts, best = np.concatenate(list(frames(given)), axis=1)
                        counts, best = counts.astype(np.int64), best.astype(np.int64)
                    continue
                rows, sums, n_best = [], [], []
                for words, numbers in frames(batch.column("run")[i].as_py()):
                    at, numbers = np.searchsorted(pairs, words >> np.uint64(row_bits)), numbers.astype(np.int64)
                    rows.append((words & np.uint64((1 << row_bits) - 1)).astype(np.int64))
                    sums.append(numbers * counts[at])
                    n_best.append(numbers * best[at])
                rows = np.concatenate(rows)
                order = np.argsort(rows, kind="stable")
                rows = rows[order]
                begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                columns = [pa.array(np.full(len(begins), batch.column("block")[i].as_py())), pa.array(rows[begins])]
                columns += [pa.array(np.add.reduceat(np.concatenate(c)[order], begins)) for c in (n_best, sums)]
                yield pa.record_batch(columns, names=["block", "row", "n_best", "count_sum"])

    copies = counted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = runs.unionByName(copies, allowMissingColumns=True)
    dealt = both.repartition("radix", "salt").sortWithinPartitions("radix", F.col("counts").isNull())
    return dealt.mapInArrow(run, "block long, row long, n_best long, count_sum long")


def align(docs: DataFrame, byte_spec: str, piece_model: str, groups: bool = True, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the tokens ``n_a`` and ``n_b`` of the two tokenizers, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is as frequent as any of its B id in all documents), ``count_sum`` (of the links'
    pairs), ``groups_sha256`` and, if wanted, ``groups``: ``a1,a2|b1;a3|b2,b3`` with decimal ids.

    ``byte_spec`` is a file of the tokenizers library, ``piece_model`` one of sentencepiece. The driver
    reads them; tasks get them as a broadcast, as large as the vocabularies whatever the corpus."""
    spec, model = Path(byte_spec).read_text(encoding="utf-8"), Path(piece_model).read_bytes()
    if json.loads(spec)["model"]["type"] != "BPE":
        raise ValueError("the first tokenizer must be a byte-level BPE")
    layout = Aligner(spec, model)
    row_bits, shift_b = layout.row_bits, layout.shift_b
    others = [c for c in docs.columns if c != text and c.lower() not in OUTPUT]
    given = {f"c{i}": c for i, c in enumerate(others)}  # own names can't clash with extra columns
    rows = docs.select(*[named(c).alias(n) for n, c in given.items()], named(text).cast("string").alias("text"))
    encoded = staged(_encoded(rows, list(given), spec, model, groups), "encoded")
    runs = encoded.filter(F.col("radix").isNotNull()).select("block", "radix", "run")
    size = runs.agg(F.sum(F.octet_length("run"))).first()[0] or 0
    salts = max(1, -(-size // (RADIXES * SALTED)))
    runs = runs.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    salted = _totals(runs, ("radix", "salt"), row_bits)
    counted = staged(_counted(_totals(salted, ("radix",), 0), shift_b), "counts")
    added = _contributions(runs, counted, salts, row_bits).groupBy("block", "row")
    added = added.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    documents = encoded.filter(F.col("radix").isNull()).join(added, ["block", "row"], "left")
    outputs = [c for c in OUTPUT if groups or c != "groups"]
    found = documents.na.fill(0, ["n_best", "count_sum"])
    return found.select(*[F.col(n).alias(c) for n, c in given.items()], *outputs)

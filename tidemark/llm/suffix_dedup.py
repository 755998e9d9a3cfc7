"""Removal of repeated byte strings over a whole corpus by prefix-free parsing.

Rolling-hash triggers cut texts into phrases, each from one trigger to the end of the next, so equal windows of
``length`` bytes hold equal phrases at equal places, and no phrase is the beginning of another one. The order of the corpus' suffixes then follows from
that of the *dictionary* (the distinct phrases by their bytes) and that of the *parse* (the texts as numbers of
phrases): suffixes at phrase starts are ordered as the parse's suffixes are, and what repeats are neighbours there:

1. Phrases are counted by hashes. A window that holds a phrase occurring once is unique; only the others stay
   candidates, and only phrases that they hold enter the dictionary.
2. *dictionary*: its phrases are dealt out by ranges of their bytes and sorted, which numbers them in the order of their bytes.
3. *parse*: its suffixes, each cut where it covers all windows that start in its first phrase, are dealt out by
   ranges of that phrase's number and sorted: a range of the parse's suffix array. Each suffix is told
   how many phrases it shares with its neighbours. All windows within what is shared are repeated, and a
   window that holds a phrase beyond what the suffix from its first whole phrase shares is unique.
4. What is left are windows at the rims of repeated passages, which start or end inside phrases that differ, and windows
   without a whole phrase. These few are compared one by one, by hashes, together with the repeated ones that may be equal
   to them: those whose suffix shares its phrases with one that goes on, or is preceded, by another phrase.
   The suffixes of the dictionary's phrases, ten and more times its size, aren't sorted.

Texts are parsed in blocks of about ``BLOCK`` bytes, which are written once to the shared folder, a file for each run of
``RUN`` blocks. Tasks read the files of their runs there, so that texts are never shuffled. Phrases, suffixes and windows travel packed, each
at most once per run, and what is told of them comes back as numbers. So a phrase, suffix or window
that every document has is one entry of a bucket per run, not per document or block: a group has
``KEYS_PER_BUCKET`` entries on average and a run's entry more for each such string. Suffixes that start with a phrase
found in very many runs ("hot") are dealt out by all phrases within ``length`` bytes and not by the first; windows before a hot phrase
are compared one by one.

Of phrases 32 bits within a bucket tell in step 1, as one that is wrongly taken for repeated only leaves more
candidates. Phrases are numbered by their bytes, so steps 2 and 3 are exact between runs; within a run phrases and suffixes are
told apart by 64 random bits (a chance of 1 in 10^7 for a run), windows in step 4 by 96: among 10^12 different ones two
are taken for equal with a chance of 1 in 10^5. The ranges come from a sample of at most some 16 phrases for each of at most ``RANGES`` of them; nothing else is sampled.

Defined cases: a null text has no bytes; texts shorter than the window lose nothing; a text of any length is one
block, not cut, for which a task needs some 50 times its bytes; repeated rows are texts of their own, so both
lose all; an empty table gives an empty result; columns of the output's names are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import named
from tidemark.llm.common import power_of_two, releasing, shared_folder, small_batches, staged
from tidemark.llm.pfp import EVERY, TRIGGER, Block

BLOCK = 1 << 20
#: Blocks, and bytes of text, whose numbers are sent together.
RUN, RUN_BYTES = 8, 8 << 20
KEYS_PER_BUCKET = 500_000
#: A phrase in so many runs has the suffixes that start with it dealt out by content.
HOT_RUNS = 4096
#: Most ranges of phrases, and the bytes of a phrase that tell its range.
RANGES, SHOWN = 1 << 16, 32
#: Bytes of text that a task takes on at least before there are more of them than shuffle partitions.
TASK_BYTES = 1 << 30
PARSED = "run long, path string, bucket long, keys binary, flags binary"
ANSWERS = "run long, kind int, bucket long, body binary, more binary"
KEYS = "bucket long, run long, keys binary, others binary, body binary, more binary, flags binary"
OUTPUT = {
    "n_bytes": T.LongType(),
    "n_removed": T.LongType(),
    "n_spans": T.LongType(),
    "spans": T.ArrayType(T.ArrayType(T.LongType())),
    "kept": T.BinaryType(),
}


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


# ------------------------------------------------------------ what a block has


def _numbers(packed: bytes | None, kind: type = np.uint64) -> np.ndarray:
    return np.frombuffer(packed or b"", kind)


def _is_in(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted ``found``."""
    if not len(found):
        return np.zeros(len(keys), bool)
    return found[np.minimum(np.searchsorted(found, keys), len(found) - 1)] == keys


class Parsed:
    """A block and what the rounds so far have told about it."""

    def __init__(self, batch: pa.RecordBatch, length: int):
        self.table, self.length = batch, length
        texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        self.block = Block(data, offsets - offsets[0], length)
        self.start, self.end = self.block.phrases()
        self.keys = self.block.hashes(self.start, self.end) | np.uint64(1)

    def candidates(self, repeated: np.ndarray, hot: np.ndarray, bits: int) -> None:
        """Runs of windows that hold no phrase occurring once; the phrases that these hold are ``listed``."""
        shown = _shown(self.keys, bits)
        twice = _is_in(shown, repeated)
        self.low, self.high = self.block.candidates(self.start[~twice], self.end[~twice])
        run = np.searchsorted(self.low, self.start, "right") - 1
        held = (run >= 0) & (np.append(self.high, -1)[run] >= self.end - self.length)
        self.listed = np.flatnonzero(twice & held)
        self.hot = _is_in(shown[self.listed], hot)

    def suffixes(self) -> None:
        """For each listed phrase the ``last`` one of the parse's suffix from it, the key of the listed phrase
        ``before`` it (0 for none), and a hash of both."""
        n = len(self.start)
        listed = np.zeros(n + 1, bool)
        listed[self.listed] = True
        ends = np.ones(n, bool)
        if n:
            ends[:-1] = ~(listed[:-2] & listed[1:-1] & (self.start[1:] == self.end[:-1] - TRIGGER))
        breaks = np.flatnonzero(ends)
        begin, end = self.start[self.listed], self.end[self.listed]
        covers = np.searchsorted(self.end, end - TRIGGER + self.length - 1)
        self.last = np.minimum(covers, breaks[np.searchsorted(breaks, self.listed)]) if n else self.listed
        follows = (self.listed > 0) & ~np.append(ends, True)[self.listed - 1]
        self.before = np.where(follows, self.keys[self.listed - 1], np.uint64(0)) if n else self.keys
        begin = np.where(follows, self.start[self.listed - 1], begin) if n else begin
        self.names = self.block.hashes(begin, self.end[self.last]) ^ follows.astype(np.uint64)

    def heads(self) -> np.ndarray:
        """Hashes of all phrases of a suffix that end within the window at its start."""
        begin = self.start[self.listed]
        within = np.searchsorted(self.end, begin + self.length, "right") - 1
        return self.block.hashes(begin, self.end[np.minimum(self.last, within)])

    def judge(self, names: np.ndarray, told: np.ndarray) -> None:
        """Windows that the numbers of shared phrases tell: ``same`` are runs of repeated ones, ``window`` those
        that are to be compared one by one."""
        n, never = len(self.block.data), np.iinfo(np.int64).max
        shared = told[np.searchsorted(names, self.names)].astype(np.int64) if len(names) else np.zeros((len(self.names), 3), np.int64)
        beyond = self.listed[:, None] + shared
        until = np.where(shared[:, 0] > 0, np.append(self.end, 0)[beyond[:, 0] - 1] - self.length, -1)
        # The first windows that hold a phrase beyond what is shared.
        holds = np.append(self.end, 0)[np.minimum(beyond, len(self.end))] - self.length
        holds[beyond > self.last[:, None]] = never
        trigger = self.block.trigger_ends - TRIGGER
        phrase = np.searchsorted(trigger, self.start[self.listed])
        same, right, unique, left = np.full((4, len(trigger) + 1), never)
        same[:] = -1
        same[phrase], right[phrase] = until, holds[:, 1]
        unique[phrase], left[phrase] = (np.where(self.hot, never, holds[:, c]) for c in (0, 2))
        # Windows that start at a trigger or a text's start, or after it and before the next one.
        begin = np.unique(np.concatenate([self.block.offsets[:-1], trigger]))
        begin = begin[begin < n]
        stop = np.append(begin, n)[1:] - 1
        after = np.searchsorted(trigger, begin, "right")
        own = np.where(np.append(trigger, -1)[after - 1] == begin, after - 1, len(trigger))
        repeated = np.minimum(stop, same[own])
        found = repeated >= begin
        self.same = begin[found], repeated[found]
        asked = np.minimum(repeated, np.maximum(right[own], left[after]) - 1)
        self.window = self._windows(
            np.concatenate([begin, np.maximum(begin, repeated + 1)]),
            np.concatenate([asked, np.minimum(stop, unique[after] - 1)]),
        )
        self.window_keys = self.block.hashes(self.window, self.window + self.length)

    def _windows(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Candidates within the given ranges, which don't overlap."""
        change = np.zeros(len(self.block.data) + 1, np.int32)
        some = low <= high
        for begin, end in ((low[some], high[some]), (self.low, self.high)):
            np.add.at(change, begin, 1)
            np.add.at(change, end + 1, -1)
        return np.flatnonzero(np.cumsum(change) == 2)

    def second_of_windows(self) -> np.ndarray:
        return self.block.second_hashes(self.window, self.window + self.length).astype(np.uint32)

    def spans(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        single = self.window[_is_in(self.window_keys, windows)]
        return self.block.covered(
            np.concatenate([self.same[0], single]), np.concatenate([self.same[1], single])
        )

    def shown(self, which: np.ndarray) -> np.ndarray:
        """The first bytes of phrases, by which they are dealt out."""
        at = self.start[which][:, None] + np.arange(SHOWN)
        inside = at < self.end[which][:, None]
        data = np.append(self.block.data, np.uint8(0))
        return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8).view(f"S{SHOWN}").ravel()


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start``, ``start + 1``, ... ``size`` of them, for one entry after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    if bits == 0:
        return np.zeros(len(keys), np.int64)
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _shown(keys: np.ndarray, bits: int) -> np.ndarray:
    """What is told of a phrase: its bucket and 32 bits more."""
    return keys >> np.uint64(32 - bits)


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct rows, ordered by the first column, then the others; how often each is found."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _rows(run: int, bucket: np.ndarray, flags: np.ndarray, keys: np.ndarray, others: np.ndarray | None = None, body: np.ndarray | None = None, sizes: np.ndarray | None = None, more: np.ndarray | None = None) -> pa.Table:
    """A row per bucket; ``bucket`` is sorted. ``body`` has ``sizes`` entries for each key, which are packed with it."""
    found, first = np.unique(bucket, return_index=True)
    ends = np.append(first, len(bucket))[1:]
    cut = [slice(a, b) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
    packed = lambda x, cut=cut: pa.array([b"" if x is None else x[c].tobytes() for c in cut], pa.binary())
    inner = cut
    if sizes is not None:
        place = np.append(0, np.cumsum(sizes)).tolist()
        inner = [slice(place[c.start], place[c.stop]) for c in cut]
    return pa.table(
        [
            pa.array(found.astype(np.int64), pa.int64()),
            pa.array([run] * len(cut), pa.int64()),
            packed(keys),
            packed(others if sizes is None else sizes.astype(np.uint16)),
            packed(body, inner),
            packed(more),
            pa.array([_bits(flags[c]) for c in cut], pa.binary()),
        ],
        names=["bucket", "run", "keys", "others", "body", "more", "flags"],
    )


# ---------------------------------------------------------------- what repeats


def _gathered(table: pa.Table, **columns: type) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The run that each key is from, the columns, and the flags; the first column has the keys."""
    parts = [[_numbers(x, kind) for x in table.column(c).to_pylist()] for c, kind in columns.items()]
    sizes = [len(k) for k in parts[0]]
    run = np.repeat(np.arange(len(sizes)), sizes)
    flags = [_flags(f, n) for f, n in zip(table.column("flags").to_pylist(), sizes, strict=True)]
    return run, [np.concatenate(p) for p in parts], np.concatenate(flags)


def _answers(kind: int, key: tuple, table: pa.Table, run: np.ndarray, body: np.ndarray, more: np.ndarray, told: np.ndarray | None = None, told_more: np.ndarray | None = None) -> pa.Table:
    """To each run the entries of ``body`` and ``more`` that are for it: all or those ``told``."""
    places = np.arange(table.num_rows)

    def cut(found: np.ndarray, which: np.ndarray | None) -> list[bytes]:
        own, found = (run, found) if which is None else (run[which], found[which])  # runs are in order
        begin, end = np.searchsorted(own, places), np.searchsorted(own, places, "right")
        return [found[i:j].tobytes() for i, j in zip(begin.tolist(), end.tolist(), strict=True)]

    return pa.table(
        [
            table.column("run").combine_chunks(),
            pa.array([kind] * len(places), pa.int32()),
            pa.array([key[0].as_py()] * len(places), pa.int64()),
            pa.array(cut(body, told), pa.binary()),
            pa.array(cut(more, told_more), pa.binary()),
        ],
        names=["run", "kind", "bucket", "body", "more"],
    )


def _groups(*columns: np.ndarray) -> np.ndarray:
    """A number for each distinct row, from 0, in the order of the first column and then the others."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    return group


def _repeated_phrases(key: tuple, table: pa.Table) -> pa.Table:
    """Tells which phrases are found twice, and which in very many runs."""
    run, (keys,), twice = _gathered(table, keys=np.uint32)
    group = _groups(keys)
    count = np.bincount(group)
    found = (count > 1) | (np.bincount(group, weights=twice) > 0)
    return _answers(1, key, table, run, keys, keys, found[group], (count >= HOT_RUNS)[group])


def _numbered_phrases(key: tuple, table: pa.Table) -> pa.Table:
    """Sorts the phrases of a range by their bytes; a phrase's number is its share of the range, of 2^32."""
    run, (keys, sizes, body), _ = _gathered(table, keys=np.uint64, others=np.uint16, body=np.uint8)
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
    phrases = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(body)]).dictionary_encode()
    order = pc.sort_indices(phrases.dictionary).to_numpy()
    number = np.empty(len(order), np.uint64)
    number[order] = (np.arange(len(order), dtype=np.uint64) << np.uint64(32)) // np.uint64(max(1, len(order)))
    return _answers(2, key, table, run, keys, number[phrases.indices.to_numpy()].astype(np.uint32))


def _suffix_array(key: tuple, table: pa.Table, width: int) -> pa.Table:
    """Sorts the parse's suffixes of a range and tells each how many phrases it shares: the most with any other,
    the most with one that isn't equal to it, and the most with one after a different phrase. In this order
    these are the nearest such neighbours."""
    run, (keys, sizes, body, before), twice = _gathered(table, keys=np.uint64, others=np.uint16, body=np.uint8, more=np.uint64)
    sizes = sizes.astype(np.int64)
    ends = np.append(0, np.cumsum(sizes))
    suffixes = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends * width), pa.py_buffer(body)])
    order = pc.sort_indices(suffixes).to_numpy().astype(np.int64)
    number = _wide(body, width)
    shared = np.zeros(len(order) + 1, np.int64)  # with the one before
    above, below = order[:-1], order[1:]
    still, depth = np.arange(len(above)), 0
    least = np.minimum(sizes[above], sizes[below])
    while len(still):
        still = still[least[still] > depth]
        still = still[number[ends[above[still]] + depth] == number[ends[below[still]] + depth]]
        shared[still + 1] += 1
        depth += 1
    told = np.empty((len(order), 3), np.int64)
    told[order, 0] = np.maximum(shared[:-1], shared[1:])
    new = np.append(True, (shared[1:-1] < sizes[above]) | (shared[1:-1] < sizes[below]))[: len(order)]
    first = np.flatnonzero(new)
    other = np.maximum(shared[first], shared[np.append(first, len(order))[1:]])
    told[order, 1] = other[np.cumsum(new) - 1]
    left = np.append(0, np.cumsum(before[above] != before[below]))[: len(order)] << 32
    up = np.minimum.accumulate(shared[:-1] - left) + left
    down = np.minimum.accumulate((shared[1:] + left)[::-1])[::-1] - left
    told[order, 2] = np.maximum(up, down)
    told[twice, 0] = sizes[twice]
    return _answers(3, key, table, run, keys, told.astype(np.uint16))


def _narrow(numbers: np.ndarray, width: int) -> np.ndarray:
    """Numbers as ``width`` bytes each, highest first, so that bytes are ordered as numbers are."""
    return numbers.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].ravel()


def _wide(body: np.ndarray, width: int) -> np.ndarray:
    numbers = np.zeros((len(body) // width, 8), np.uint8)
    numbers[:, 8 - width :] = body.reshape(-1, width)
    return numbers.view(">u8").ravel()


def _repeated_windows(key: tuple, table: pa.Table) -> pa.Table:
    run, (keys, others), twice = _gathered(table, keys=np.uint64, others=np.uint32)
    group = _groups(keys, others)
    found = (np.bincount(group) > 1) | (np.bincount(group, weights=twice) > 0)
    return _answers(4, key, table, run, keys, keys, found[group], np.zeros(len(keys), bool))


# ----------------------------------------------------------------------- rounds


class _Run:
    """The blocks of a run on their way to a new file; that of a lost task is never read."""

    def __init__(self, folder: str, schema: pa.Schema):
        self.path, self.keys, self.sample, self.held = f"{folder}/{uuid.uuid4().hex}.arrow", [], [], 0
        store, place = fs.FileSystem.from_uri(self.path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.file = store.open_output_stream(place, compression=None)
        packed = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3), use_threads=False)
        self.out = pa.ipc.new_stream(self.file, schema, options=packed)

    def add(self, batch: pa.RecordBatch, length: int, one_in: int) -> None:
        self.out.write_batch(batch)
        block = Parsed(batch, length)
        self.keys.append(block.keys)
        self.sample.append(block.shown(np.flatnonzero((block.keys >> np.uint64(1)) % np.uint64(one_in) == 0)))
        self.held += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0

    def close(self) -> None:
        self.out.close()
        self.file.close()


def _blocks(path: str) -> Iterator[pa.RecordBatch]:
    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_stream(place, compression=None) as file, pa.ipc.open_stream(file) as blocks:
        yield from blocks


def _parsed(docs: DataFrame, length: int, bits: int, folder: str, one_in: int = 1) -> DataFrame:
    """For each ``run`` a row with the ``path`` of the file of its blocks, which hold all columns of the rows, and
    its distinct phrases: ``keys`` of each ``bucket``, and ``flags`` of those that the run holds twice. The row of
    the path has as ``keys`` the first bytes of one phrase in ``one_in``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = TaskContext.get().partitionId() << 32, None
        names = [c.split()[0] for c in PARSED.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]

        def told(own: _Run) -> Iterator[pa.RecordBatch]:
            own.close()
            values = [number, own.path, None, np.unique(np.concatenate(own.sample)).tobytes(), None]
            yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)
            keys, count = np.unique(_shown(np.concatenate(own.keys), bits), return_counts=True)
            rows = _rows(number, (keys >> np.uint64(32)).astype(np.int64), count > 1, keys.astype(np.uint32))
            columns = [rows.column(c) if c in rows.column_names else pa.nulls(rows.num_rows, k) for c, k in zip(names, kinds, strict=True)]
            yield from pa.table(columns, names=names).to_batches()

        for batch in small_batches(batches, "text", BLOCK):
            own = own or _Run(folder, batch.schema)
            own.add(batch, length, one_in)
            if len(own.keys) >= RUN or own.held >= RUN_BYTES:
                yield from told(own)
                number, own = number + 1, None
        if own:
            yield from told(own)

    return docs.mapInArrow(releasing(run), PARSED)


class _Told:
    """The blocks of a run, and what earlier rounds have told it."""

    def __init__(self, table: pa.Table, length: int, bits: int):
        self.length, self.bits, self.table, self.kinds = length, bits, table, table.column("kind").to_pylist()
        self.path = table.column("body")[self.kinds.index(0)].as_py().decode()
        self.repeated, self.hot = (np.unique(self._column(1, c, np.uint32, True)) for c in ("body", "more"))

    def _column(self, kind: int, name: str, number: type, in_bucket: bool = False) -> np.ndarray:
        rows = self.table.filter(pc.equal(self.table.column("kind"), kind))
        parts = [_numbers(x, number) for x in rows.column(name).to_pylist()]
        if in_bucket:
            parts = [x.astype(np.uint64) | np.uint64(b << 32) for x, b in zip(parts, rows.column("bucket").to_pylist(), strict=True)]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def pairs(self, kind: int, number: type, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and the ``width`` numbers that are told of each."""
        keys, values = self._column(kind, "body", np.uint64), self._column(kind, "more", number, width == 1)
        order = np.argsort(keys)
        return keys[order], values.reshape(-1, width)[order]

    def windows(self) -> np.ndarray:
        return np.unique(self._column(4, "body", np.uint64))

    def __iter__(self) -> Iterator[Parsed]:
        for batch in _blocks(self.path):
            block = Parsed(batch, self.length)
            block.candidates(self.repeated, self.hot, self.bits)
            yield block


def remove_repeats(docs: DataFrame, length: int = 200, text: str = "text", as_text: bool = False) -> DataFrame:
    """``docs`` with, in place of the text, ``kept`` (the bytes that stay), ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``spans`` (start and end of the maximal removed runs, in bytes).

    With ``as_text`` the columns are those of ``docs``, the text being what stays, less the parts
    of a character of which other bytes were removed."""
    given = {c: "text" if c == text else f"c{i}" for i, c in enumerate(docs.columns)}
    kept = [c for c in given if c != text and (as_text or c.lower() not in OUTPUT)]
    columns, others = list(given.values()), [given[c] for c in kept]
    rows = docs.select(*[named(c).alias(given[c]) for c in kept], named(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(32, power_of_two(total / EVERY / KEYS_PER_BUCKET))
    coarse = min(bits, power_of_two(RANGES))
    width = (32 + coarse + 7) // 8
    one_in = max(1, int(total / EVERY) // (16 << coarse))
    blocks = staged(_parsed(rows, length, bits, f"{shared_folder(docs.sparkSession)}/blocks", one_in), "phrases")
    paths = blocks.filter("path IS NOT NULL")
    sampled = paths.filter("octet_length(keys) > 0").select("keys").collect()
    sample = np.sort(np.frombuffer(b"".join(r["keys"] for r in sampled), f"S{SHOWN}"))
    bounds = sample[np.arange(1, 1 << coarse) * len(sample) >> coarse] if len(sample) else sample
    schema = T.StructType([rows.schema[c] for c in others])
    for name, kind in OUTPUT.items():
        schema.add(name, kind)
    names = {given[c]: c for c in kept}
    if as_text:
        schema = T.StructType([T.StructField(given[f.name], f.dataType) for f in docs.schema])
        names = {n: c for c, n in given.items()}

    def dictionary(key: tuple, table: pa.Table) -> pa.Table:
        names, shown, sizes, bodies = [], [], [], []
        for p in _Told(table, length, bits):
            name, at = np.unique(p.keys[p.listed], return_index=True)
            which = p.listed[at]
            size = p.end[which] - p.start[which]
            names.append(name)
            shown.append(p.shown(which))
            sizes.append(size)
            bodies.append(p.block.data[_places(p.start[which], size)])
        name, at = np.unique(np.concatenate(names), return_index=True)
        size, body = np.concatenate(sizes), np.concatenate(bodies)
        bucket = np.searchsorted(bounds, np.concatenate(shown)[at], "right")
        order = np.argsort(bucket, kind="stable")
        at = at[order]
        body = body[_places((np.cumsum(size) - size)[at], size[at])]
        return _rows(key[0].as_py(), bucket[order], np.zeros(len(at), bool), name[order], body=body, sizes=size[at])

    def parse(key: tuple, table: pa.Table) -> pa.Table:
        told, found, numbers, before = _Told(table, length, bits), [], [], 0
        keys, number = told.pairs(2, np.uint32)
        for p in told:
            p.suffixes()
            own = np.zeros(len(p.start), np.uint64)
            own[p.listed] = number[np.searchsorted(keys, p.keys[p.listed]), 0] if len(keys) else 0
            bucket = np.where(p.hot, _bucket(p.heads(), bits), (own[p.listed] >> np.uint64(32 + coarse - bits)).astype(np.int64))
            found.append((bucket, p.names, p.listed + before, p.last - p.listed + 1, p.before))
            numbers.append(own)
            before += len(own)
        bucket, name, first, size, left = (np.concatenate(c) for c in zip(*found, strict=True))
        at, count = _distinct(bucket, name)
        body = _narrow(np.concatenate(numbers)[_places(first[at], size[at])], width)
        return _rows(key[0].as_py(), bucket[at], count > 1, name[at], body=body.reshape(-1, width), sizes=size[at], more=left[at])

    def rims(key: tuple, table: pa.Table) -> pa.Table:
        told, found = _Told(table, length, bits), []
        names, shared = told.pairs(3, np.uint16, 3)
        for p in told:
            p.suffixes()
            p.judge(names, shared)
            found.append((p.window_keys, p.second_of_windows()))
        keys, other = (np.concatenate(c) for c in zip(*found, strict=True))
        at, count = _distinct(keys, other)
        return _rows(key[0].as_py(), _bucket(keys[at], bits), count > 1, keys[at], other[at])

    def last(key: tuple, table: pa.Table) -> pa.Table:
        told, found = _Told(table, length, bits), []
        (names, shared), windows = told.pairs(3, np.uint16, 3), told.windows()
        for p in told:
            p.suffixes()
            p.judge(names, shared)
            low, high = p.spans(windows)
            found.append(_result(p, low, high, others, as_text, columns, "text"))
        return pa.concat_tables(found)

    nothing = F.lit(None).cast("binary")
    body = paths.select("run", F.lit(0).alias("kind"), "bucket", F.col("path").cast("binary").alias("body"), nothing.alias("more"))
    # The rows that are shuffled are few beside the texts that their tasks read, so their size can't tell how many tasks.
    most = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES)
    tasks = max(1, min(paths.count(), most))

    def with_answers(f: Callable[[tuple, pa.Table], pa.Table], schema: T.StructType | str, *answers: DataFrame) -> DataFrame:
        rows = body
        for answer in answers:
            rows = rows.unionByName(answer)
        return rows.repartition(tasks, "run").groupBy("run").applyInArrow(releasing(f), schema)

    def answered(keys: DataFrame, f: Callable[[tuple, pa.Table], pa.Table], name: str) -> DataFrame:
        return staged(keys.groupBy("bucket").applyInArrow(releasing(f), ANSWERS), name)

    def sorted_suffixes(key: tuple, table: pa.Table) -> pa.Table:
        return _suffix_array(key, table, width)

    repeated = answered(blocks.filter("path IS NULL").select("bucket", "run", "keys", "flags"), _repeated_phrases, "repeated")
    numbers = answered(with_answers(dictionary, KEYS, repeated), _numbered_phrases, "dictionary")
    shared = answered(with_answers(parse, KEYS, repeated, numbers), sorted_suffixes, "parse")
    windows = answered(with_answers(rims, KEYS, repeated, shared), _repeated_windows, "windows")
    found = with_answers(last, schema, repeated, shared, windows)
    return found.select(*[F.col(n).alias(names.get(n, n)) for n in found.columns])


def _result(p: Parsed, low: np.ndarray, high: np.ndarray, others: list[str], as_text: bool, columns: list[str], text: str) -> pa.Table:
    offsets, data = p.block.offsets, p.block.data
    of = np.searchsorted(offsets, low, "right") - 1
    cut = np.searchsorted(of, np.arange(len(offsets)))
    kept, spans = [], []
    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        own = [(int(x), int(y)) for x, y in zip(low[cut[i] : cut[i + 1]], high[cut[i] : cut[i + 1]], strict=True)]
        ends = [a, *[e for span in own for e in span], b]
        kept.append(b"".join(data[ends[k] : ends[k + 1]].tobytes() for k in range(0, len(ends), 2)))
        spans.append([[x - a, y - a] for x, y in own])
    if as_text:
        null = p.table.column("text").is_null().to_pylist()
        own = [None if gone else k.decode("utf-8", "ignore") for k, gone in zip(kept, null, strict=True)]
        return pa.table([pa.array(own, pa.string()) if c == text else p.table.column(c) for c in columns], names=columns)
    size = np.diff(offsets)
    kept_size = np.array([len(k) for k in kept], np.int64)
    found = [size, size - kept_size, np.array([len(s) for s in spans], np.int64)]
    return pa.table(
        [*[p.table.column(c) for c in others], *[pa.array(x, pa.int64()) for x in found], pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
        names=[*others, *OUTPUT],
    )

"""WARC archives: writing whole-file gzip streams, normalising them to one gzip member per
record with a sidecar offset index, and reading records back by that index.

``write_archives`` writes one monolithic stream per task and file. ``normalise`` inflates each file once,
as a stream, and rewrites every record as a member of its own; beside each file lies
``<file>.idx`` with a JSON line per record. ``read_index`` reads these sidecars, ``read_records`` opens files at
the offsets they tell only.

Tasks write files under names of their own and report them; only files of tasks that ended well
are in a table of results, which is written to the shared folder. A task that runs again writes
new files, and those of the lost one are never read. Files go through ``pyarrow.fs``, so the
folder may be on any file system that the executors share and pyarrow knows.

Of records with equal payloads, that with the largest page id is a response, others
revisit it. Groups are found by SHA-1, aggregated to one row in each task first, and written; where they are too
many to broadcast, adaptive execution splits a payload of many pages over tasks.

Defined cases: a null payload is empty, equal to other empty ones; rows that share the largest id of
a group are all responses; a row without id revisits a row with one, and groups without any id are
all responses; a null url is an empty target; an empty table writes nothing; other columns are left out. A record of
any size is one member, larger than a file's bound if need be; a task holds a few times its bytes.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder, small_batches, staged

DATE = "1970-01-01T00:00:00Z"
#: Inflated bytes after which a task begins another file, and bytes read at a time.
FILE_BYTES = 256 << 20
CHUNK = 1 << 18
LEVEL = 4
URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Lines of a sidecar that become rows at once.
LINES = 4096
#: Payload bytes of a batch that are held as Python objects at once.
GROUP = 1 << 24
MANIFEST = "path string, n_records long"
INDEX = "path string, record_id string, record_type string, offset long, length long"
RECORDS = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode().rstrip("=")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response, or a revisit with the headers of the response but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    name = lambda i: f"<{URN}{'' if i is None else i}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, cut from a stream of inflated bytes; holds one record and one chunk."""
    held, need = bytearray(), None
    for chunk in chunks:
        held += chunk
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(headers(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


def inflated(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The content of a gzip file of one or many members."""
    engine = zlib.decompressobj(31)
    while data := stream.read(chunk):
        while data:
            out = engine.decompress(data, chunk)
            if out:
                yield out
            if engine.eof:
                data, engine = engine.unused_data, zlib.decompressobj(31)
            else:
                data = engine.unconsumed_tail
    if rest := engine.flush():
        yield rest


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``refers_to`` and ``revisit`` for rows of ``page_id``,
    ``url``, ``html``."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND largest IS NOT NULL")
    )
    # Written first, so that the join below reads exchanges only and a payload of many pages can be split.
    groups = staged(groups, "groups")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("largest")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(pages: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Write a record per page to monolithic gzip files; a row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, size, n = [], None, 0, 0
        for batch in small_batches(batches, "payload", GROUP):
            for row in batch.to_pylist():
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, place = _open(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out, press, size, n = store.open_output_stream(place, compression=None), zlib.compressobj(level, wbits=31), 0, 0
                one = record(row["page_id"], row["url"], row["payload"], row["refers_to"], row["revisit"])
                out.write(press.compress(one))
                size, n = size + len(one), n + 1
                if size >= FILE_BYTES:
                    out.write(press.flush())
                    out.close()
                    files.append((path, n))
                    out = None
        if out is not None:
            out.write(press.flush())
            out.close()
            files.append((path, n))
        yield pa.record_batch([pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64())], names=["path", "n_records"])

    return staged(with_revisits(pages).mapInArrow(run, MANIFEST), "manifest")


def normalise(manifest: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrite each file of ``path`` with a gzip member per record and a sidecar index; a row per new file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield _normalised(path, f"{folder}/{uuid.uuid4().hex}.warc.gz", level)

    files = max(1, manifest.count())
    return staged(manifest.select("path").repartition(files).mapInArrow(run, MANIFEST), "normalised")


def _normalised(path: str, target: str, level: int) -> pa.RecordBatch:
    source, place = _open(path)
    store, to = _open(target)
    store.create_dir(to.rpartition("/")[0], recursive=True)
    n, offset = 0, 0
    with (
        source.open_input_stream(place, compression=None) as stream,
        store.open_output_stream(to, compression=None) as out,
        store.open_output_stream(f"{to}.idx", compression=None) as index,
    ):
        for one in records(inflated(stream)):
            head = headers(one[: one.find(b"\r\n\r\n")])
            press = zlib.compressobj(level, wbits=31)
            member = press.compress(one) + press.flush()
            out.write(member)
            line = {"record_id": head["warc-record-id"].strip("<>"), "record_type": head["warc-type"]}
            index.write(json.dumps(line | {"offset": offset, "length": len(member)}).encode() + b"\n")
            n, offset = n + 1, offset + len(member)
    return pa.record_batch([pa.array([target], pa.string()), pa.array([n], pa.int64())], names=["path", "n_records"])


def read_index(manifest: DataFrame) -> DataFrame:
    """The sidecars of normalised files, a row per record; one whose lines aren't as many as its records raises."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["record_id", "record_type", "offset", "length"]

    def rows(path: str, lines: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([x[c] for x in lines], k) for c, k in zip(names, kinds, strict=True)]
        return pa.record_batch([pa.array([path] * len(lines), pa.string()), *columns], names=["path", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, wanted in zip(batch.column("path").to_pylist(), batch.column("n_records").to_pylist(), strict=True):
                n, held = 0, []
                store, place = _open(f"{path}.idx")
                with store.open_input_stream(place, compression=None) as stream:
                    for line in io.TextIOWrapper(io.BufferedReader(stream), "utf-8"):
                        held.append(json.loads(line))
                        if len(held) == LINES:
                            yield rows(path, held)
                            n, held = n + len(held), []
                if n + len(held) != wanted:
                    raise ValueError(f"{path}.idx: {n + len(held)} lines for {wanted} records")
                yield rows(path, held)

    # A file a task: the table of files is too small for Spark to split by itself.
    files = max(1, manifest.count())
    return manifest.select("path", "n_records").repartition(files).mapInArrow(run, INDEX)


def parsed(one: bytes) -> tuple:
    """The values of ``RECORDS`` of a record. The payload of a revisit is null, its length that of
    the response's headers; a response whose payload isn't that of its digest raises."""
    end = one.find(b"\r\n\r\n")
    head, block = headers(one[:end]), one[end + 4 : -4]
    cut = block.find(b"\r\n\r\n") + 4
    said = head["warc-payload-digest"].removeprefix("sha1:")
    number = lambda s: int(s) if (s := s.strip("<>").removeprefix(URN)) else None
    revisit = head["warc-type"] == "revisit"
    payload = None if revisit else block[cut:]
    if payload is not None and digest_of(payload) != said:
        raise ValueError(f"{head['warc-record-id']}: the payload isn't that of its digest")
    size = int(headers(block[: cut - 4])["content-length"]) if revisit else len(payload)
    refers_to = number(head["warc-refers-to"]) if revisit else None
    return number(head["warc-record-id"]), head["warc-target-uri"], payload, size, said, head["warc-type"], refers_to


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at the offsets of an index, with or without their payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                found = []
                for row in batch.slice(begin, 256).to_pylist():
                    if row["path"] != opened:
                        if file is not None:
                            file.close()
                        store, place = _open(row["path"])
                        opened, file = row["path"], store.open_input_file(place)
                    member = file.read_at(row["length"], row["offset"])
                    found.append(parsed(zlib.decompress(member, 31)))
                columns = [list(c) for c in zip(*found, strict=True)]
                if not payloads:
                    columns[2] = [None] * len(found)
                kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=[c.split()[0] for c in RECORDS.split(", ")],
                )

    return index.mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None, payloads: bool = False) -> DataFrame:
    """Write, normalise and read back all pages."""
    folder = folder or shared_folder(pages.sparkSession)
    files = normalise(write_archives(pages, f"{folder}/monolithic"), f"{folder}/normalised")
    return read_records(read_index(files), payloads)

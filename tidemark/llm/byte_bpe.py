"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The library works on characters, so bytes are mapped to characters one to one; ranks of byte
strings become a vocabulary of such characters and, for every way to put a token together from
two others, a merge. Decoding looks tokens up in the reversed byte table and joins their bytes: a
character split over several tokens is whole again only then.

Matches of the pattern are encoded by themselves, each distinct one of a batch once. No shuffle; a
task holds the tokens of ``GROUP`` bytes of text at a time, or those of one text.

Defined cases: a null text encodes like an empty one, to no tokens; rows are encoded one by one,
repeated ones alike; an empty table gives an empty result; columns of the output's names are
replaced.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.functions import named
from tidemark.llm.common import releasing, small_batches

GROUP = 1 << 18
#: Matches whose tokens a worker remembers, and characters of these; all are forgotten when there are
#: more, and at the end of a task.
REMEMBERED, REMEMBERED_CHARS = 300_000, 16 << 20
OUTPUT = {
    "ids": T.ArrayType(T.IntegerType()),
    "starts": T.ArrayType(T.IntegerType()),
    "ends": T.ArrayType(T.IntegerType()),
    "decoded": T.BinaryType(),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if it is one, else the next from 256 on."""
    shown = [33 <= b <= 126 or (161 <= b <= 255 and b != 173) for b in range(256)]
    hidden = iter(range(256, 512))
    return [chr(b if shown[b] else next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank per line."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The tokenizer of a rank table, which merges the adjacent pair of the lowest rank first. It
    is given one match of the pattern at a time."""
    table = byte_characters()
    name = {token: "".join(table[b] for b in token) for token in ranks}
    merges = []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = token[:i], token[i:]
            if left in ranks and right in ranks:
                merges.append((rank, ranks[left], ranks[right], name[left], name[right]))
    merges.sort()
    model = models.BPE(
        vocab={name[token]: rank for token, rank in ranks.items()},
        merges=[(m[3], m[4]) for m in merges],
        ignore_merges=True,
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer.to_str()


class Codec:
    """Encodes matches of the pattern, each distinct one once while it is remembered."""

    def __init__(self, spec: str, pattern: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.tokenizer, self.remembered = Tokenizer.from_str(spec), remembered
        self.matches = regex.compile(pattern)
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = json.loads(spec)["model"]["vocab"]
        self.bytes_of = {i: bytes(back[c] for c in token) for token, i in vocab.items()}
        self.ids_of: dict[str, bytes] = {}  # packed: 32 bits each
        self.held = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [self.matches.findall(t) for t in texts]
        known = self.ids_of
        new = [w for w in set(chain.from_iterable(words)) if w not in known]
        self.held += sum(map(len, new))
        if len(known) + len(new) > self.remembered or self.held > REMEMBERED_CHARS:
            known.clear()
            new = list(set(chain.from_iterable(words)))
            self.held = sum(map(len, new))
        encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        known.update((w, array("i", e.ids).tobytes()) for w, e in zip(new, encoded, strict=True))
        return [np.frombuffer(b"".join(map(known.__getitem__, w)), np.int32) for w in words]

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """First and last character (exclusive) of every token; those of a split character share it."""
        found = []
        for match in self.matches.finditer(text):
            begin = match.start()
            encoded = self.tokenizer.encode(match[0], add_special_tokens=False)
            found += [(begin + a, begin + b) for a, b in encoded.offsets]
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def _codec(spec: str, pattern: str) -> Codec:
    return Codec(spec, pattern)


def encode_and_decode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    outputs: tuple[str, ...] = ("ids", "starts", "ends", "decoded"),
    text: str = "text",
) -> DataFrame:
    """``docs`` without the text, with the given outputs: token ``ids``, the characters of the text
    they come from (``starts``, ``ends``), the ``decoded`` bytes of the ids, ``n_tokens``,
    ``ids_sha256`` (of the decimal ids, joined by commas) and ``decoded_sha256``.

    The driver reads the vocabulary file; tasks get it as a broadcast, which is as large as the
    vocabulary whatever the corpus."""
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json(read_ranks(vocabulary)))
    given = {f"c{i}": c for i, c in enumerate(c for c in docs.columns if c != text and c.lower() not in OUTPUT)}
    others = list(given)
    rows = docs.select(*[named(c).alias(n) for n, c in given.items()], named(text).alias("text"))
    schema = T.StructType([rows.schema[c] for c in others])
    for name in outputs:
        schema.add(name, OUTPUT[name])
    offsets = not {"starts", "ends"}.isdisjoint(outputs)
    decodes = not {"decoded", "decoded_sha256"}.isdisjoint(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value, pattern)
        for batch in small_batches(batches, "text", GROUP):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            columns: dict[str, list] = {name: [] for name in outputs}
            for one, packed in zip(texts, codec.encode(texts), strict=True):
                ids = packed.tolist()
                decoded = codec.decode(ids) if decodes else b""
                places = codec.offsets(one) if offsets else []
                for name, values in columns.items():
                    values.append(_value(name, places, ids, decoded))
            own = [pa.array(columns[n], pa_type(n)) for n in outputs]
            yield pa.record_batch([*[batch.column(c) for c in others], *own], names=[*others, *outputs])
        codec.ids_of.clear()
        codec.held = 0

    return rows.mapInArrow(releasing(run), schema).select(*[F.col(n).alias(c) for n, c in given.items()], *outputs)


def pa_type(name: str) -> pa.DataType:
    ints = pa.list_(pa.int32())
    return {"ids": ints, "starts": ints, "ends": ints, "decoded": pa.binary(), "n_tokens": pa.int64()}.get(name, pa.string())


def _value(name: str, places: list[tuple[int, int]], ids: list[int], decoded: bytes):
    match name:
        case "ids":
            return ids
        case "starts":
            return [a for a, _ in places]
        case "ends":
            return [b for _, b in places]
        case "decoded":
            return decoded
        case "n_tokens":
            return len(ids)
        case "ids_sha256":
            return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return hashlib.sha256(decoded).hexdigest()

"""Line dedup, Merkle manifest and token alignment against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import line_dedup, merkle, queries, token_alignment

SF = "/root/testdata/sf0.001"
SPEC = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ line dedup


def plain_lines(rows, least_chars=20, least_docs=3):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    docs = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                docs[key(line)].add(doc_id)
    smallest = lambda i: (i is not None, i or 0)
    keeper = {k: max(ids, key=smallest) for k, ids in docs.items() if len(ids) >= least_docs}
    found = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), doc_id) == doc_id]
        found.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


def line_rows():
    rng = random.Random(3)
    shared = [f"  Shared line number {i} of the Site\t" for i in range(40)] + ["é" * 19, "é" * 20, "x" * 19, "İstanbul is A long line", "\x85" + "y" * 19]
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, shared[0]), (None, shared[0]), (4, shared[0].upper()), (5, "short")]
    rows += [(6, "only in two documents, of course"), (7, "only in two documents, of course")]
    rows += [(8, "one id, three rows, not three documents")] * 3
    for i in range(10, 90):
        lines = rng.choices(shared, k=rng.randint(0, 12)) + [f"own line of document {i}, number {k}" for k in range(rng.randint(0, 5))]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [rows[-1], rows[-1], (-5, shared[1] + "\r\n" + shared[1]), (1000, "z" * 300_000 + "\n" + shared[2]), (1001, "z" * 300_000), (1002, "Z" * 300_000)]
    return rows


@pytest.mark.parametrize("shipped", [line_dedup.SHIPPED, 0], ids=["shipped filters", "filters by part"])
def test_lines_equal_brute_force(spark, shipped):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = [tuple(r) for r in line_dedup.drop_repeated_lines(docs, shipped=shipped).select("doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert sorted(got, key=repr) == plain_lines(rows)
    got = line_dedup.drop_repeated_lines(docs, least_chars=5, least_docs=2, shipped=shipped).select("doc_id", "n_lines", "n_dropped", "kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_lines(rows, 5, 2)


@pytest.mark.parametrize("shipped", [line_dedup.SHIPPED, 0])
def test_lines_of_odd_tables(spark, shipped):
    odd = spark.createDataFrame([("a", 1, "x" * 30, 5, "b"), ("a", 2, "x" * 30, 6, None), ("c", 3, "X" * 30, 7, "d")], "`a.b` string, doc_id long, text string, n_lines int, lost string")
    found = line_dedup.drop_repeated_lines(odd, shipped=shipped)
    assert found.columns == ["a.b", "doc_id", "text", "lost", "n_lines", "n_dropped", "kept"]
    assert sorted((r["doc_id"], r["n_dropped"], r["kept"], r["lost"]) for r in found.collect()) == [(1, 1, "", "b"), (2, 1, "", None), (3, 0, "X" * 30, "d")]
    assert line_dedup.drop_repeated_lines(odd.limit(0), shipped=shipped).collect() == []
    with pytest.raises(ValueError, match="two or more"):
        line_dedup.drop_repeated_lines(odd, least_docs=1)


def test_filters_know_all_they_were_given():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    bloom = line_dedup.Bloom(1 << 20)
    bloom.add(hashes)
    bits = bloom.folded()
    assert bloom.has(hashes).all() and len(bits) == 1 << 14
    small = line_dedup.Bloom(8 * len(bits))
    small.bytes = np.frombuffer(bits, np.uint8)
    assert small.has(hashes).all() and small.has(hashes + np.uint64(1)).mean() < 0.02
    parts = line_dedup.part_of(hashes, 16)
    assert set(parts) == set(range(16))
    assert line_dedup.Filters(16, []).has(hashes).sum() == 0


# --------------------------------------------------------------------- Merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Levels of a tree of three, and the siblings of each leaf by level: those before and after."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([digest(*row[i : i + 3]) for i in range(0, len(row), 3)])
    proofs = []
    for at in range(len(leaves)):
        proof = []
        for row in levels[:-1]:
            first = at - at % 3
            proof.append(("".join(row[first:at]), "".join(row[at + 1 : first + 3])))
            at //= 3
        proofs.append(proof)
    return levels[-1][0], proofs


def plain_manifest(rows):
    def leaf(row):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append(((row[0] is not None, row[0] or 0), leaf(row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:2])
        own[name] = plain_tree([x[1] for x in trees[name]])
    root, over = plain_tree([own[name][0] for name in names])
    found = []
    for name, above in zip(names, over, strict=True):
        for (_, digest_of, row), proof in zip(trees[name], own[name][1], strict=True):
            path = proof + above
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = (*row[:4], row[4].replace("\n", ""))
            folded = leaf(now)
            for left, right in path:
                folded = digest(left, folded, right)
            siblings = digest(*[x for step in path for x in step])
            found.append((row[0], digest_of, own[name][0], root, siblings, folded, folded == root))
    return sorted(found, key=repr)


def manifest_rows(sizes):
    rng = random.Random(8)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            i = rng.randrange(10**6)
            rows.append((i, source, rng.choice([None, "de", "é"]), rng.choice([None, i]), rng.choice([None, "", "a\nb", "ö\n" * 50, "plain"])))
    return rows


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {None: 1, "": 1}, {"a": 4}, {None: 3, "": 2, "a": 81, "é": 82, "z": 700}, {f"s{i}": 1 + i % 3 for i in range(100)}],
    ids=["one row", "two trees", "four rows", "aligned and not", "many trees"],
)
def test_proofs_equal_brute_force(spark, tmp_path, sizes):
    rows = manifest_rows(sizes)
    if len(rows) > 500:
        rows += [rows[0]] * 300 + [(None, "a", None, None, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.proofs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_manifest(rows)


def test_proofs_of_odd_tables(spark):
    odd = spark.createDataFrame([(1, "x", "own", 2, "p")], "id long, `the.key` string, digest string, at int, path string")
    found = merkle.manifest(odd, ["id", "digest", "at", "path"], "the.key", "id", {"was": F.col("path")})
    row = found.collect()[0]
    assert (row["id"], row["was"], row["proof"]) == (1, "p", [])
    assert row["leaf"] == row["subroot"] == row["root"] == digest("1:1", "3:own", "1:2", "1:p")
    assert merkle.manifest(odd.limit(0), ["id"], "the.key", "id").collect() == []


# ---------------------------------------------------------- token alignment


def plain_alignment(texts):
    byte_bpe, pieces = Tokenizer.from_file(SPEC), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    byte_bpe.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown}
    back |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def ranges(tokens):
        begins = np.cumsum([0] + [len(x) for _, x in tokens]).tolist()
        return [(i, s, s + len(x)) for (i, x), s in zip(tokens, begins, strict=False)]

    documents = []
    for text in texts:
        a = b = []
        if text:
            encoded = byte_bpe.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(back[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens, strict=True)]
            b = [(i, bytes([i - 3]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in pieces.encode(text)]
            if any(b"".join(t for _, t in side) != (" " + text).encode() for side in (a, b)):
                a = b = []
        documents.append((ranges(a), ranges(b)))
    links = [[(x, y) for x, s, e in a for y, t, f in b if s < f and t < e] for a, b in documents]
    counts = Counter(pair for own in links for pair in own)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    found = []
    for (a, b), own in zip(documents, links, strict=True):
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for begin, end in zip([0, *cuts], cuts, strict=False):
            inside = [",".join(str(i) for i, _, e in side if begin < e <= end) for side in (a, b)]
            groups.append("|".join(inside))
        text = ";".join(groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if a else ""
        n_best = sum(counts[p] == best[p[1]] for p in own)
        found.append((len(a), len(b), len(cuts), len(own), n_best, sum(counts[p] for p in own), sha, text))
    return found


def aligned_texts():
    rng = random.Random(4)
    odd = [None, "", " ", "  a", "a  b ", "\n", "a\n\n b\t", "▁", "x ▁ y", "<s> </s> <unk> <0x41>", "<|endoftext|> end", "é　ü  ß", "日本語 テスト 🙂 👩‍👩", "a\0b", "﻿x", "ﬁ ½"]
    words = ["the", "of", "Token", "naïve", "straße", "x.", "(y)", "don't", "1234", "日本", "it’s", "re-use", "\tq", "end\nnext"]
    texts = odd + [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]
    return texts + texts[-3:] + ["the " * 900, "w" * 3000]


WANTED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


def test_alignment_equals_brute_force(spark, monkeypatch):
    texts = aligned_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = token_alignment.align(docs, SPEC, MODEL)
    got = {r["doc_id"]: tuple(r[c] for c in WANTED) for r in found.collect()}
    for i, want in enumerate(plain_alignment(texts)):
        assert got[i] == want, texts[i]


def test_long_texts_are_encoded_by_stretches():
    text = " ".join(t for t in aligned_texts()[16:])
    parts = list(token_alignment.stretches(text, 50))
    assert " ".join(parts) == text and len(parts) > 50
    aligner = token_alignment.Aligner(open(SPEC).read(), open(MODEL, "rb").read())
    whole = token_alignment._documents(aligner, [text, ""], True)[0].result()
    document = token_alignment.Document(True)
    for part in parts:
        pieces = token_alignment.CUT.split(part)
        aligner.learn(pieces)
        document.add(aligner, pieces)
    result = document.result()
    assert (result[0] == whole[0]).all() and (result[1] == whole[1]).all() and result[2:] == whole[2:]
    assert list(whole[0]) == list(plain_alignment([text])[0][:4])


def test_alignment_of_odd_tables(spark):
    odd = spark.createDataFrame([("a", "x y", 1, "r"), ("b", "x y", 2, None)], "`a.b` string, text string, n_a int, run string")
    found = token_alignment.align(odd, SPEC, MODEL, groups=False)
    assert found.columns == ["a.b", "run", *WANTED[:-1]]
    assert sorted((r["a.b"], r["run"] or "", r["n_a"], r["count_sum"]) for r in found.collect()) == [("a", "r", 2, 4), ("b", "", 2, 4)]
    assert token_alignment.align(odd.limit(0), SPEC, MODEL).collect() == []


def test_runs_are_merged_in_order(monkeypatch):
    monkeypatch.setattr(token_alignment, "FRAME", 7)
    rng = random.Random(6)
    runs, want = [], Counter()
    for _ in range(9):
        own = Counter(rng.randrange(60) for _ in range(rng.randint(0, 80)))
        want.update(own)
        keys = np.array(sorted(own), np.uint64)
        runs.append(token_alignment.pack(keys, np.array([own[int(k)] for k in keys], np.uint64)))
    parts = list(token_alignment.merged([token_alignment.pairs_of(r, 0) for r in runs]))
    keys, counts = np.concatenate(parts, axis=1).tolist()
    assert keys == sorted(want) and dict(zip(keys, counts, strict=True)) == want
    # Ids of two bits each: the highest count of each B id, however the parts fall.
    marked = np.concatenate(list(token_alignment.with_best(parts, 2)), axis=1).tolist()
    best = {b: max(n for k, n in want.items() if k >> 2 == b) for b in {k >> 2 for k in want}}
    assert marked[0] == keys and marked[2] == [int(want[k] == best[k >> 2]) for k in keys]


def test_totals_that_are_too_large_to_hold_are_merged_early(spark, monkeypatch):
    texts = aligned_texts() * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = {r["doc_id"]: tuple(r[c] for c in WANTED[:-1]) for r in token_alignment.align(docs, SPEC, MODEL, groups=False).collect()}
    monkeypatch.setattr(token_alignment, "MERGED", 1)
    monkeypatch.setattr(token_alignment, "SALTED", 1 << 8)
    got = {r["doc_id"]: tuple(r[c] for c in WANTED[:-1]) for r in token_alignment.align(docs, SPEC, MODEL, groups=False).collect()}
    assert got == want

"""The operators as queries over whole tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    compression,
    decontaminate,
    html_text,
    language,
    line_dedup,
    merkle,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    token_alignment,
    warc,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_policy(quality_rules.ledger(docs))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.ablations(quality_rules.ledger(docs))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_and_decode(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        ("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(docs, items)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shuffle_into_shards(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.drop_repeated_lines(docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, checked against rows of which half have lost their line ends."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = [F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")) if c == "text" else F.col(c) for c in fields]
    found = merkle.manifest(docs, fields, "source", "doc_id", {"now": merkle.leaf_digest(now)})
    folded = merkle.fold(F.col("now"), F.col("proof"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabularies = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align(docs, *vocabularies, groups=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality,
        "op2_warc": archives,
        "op3_byte_bpe": tokens,
        "op4_simhash": near_duplicates,
        "op5_suffix_dedup": repeats,
        "op6_decontamination": contamination,
        "op7_language": languages,
        "op8_compression_quality": quality_scores,
        "op9_html_text": page_texts,
        "op10_sharding": shards,
        "op11_line_dedup": repeated_lines,
        "op12_merkle_manifest": proofs,
        "op13_token_alignment": alignment,
        "quality_ablations": quality_ablations,
    }


LEDGER_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)
), repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows)
    WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, i + unnest(range(0, 5)) AS place FROM repeated) GROUP BY doc_id
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(regexp_extract_all(text, '\p{Lu}')) AS BIGINT) AS n_upper
    FROM words LEFT JOIN covered USING (doc_id)
), ledger AS (
    SELECT *, CAST(if(n_words < 10, 1, 0) + if(100 * n_repeat_words > 20 * n_words, 2, 0)
        + if(10 * n_symbols > 3 * n_words, 4, 0) + if(10 * n_dup_lines > 5 * n_lines, 8, 0)
        + if(10 * n_upper > 6 * word_chars, 16, 0) + if(word_chars > 30 * n_words, 32, 0) AS BIGINT) AS failed
    FROM measured
)"""

CONTAINMENT_SQL = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL
), items AS (
    SELECT item_id, w, least(5, len(w)) AS width FROM (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL)
), item_shingles AS (
    SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM items WHERE width > 0)
), doc_shingles AS (
    SELECT DISTINCT doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS g
    FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
          FROM docs CROSS JOIN (SELECT DISTINCT width FROM items WHERE width > 0))
), sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM (SELECT doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (width, g)
      GROUP BY doc_id, item_id) JOIN sizes USING (item_id)
WHERE 10 * n_shared >= 8 * n_item"""

LINES_SQL = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, i, parts[i] AS line,
           translate(regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM split)
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS dropped
    FROM lines LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

# crc32 modulo 2 by its definition: a bit of the decimal id at a time, lowest first.
MERKLE_SQL = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, source, text,
           concat(coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
                  coalesce(octet_length(encode(source)) || ':' || source, '-'),
                  coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                  coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
           list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                   lambda d: list_transform(range(0, 8), lambda k: (ascii(d) >> k) % 2))),
               lambda crc, b: xor(crc >> 1, if(xor(crc, b) % 2 = 1, 3988292384, 0))) % 2 AS odd
    FROM documents
), leaves AS (
    SELECT doc_id, coalesce('=' || source, '-') AS tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(if(odd = 1, octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''),
                                      octet_length(encode(text)) || ':' || text), '-')) AS now
    FROM fields
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, pos, leaf AS h, n FROM ranked
    UNION ALL
    SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
    FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3
), subroots AS (
    SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS level, pos, subroot AS h, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, pos // 3
), steps AS (
    SELECT r.tree, r.pos, n.level, n.pos AS sibling, n.h, n.pos < r.pos // CAST(3 ** n.level AS BIGINT) AS before
    FROM ranked r JOIN nodes n ON n.tree = r.tree AND n.n > 1 AND n.pos // 3 = r.pos // CAST(3 ** (n.level + 1) AS BIGINT)
         AND n.pos <> r.pos // CAST(3 ** n.level AS BIGINT)
    UNION ALL
    SELECT r.tree, r.pos, s.height + t.level, t.pos, t.h, t.pos < s.pos // CAST(3 ** t.level AS BIGINT)
    FROM ranked r JOIN subroots s USING (tree) JOIN tops t ON t.n > 1 AND t.pos // 3 = s.pos // CAST(3 ** (t.level + 1) AS BIGINT)
         AND t.pos <> s.pos // CAST(3 ** t.level AS BIGINT)
), proofs AS (SELECT tree, pos, sha256(string_agg(h, '' ORDER BY level, sibling)) AS proof_sha256 FROM steps GROUP BY tree, pos),
sides AS (
    SELECT tree, pos, level, coalesce(string_agg(h, '' ORDER BY sibling) FILTER (WHERE before), '') AS l,
           coalesce(string_agg(h, '' ORDER BY sibling) FILTER (WHERE NOT before), '') AS r
    FROM steps GROUP BY tree, pos, level
), heights AS (SELECT tree, height + (SELECT max(level) FROM tops) AS height FROM subroots),
folds AS (
    SELECT tree, pos, 0 AS level, now AS h FROM ranked
    UNION ALL
    SELECT f.tree, f.pos, f.level + 1, sha256(coalesce(s.l, '') || f.h || coalesce(s.r, ''))
    FROM folds f JOIN heights g ON g.tree = f.tree AND f.level < g.height
         LEFT JOIN sides s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level
)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM ranked JOIN subroots USING (tree) JOIN heights USING (tree) CROSS JOIN (SELECT h AS root FROM tops WHERE n = 1)
     JOIN folds f ON f.tree = ranked.tree AND f.pos = ranked.pos AND f.level = heights.height
     LEFT JOIN proofs p ON p.tree = ranked.tree AND p.pos = ranked.pos"""

ARCHIVE_SQL = r"""
WITH bits AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
    FROM pages
), groups AS (SELECT hex, max(page_id) AS largest FROM bits GROUP BY hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST(concat('0x', substr(hex, 1 + (k // 8) * 10, 10)) AS BIGINT)
               >> CAST(35 - 5 * (k % 8) AS BIGINT)) % 32, 1)), '') AS payload_digest,
       if(page_id = largest, 'response', 'revisit') AS record_type,
       CAST(if(page_id = largest, NULL, largest) AS BIGINT) AS refers_to
FROM bits JOIN groups USING (hex)"""


def oracle_sql() -> dict[str, str]:
    base = "failed & 3 <> 0 AS base_failed, failed & 63 = 0 AS kept"
    names = [rule.name for rule in quality_rules.RULES]
    ablations = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE failed & {1 << k} <> 0) AS n_failed,"
        f" count(*) FILTER (WHERE failed = {1 << k}) AS n_only,"
        f" count(*) FILTER (WHERE failed & {63 & ~(1 << k)} = 0) AS n_kept_without FROM ledger"
        for k, name in enumerate(names)
    )
    return {
        "op1_quality_rules": f"{LEDGER_SQL} SELECT *, {base} FROM ledger",
        "op2_warc": ARCHIVE_SQL,
        "op6_decontamination": CONTAINMENT_SQL,
        "op11_line_dedup": LINES_SQL,
        "op12_merkle_manifest": MERKLE_SQL,
        "quality_ablations": f"{LEDGER_SQL} {ablations}",
    }

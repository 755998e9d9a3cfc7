"""Rule bitmask ledger: every rule is evaluated once per document; its failures are the bits of
one number, kept beside the measurements. Policies are versioned masks over those bits, and
ablations are sums over the few distinct bit patterns, so neither reads a text again.

Built-in functions only; no shuffle but the one of the pattern counts.

Defined cases: a null text has no words, a text without words fails the word-count rule, rows
with the same id are judged one by one, an empty table gives an empty ledger, input columns of
the ledger's names are replaced by the ledger's. Two different five-word windows count as one only
if their 64-bit hashes collide within one document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.llm.common import let

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MEASUREMENTS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_lines": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "n_upper": "long",
}


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails`` holds of the measurements."""

    name: str
    fails: Callable[[Callable[[str], Column]], Column]


#: The position of a rule is its bit. Add at the end only: stored ledgers keep their meaning.
RULES = (
    Rule("too_few_words", lambda m: m("n_words") < 10),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("duplicate_lines", lambda m: 10 * m("n_dup_lines") > 5 * m("n_lines")),
    Rule("shouting", lambda m: 10 * m("n_upper") > 6 * m("word_chars")),
    Rule("long_words", lambda m: m("word_chars") > 30 * m("n_words")),
)
BASE = ("too_few_words", "repeated_windows")
#: Versioned policies: the rules that reject a document.
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "duplicate_lines", "shouting", "long_words"),
}
CURRENT_POLICY = 2


def mask_of(names: tuple[str, ...]) -> int:
    known = [rule.name for rule in RULES]
    return sum(1 << known.index(name) for name in names)


def _words(text: Column) -> Column:
    return let(
        F.btrim(text, F.lit(WHITE)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(
            F.split(t, "[ \\x09-\\x0D]+")
        ),
    )


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs twice: neighbours in sorted order tell which."""
    def starts(ordered: Column) -> Column:
        same = lambda e, j: (e["h"] == F.get(ordered, j - 1)["h"]) | (
            e["h"] == F.get(ordered, j + 1)["h"]
        )
        found = F.transform(ordered, lambda e, j: F.when(same(e, j), e["i"]))
        return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

    def words(begins: Column) -> Column:
        gaps = F.transform(
            begins,
            lambda s, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(begins, j + 1) - s, F.lit(WINDOW))
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(F.sort_array(numbered), lambda ordered: let(starts(ordered), words))


def _repeat_words(words: Column) -> Column:
    """Words in five-word windows that the text has twice or more."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = lambda h: F.transform(
        F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(WINDOW)]),
    )
    count = lambda v: F.when(
        F.size(F.array_distinct(v)) == F.size(v), F.lit(0)
    ).otherwise(_covered(v))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(hashed, lambda h: let(windows(h), count))
    )


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")


def measured(text: Column) -> Column:
    """All measurements of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    of_words = let(
        _words(text),
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        _lines(text),
        lambda x: F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        ),
    )
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
        F.length(F.regexp_replace(text, "\\P{Lu}+", "")).alias("n_upper"),
    )


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the measurements and ``failed``, a bit per failed rule."""
    found = {
        "n_words": "words.n_words",
        "word_chars": "words.word_chars",
        "n_repeat_words": "words.n_repeat_words",
        "n_lines": "lines.n_lines",
        "n_dup_lines": "lines.n_dup_lines",
        "n_symbols": "n_symbols",
        "n_upper": "n_upper",
    }
    own = {*MEASUREMENTS, "failed"}
    kept = [named(c) for c in docs.columns if c != text and c.lower() not in own]
    rows = docs.select(*kept, measured(named(text)).alias("failed"))
    rows = rows.select(
        *[named(c) for c in rows.columns if c != "failed"],
        *[F.col(f"failed.{path}").cast(MEASUREMENTS[m]).alias(m) for m, path in found.items()],
    )
    bits = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES):
        bits = bits + F.when(rule.fails(F.col), F.lit(1 << bit)).otherwise(F.lit(0))
    return rows.withColumn("failed", bits)


def apply_policy(judged: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    fails = lambda names: F.col("failed").bitwiseAND(F.lit(mask_of(names))) != 0
    return judged.withColumns({"base_failed": fails(BASE), "kept": ~fails(POLICIES[version])})


def ablations(judged: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """For each rule of a policy: documents it fails, documents only it fails, and documents
    kept by the policy without it. From the counts of the distinct bit patterns."""
    patterns = judged.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    whole = mask_of(POLICIES[version])
    measures = []
    for name in POLICIES[version]:
        own = mask_of((name,))
        counted = lambda mask, value: F.coalesce(
            F.sum(F.when(F.col("failed").bitwiseAND(F.lit(mask)) == value, F.col("n"))), F.lit(0)
        )
        measures.append(
            F.struct(
                F.lit(name).alias("rule"),
                counted(own, own).alias("n_failed"),
                counted(whole, own).alias("n_only"),
                counted(whole & ~own, 0).alias("n_kept_without"),
            )
        )
    return patterns.agg(F.array(*measures).alias("rules")).select(F.inline("rules"))


def keep_good(docs: DataFrame, version: int = CURRENT_POLICY, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    whole = F.struct(*map(named, docs.columns)).alias("row")
    judged = ledger(docs.select(whole, F.col(text).alias("text")))
    return apply_policy(judged, version).filter("kept").select("row.*")

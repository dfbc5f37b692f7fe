"""Quality rules as a ledger: each rule is measured once, its failures are bits, policies and ablations come after."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .frames import batch, chosen
from .text import SpanHash, Texts, shingles_of, texts_of, words_of

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_stutters")
LEDGER = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(m, pa.int64()) for m in MEASURES]])


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measures; it is never null, as no measure is."""

    name: str
    bit: int
    fails: str


#: Bits are never used again for another rule, so stored ledgers stay readable.
RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", 2, "100 * n_symbols > 30 * n_words"),
    Rule("repeated_lines", 3, "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
    Rule("shouting", 6, "100 * n_shouts > 40 * n_words"),
    Rule("stuttering", 7, "100 * n_stutters > 30 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules; a document that fails one of them is rejected."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, tuple(r.name for r in RULES))


def measures_of(texts: Texts) -> tuple[np.ndarray, ...]:
    """The measures of each text, in the order of ``MEASURES``."""
    data, spans = texts.data, SpanHash(texts.data)
    words = words_of(texts, lower=False, hashes=spans)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    chars = texts.inside(inside & ((data & 0xC0) != 0x80))
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS.encode())] = True

    # A window found before or again covers its words.
    value, owner, first = shingles_of(words, WINDOW, short=False)
    order = np.lexsort((value, owner))
    same = (value[order][1:] == value[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(words.starts) + WINDOW + 1, np.int64)
    np.add.at(cover, first[order[twice]], 1)
    np.add.at(cover, first[order[twice]] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[: len(words.starts)] > 0)])

    # A line is a run of bytes without a line end, and counts if it holds a word.
    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.union1d(breaks + 1, texts.offsets[:-1])
    line_starts = line_starts[line_starts < len(data)]
    owner = np.searchsorted(texts.offsets, line_starts, "right") - 1
    line_ends = np.append(breaks, len(data))[np.searchsorted(breaks, line_starts)]
    line_ends = np.minimum(line_ends, texts.offsets[owner + 1])
    has_word = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends, owner = line_starts[has_word], line_ends[has_word], owner[has_word]
    lines = np.bincount(owner, minlength=len(texts.rows))
    value = spans(line_starts, line_ends)
    order = np.lexsort((value, owner))
    again = np.concatenate([[False], (value[order][1:] == value[order][:-1]) & (owner[order][1:] == owner[order][:-1])])[: len(order)]
    dup_lines = np.bincount(owner[order[again]], minlength=len(texts.rows))

    shouts = np.bincount(words.owners(), weights=data[words.ends - 1] == 0x21, minlength=len(texts.rows)).astype(np.int64)
    after = (words.hashes[1:] == words.hashes[:-1]) & (np.diff(words.owners()) == 0)
    stutters = np.diff(np.searchsorted(np.flatnonzero(after) + 1, words.firsts))
    repeats = covered[words.firsts[1:]] - covered[words.firsts[:-1]]
    return words.counts, chars, texts.inside(symbols[data]), dup_lines, repeats, lines, shouts, stutters


def failed_bits() -> Column:
    return F.expr(" + ".join(f"IF({r.fails}, {1 << r.bit}L, 0L)" for r in RULES))


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its measures, and ``failed``, the bits of the rules that it fails.

    One pass over the texts in Arrow batches, no shuffle. A null text has no word. A
    null ``doc_id`` and repeated rows come out as they are; an empty table gives none.
    """

    def run(batches):
        for rows in batches:
            for texts in texts_of(rows["text"]):
                yield batch(_SCHEMA, rows["doc_id"].take(pa.array(texts.rows)), *measures_of(texts))

    return chosen(docs, doc_id=doc_id, text=text).mapInArrow(run, LEDGER).withColumn("failed", failed_bits())


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablation(stored: DataFrame, policies: Mapping[str, Policy]) -> DataFrame:
    """For each policy and each of its rules: documents that fail the rule, and those that fail no other one.

    The documents are first counted by their bits, at most 2**rules rows, so no text and no
    document is looked at again.
    """
    counts = stored.groupBy("failed").agg(F.count("*").alias("__n"))
    parts = []
    for label, policy in policies.items():
        masked = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("bigint"))
        for rule in (r for r in RULES if r.name in policy.rules):
            bit = F.lit(1 << rule.bit).cast("bigint")
            parts.append(F.struct(
                F.lit(label).alias("policy"), F.lit(policy.version).alias("version"), F.lit(rule.name).alias("rule"),
                (masked.bitwiseAND(bit) != 0).alias("fails"), (masked == bit).alias("alone"),
            ))
    rows = counts.select("__n", F.explode(F.array(*parts)).alias("__r")).select("__n", "__r.*")
    total = lambda c: F.sum(F.when(F.col(c), F.col("__n")).otherwise(0))
    return rows.groupBy("policy", "version", "rule").agg(total("fails").alias("failing"), total("alone").alias("failing_alone"))


def keep(docs: DataFrame, policy: Policy = STRICT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the policy accepts: the measures are taken beside each row, without a join.

    A null or empty text has no words, so a policy with a least number of words drops it. Null ids and repeated rows
    are judged one by one. An empty table gives none.
    """
    names = [f"__c{i}" for i in range(len(docs.columns))]
    columns = docs.columns
    flat = docs.toDF(*names)
    schema = StructType([*flat.schema, StructField("__failed_measures", ArrayType(LongType()))])
    at_text = columns.index(text)

    def run(batches):
        for rows in batches:
            parts = [np.column_stack(measures_of(t)) for t in texts_of(rows.column(at_text))]
            found = np.concatenate(parts) if parts else np.zeros((0, len(MEASURES)), np.int64)
            offsets = np.arange(len(found) + 1) * len(MEASURES)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found.ravel().astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "__failed_measures"])

    measured = flat.mapInArrow(run, schema)
    measured = measured.select(*names, *[F.col("__failed_measures")[i].alias(m) for i, m in enumerate(MEASURES)])
    return measured.withColumn("__failed", failed_bits()).where(passes(policy, "__failed")).select(*names).toDF(*columns)


def sql(table: str = "documents") -> str:
    """The ledger, its base verdict and the strict one, in DuckDB's SQL."""
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in RULES)
    word, spaces = r"[^\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {table}),
listed AS (SELECT r, regexp_extract_all(text, '{word}') AS w FROM docs),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM listed),
runs AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS run
         FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM listed)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS i FROM twice) GROUP BY r),
lines AS (SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
          WHERE regexp_matches(line, '{spaces}')),
line_counts AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
word_counts AS (
    SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(CASE WHEN word LIKE '%!' THEN 1 ELSE 0 END) AS n_shouts,
           sum(CASE WHEN word = before THEN 1 ELSE 0 END) AS n_stutters
    FROM (SELECT r, word, lag(word) OVER (PARTITION BY r ORDER BY i) AS before FROM words) GROUP BY r
),
measures AS (
    SELECT d.doc_id, coalesce(w.n_words, 0) AS n_words, coalesce(w.word_chars, 0)::BIGINT AS word_chars,
           length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
           coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines,
           coalesce(w.n_shouts, 0)::BIGINT AS n_shouts, coalesce(w.n_stutters, 0)::BIGINT AS n_stutters
    FROM docs d LEFT JOIN word_counts w USING (r) LEFT JOIN line_counts l USING (r) LEFT JOIN covered c USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       ({bits}) = 0 AS kept, CAST({bits} AS BIGINT) AS failed
FROM measures"""

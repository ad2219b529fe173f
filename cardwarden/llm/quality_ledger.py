"""Quality rules as a ledger: every rule is evaluated once and leaves one bit and its figures.

``measure`` reads the text once and yields the measurements. ``ledger`` turns them into one
``failures`` number per document, bit *i* for rule *i*. Policies are versioned masks over
those bits: applying another version, or asking what a rule alone removes, reads the ledger
and never the text again.

Nulls and empty texts measure zero everywhere and fail ``few_words``. Repeated rows are
judged each on its own. Columns of the input other than ``id_column`` and ``text`` are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import SPACE_CLASS, WORD_CLASS, let, table, word_array

WINDOW = 8

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_marks",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
)


@dataclass(frozen=True)
class Rule:
    """A condition over the measurements under which a document fails."""

    name: str
    fails: str
    base: bool = False


# A rule keeps its place, which is its bit; new rules go to the end.
RULES = (
    Rule("few_words", "n_words < 20", base=True),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words", base=True),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("exclamation", "5 * n_marks > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 and 10 * n_dup_lines > 5 * n_lines"),
)

# Versions of the policy: the rules that count. A published version never changes.
POLICIES: Mapping[str, Sequence[str]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(rule.name for rule in RULES),
}
CURRENT = "v1"


def measure(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id and the measurements, all long."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD_CLASS)))
    spaces = F.regexp_count(text, F.lit(SPACE_CLASS))

    def line_counts(held: Column) -> Column:
        return F.struct(
            F.size(held).alias("n_lines"),
            (F.size(held) - F.size(F.array_distinct(held))).alias("n_dup_lines"),
        )

    def word_counts(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"), _repeated_words(words).alias("n_repeat_words")
        )

    measured = docs.select(
        F.col(id_column),
        (F.char_length(text) - spaces).alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(text, F.lit("!")).alias("n_marks"),
        let(lines, line_counts).alias("by_line"),
        let(word_array(text), word_counts).alias("by_word"),
    )
    return measured.select(id_column, "word_chars", "n_symbols", "n_marks", "by_line.*", "by_word.*").select(
        id_column, *(F.col(name).cast("long").alias(name) for name in MEASURES)
    )


def _repeated_words(words: Column) -> Column:
    """Words inside an 8-word window that the text holds at least twice.

    A window is its 64-bit hash, built by doubling from the hashes of its words. Only a text
    with two equal hashes pays for sorting them with their places.
    """

    def doubled(hashes: Column, step: int) -> Column:
        rest = F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0)))
        return F.zip_with(hashes, rest, lambda a, b: F.xxhash64(a, b))

    def windows(by_word: Column) -> Column:
        full = F.size(by_word) - (WINDOW - 1)
        eights = let(
            by_word,
            lambda one: let(
                doubled(one, 1), lambda two: let(doubled(two, 2), lambda four: doubled(four, 4))
            ),
        )
        return F.slice(eights, F.lit(1), full)

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(
            F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
        )

        def twice(rows: Column) -> Column:
            def equals(other: Column, row: Column) -> Column:
                return F.coalesce(F.get(rows, other)["h"] == row["h"], F.lit(False))

            kept = F.filter(rows, lambda row, i: equals(i - 1, row) | equals(i + 1, row))
            return F.sort_array(F.transform(kept, lambda row: row["at"]))

        def gaps(places: Column) -> Column:
            following = F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0)))
            return F.aggregate(
                F.zip_with(places, following, lambda a, b: F.least(b - a, F.lit(WINDOW))),
                F.lit(0),
                lambda total, gap: total + F.coalesce(gap, F.lit(WINDOW)),
            )

        return let(let(placed, twice), gaps)

    def judged(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            covered(hashes)
        )

    hashed = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(let(hashed, windows), judged)
    )


def mask(rules: Sequence[str]) -> int:
    """The bits of the named rules."""
    places = {rule.name: at for at, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in set(rules))


def ledger(measured: DataFrame) -> DataFrame:
    """The measurements with ``failures``: every rule evaluated once, one bit each."""
    bits = [
        F.when(F.expr(rule.fails), F.lit(1 << at)).otherwise(F.lit(0)).cast("long")
        for at, rule in enumerate(RULES)
    ]
    return measured.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def apply_policy(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with ``policy`` and ``kept``: no rule of that version fails."""
    counted = F.col("failures").bitwiseAND(F.lit(mask(POLICIES[version])))
    return entries.withColumns({"policy": F.lit(version), "kept": counted == 0})


def ablations(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, and those that it alone removes.

    The ledger shrinks to one row per combination of failed rules before anything else, so
    its size is bounded by the rules and not by the documents.
    """
    chosen = mask(POLICIES[version])
    combinations = (
        entries.select(F.col("failures").bitwiseAND(F.lit(chosen)).alias("failures"))
        .groupBy("failures")
        .agg(F.count("*").alias("documents"))
    )
    rules = F.explode(
        F.array(
            *(
                F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << at).cast("long").alias("bit"))
                for at, rule in enumerate(RULES)
                if chosen & (1 << at)
            )
        )
    ).alias("r")
    failing = combinations.select("failures", "documents", rules).where(
        F.col("failures").bitwiseAND(F.col("r.bit")) != 0
    )
    alone = F.when(F.bit_count("failures") == 1, F.col("documents")).otherwise(0)
    return failing.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum("documents").alias("failing"), F.sum(alone).alias("only_this_rule")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_policy(ledger(measure(table(spark, sf_dir, "documents"))))
    base = F.col("failures").bitwiseAND(F.lit(mask([r.name for r in RULES if r.base]))) != 0
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (F.col("kept") & ~base).alias("kept"),
        "failures",
    )


_FAILURES = " | ".join(
    f"(CASE WHEN {rule.fails} THEN {1 << at} ELSE 0 END)" for at, rule in enumerate(RULES)
)
_BASE = mask([rule.name for rule in RULES if rule.base])

OP10_SQL = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT r, doc_id, text,
           regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(text, chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), word AS (
    SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS p FROM split
), windows AS (
    SELECT r, p,
           w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o
           || ' ' || lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o || ' ' || lead(w, 6) OVER o
           || ' ' || lead(w, 7) OVER o AS g
    FROM word WINDOW o AS (PARTITION BY r ORDER BY p)
), repeated AS (
    SELECT r, p FROM windows WHERE g IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
    SELECT r, count(DISTINCT p + k) AS n_repeat_words
    FROM repeated, (SELECT unnest(range(8)) AS k) GROUP BY r
), measured AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_marks,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split LEFT JOIN covered USING (r)
), judged AS (
    SELECT *, CAST({_FAILURES} AS BIGINT) AS failures FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & {_BASE} <> 0 AS base_failed,
       failures & {mask(POLICIES[CURRENT])} = 0 AS kept,
       failures
FROM judged
"""

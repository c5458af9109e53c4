"""Quality rules as a bitmask ledger.

``ledger`` measures every document and evaluates every rule once: one bit per
failed rule, next to the measurements. Policies are versioned sets of rules,
that is masks over those bits; applying one, comparing several and asking what
each rule costs never touches the texts again.

Null or empty texts have no words and fail ``few_words``. Repeated rows are
rows of their own. Extra columns are kept only by ``ledger(keep=...)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import WHITESPACE, bound, text_of, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
]


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: str  # SQL over the measurements


#: Bits are part of the stored format: never reuse one.
RULES = [
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 15 * n_words"),
]
BITS = {rule.name: 1 << rule.bit for rule in RULES}
BASE = BITS["few_words"] | BITS["repeated_windows"]

#: Policy versions; a version never changes once it has been used.
POLICIES: dict[int, int] = {
    1: BASE,
    2: BASE | BITS["symbols"] | BITS["repeated_lines"],
    3: sum(BITS.values()),
}
CURRENT_POLICY = 3


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeat_words(words: Column) -> Column:
    """Words covered by 8-word windows that occur at least twice.

    Windows are compared by hash within one document. Texts without a repeated
    window, nearly all, stop after the distinct test.
    """
    n = F.size(words)

    def covered(windows: Column) -> Column:
        in_order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            last = F.size(s) - 1
            flagged = F.filter(
                s,
                lambda e, j: ((j > 0) & (F.get(s, j - 1)["h"] == e["h"]))
                | ((j < last) & (F.get(s, j + 1)["h"] == e["h"])),
            )
            return F.array_sort(F.transform(flagged, lambda e: e["i"]))

        def length(places: Column) -> Column:
            gaps = F.transform(
                places,
                lambda p, j: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))
                ),
            )
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        return F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
        ).otherwise(bound(bound(in_order, repeated), length))

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), n - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)),
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n < WINDOW + 1, F.lit(0).cast("long")).otherwise(
        bound(bound(hashes, windows), covered)
    )


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and the measurements, as long."""
    text = F.col("_text")
    lines = F.col("_lines")
    split = docs.select(*keep, text_of().alias("_text")).select(
        *keep,
        "_text",
        words_of(text).alias("_words"),
        F.filter(
            F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITESPACE))) > 0
        ).alias("_lines"),
    )
    return split.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        _length_without(text, WHITESPACE).cast("long").alias("word_chars"),
        (F.length(text) - _length_without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, keep: list[str] | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: kept columns, measurements, ``failed`` bits (long)."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.expr(f"IF({rule.fails}, {1 << rule.bit}L, 0L)"))
    return measured(docs, keep or ["doc_id"]).withColumn("failed", bits)


def verdict(mask: int) -> Column:
    """Whether a ledger row passes the rules of a mask."""
    return F.col("failed").bitwiseAND(F.lit(mask).cast("long")) == 0


def judge(entries: DataFrame, policies: dict[int, int] = POLICIES) -> DataFrame:
    """Ledger rows with one boolean ``kept_v<version>`` per policy."""
    return entries.withColumns({f"kept_v{v}": verdict(m) for v, m in policies.items()})


def ablation(entries: DataFrame, mask: int, rules: list[Rule] = RULES) -> DataFrame:
    """What each rule of a policy costs.

    Per rule: documents that fail it, and documents that fail nothing else of
    the policy, so would come back without the rule. The ledger is first counted
    by bit pattern, at most 2 ** len(rules) rows whatever the corpus.
    """
    patterns = entries.groupBy(
        F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits")
    ).agg(F.count(F.lit(1)).alias("n"))
    asked = [r for r in rules if mask & (1 << r.bit)]
    per_rule = F.explode(
        F.array(
            *(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in asked)
        )
    )
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        patterns.select("bits", "n", per_rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(
                F.sum(F.when(hit & (F.bit_count("bits") == 1), F.col("n"))), F.lit(0)
            ).alias("n_only"),
        )
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """The ledger with the base verdict and that of the current policy."""
    return ledger(docs).withColumns(
        {"base_failed": ~verdict(BASE), "kept": verdict(POLICIES[CURRENT_POLICY])}
    )


ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM docs)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT r, sum(n) AS n FROM (
    SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS n FROM repeated)
  GROUP BY r),
measured AS (
  SELECT docs.r, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN covered ON covered.r = docs.r),
rules AS (
  SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM measured),
bits AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END) AS failed
  FROM rules)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_lines::BIGINT AS n_lines, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, failed::BIGINT AS failed,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept
FROM bits
"""

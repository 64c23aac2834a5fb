"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one ``bigint`` in which bit i is set when rule i fails. A policy is a named
version of a bit mask: a document is kept under it when ``fail_bits & mask`` is
zero, so a new policy, or an ablation ("what if rule i were dropped"), reads
the ledger and never the texts.

Defined results: a null or empty text measures 0 everywhere and fails the
short-text rule; ties and repeated rows are separate ledger rows; an empty
table gives an empty ledger and no ablation rows. Columns of the input other
than the text are carried on as they are, unless they have the name of a
ledger column, which then holds the ledger's value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SPACED_WORD, covered, let, whole, window_hashes, words_of

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    window: int = 8
    max_repeat_pct: int = 30
    max_symbol_pct: int = 10      # symbols per 100 words
    min_word_chars: int = 2       # mean characters of a word, at least
    max_word_chars: int = 20      # ... and at most
    max_dup_lines_pct: int = 40   # repeated lines per 100 lines that have a word


RULES = ["short", "repeated_words", "symbols", "word_length", "repeated_lines"]
BIT = {name: 1 << i for i, name in enumerate(RULES)}
POLICIES = {
    "base": BIT["short"] | BIT["repeated_words"],
    "v1": BIT["short"] | BIT["repeated_words"] | BIT["symbols"] | BIT["word_length"] | BIT["repeated_lines"],
}


def _repeat_words(words: Column, hashes: Column, width: int) -> Column:
    """Words inside windows that occur twice or more in the text, the first occurrence included.

    Only a text that has equal windows sorts (hash, position) pairs; equal
    neighbours give the repeated positions, whose union is then measured.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(p: Column) -> Column:
        again = F.filter(p, lambda x, k: (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    positions = let(pairs, repeated)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(positions, width)).otherwise(
        F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The input with one measurement column per entry of MEASURES and ``n_lines``."""
    t = whole(F.col(text))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(SPACED_WORD))
    kept = [F.col(c) for c in docs.columns if c not in {*MEASURES, "n_lines"}]
    inner = docs.select(*kept, words_of(t, SPACED_WORD).alias("__words"), lines.alias("__lines"),
                        F.char_length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    inner = inner.withColumn("__hashes", window_hashes(F.col("__words"), limits.window))
    return inner.select(
        *kept, F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("__words"), F.col("__hashes"), limits.window).alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"))


def fail_bits(limits: Limits = Limits()) -> Column:
    n, c = F.col("n_words"), F.col("word_chars")
    fails = {
        "short": n < limits.min_words,
        "repeated_words": F.col("n_repeat_words") * 100 > n * limits.max_repeat_pct,
        "symbols": F.col("n_symbols") * 100 > n * limits.max_symbol_pct,
        "word_length": (c < n * limits.min_word_chars) | (c > n * limits.max_word_chars),
        "repeated_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * limits.max_dup_lines_pct,
    }
    bits = F.lit(0).cast("long")
    for name in RULES:
        bits = bits.bitwiseOR(F.when(fails[name], F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Measurements and ``fail_bits`` of every row; each rule is evaluated once."""
    return measure(docs, text, limits).withColumn("fail_bits", fail_bits(limits))


def verdict(policy: str, bits: str = "fail_bits") -> Column:
    """True when none of the policy's rules failed."""
    return F.col(bits).bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """One row per rule of the policy: documents it fails, fails alone (kept if dropped), and the bits seen.

    One pass of partial aggregates over the ledger's bits; texts aren't read.
    """
    mask = POLICIES[policy]
    used = [r for r in RULES if BIT[r] & mask]
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    by_bits = rows.groupBy(failed.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in used]))
    return (by_bits.select("bits", "n", rule.alias("r"))
            .groupBy(F.col("r.rule").alias("rule"), F.col("r.bit").alias("bit"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
                 F.bit_or(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("bits"))
                          .otherwise(F.lit(0).cast("long"))).alias("fails_with")))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    from .text import read_table

    rows = ledger(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *MEASURES, (~verdict("base")).alias("base_failed"), verdict("v1").alias("kept"),
                       "fail_bits", "n_lines")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (
  SELECT rid, i, array_to_string(w[i:i+7], chr(10)) AS k
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM s WHERE len(w) >= 8)
), r AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g) WHERE c > 1
), p AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(generate_series(i, i + 7)) AS j FROM r) GROUP BY rid
), m AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines
  FROM s LEFT JOIN p USING (rid)
), f AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 8 ELSE 0 END
           + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 16 ELSE 0 END) AS b FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (b % 4) <> 0 AS base_failed, b = 0 AS kept, CAST(b AS BIGINT) AS fail_bits, n_lines
FROM f
"""

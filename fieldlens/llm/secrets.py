"""Secret scans: fixed patterns plus character Markov models of random strings and ordinary identifiers.

Two first-order character models are trained from labelled samples (label 1:
random strings, 0: ordinary words): smoothed transition counts over a fixed
alphabet of K characters and one class for all others. A candidate run of
letters and digits is a secret when the mean log-likelihood ratio per
transition, random over ordinary, exceeds a threshold. The model is a table of
(K + 1)^2 numbers, whatever the input.

Everything works inside the row: places of matches come from the pieces between
them, so no text is shuffled. Spans are (kind, start, end) in code points, end
exclusive, sorted by start and then by kind in the order of ``KINDS``. A Markov
span is reported only where no pattern's span overlaps it.

Defined results: a null or empty text has no span; repeated rows are separate
rows; without samples of a label its model is uniform; an empty table gives an
empty result; other columns are kept by ``scan`` unless named ``spans``.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let, read_table, running, whole

KINDS = ["assign", "access", "hex", "markov"]
MARKOV = 3
# The patterns of the base kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is too short fails as a whole wherever a match begins in it, so its least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_-"
SIDE = len(ALPHABET) + 1
SPANS = "array<struct<start:int,kind:int,stop:int>>"


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample and the decision threshold (nats per transition)."""

    random_rows: int = 2000   # texts with a fixed-pattern secret, by smallest hash of id and text
    word_rows: int = 2000     # texts for ordinary words, by smallest hash of id and text
    smoothing: float = 0.5
    threshold: float = 0.8


def samples(docs: DataFrame, training: Training = Training(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(sample, label): matched secrets of at most ``random_rows`` texts, words and plain numbers of at most ``word_rows`` texts."""
    t = whole(F.col(text))
    rows = docs.select(F.xxhash64(F.col(doc_id), t).alias("h"), t.alias("t"))
    found = _smallest(rows.where(F.col("t").contains("AKIA") | F.col("t").rlike(HEX) | F.col("t").rlike(ASSIGN)), training.random_rows)
    values = F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)), lambda v: F.char_length(v) >= MIN_VALUE)
    secret = F.concat(F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("t", F.lit(HEX), F.lit(0)), values)
    plain = _smallest(rows, training.word_rows)
    ordinary = F.regexp_extract_all("t", F.lit(r"(?<![A-Za-z0-9+/_.=-])(?:[A-Za-z]{2,}|[0-9]{2,})(?![A-Za-z0-9+/_=-])"), F.lit(0))
    return (found.select(F.explode_outer(secret).alias("sample"), F.lit(1).alias("label"))
            .unionAll(plain.select(F.explode_outer(ordinary).alias("sample"), F.lit(0).alias("label"))).where("sample is not null"))


def _smallest(rows: DataFrame, n: int) -> DataFrame:
    """The n rows with the smallest hash ``h``: only hashes are ranked, texts stay where they are."""
    last = rows.select("h").orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return rows.limit(0) if last is None else rows.where(F.col("h") <= last).limit(n)  # equal hashes: equal rows


def _codes(sample: Column) -> Column:
    """Places of a string's characters in the alphabet, 0 for any other."""
    return F.transform(F.split(sample, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def train(labelled: DataFrame, training: Training = Training()) -> list[float]:
    """Log-likelihood ratio of every transition (row: from, column: to), random over ordinary."""
    pair = lambda c: F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))),
                                F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: a * SIDE + b)
    steps = labelled.select("label", F.explode_outer(let(_codes(F.col("sample")), pair)).alias("step")).where("step is not null")
    counts = {(r["label"], r["step"]): r["n"] for r in steps.groupBy("label", "step").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for a in range(SIDE):
        row = [[counts.get((label, a * SIDE + b), 0) + training.smoothing for b in range(SIDE)] for label in (0, 1)]
        plain, rand = (sum(r) for r in row)
        out += [math.log(row[1][b] / rand) - math.log(row[0][b] / plain) for b in range(SIDE)]
    return out


def score(sample: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per transition of a string of two characters or more."""
    table = F.split(F.lit(",".join(f"{x!r}" for x in model)), ",").cast("array<double>")  # folded to a constant by Catalyst

    def mean(c: Column) -> Column:
        steps = F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: a * SIDE + b)
        return F.aggregate(steps, F.lit(0.0), lambda s, k: s + F.get(table, k)) / (F.size(c) - 1)

    return let(_codes(sample), mean)


def places(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches; ``keep`` tells from (match, number) which stay.

    The pieces between matches, from a split by the same pattern, give the places: a match ends behind the running sum
    of the lengths of pieces and matches up to it.
    """
    def spans(matches: Column, ends: Column) -> Column:
        found = F.transform(ends, lambda end, i: F.struct((end - F.char_length(F.get(matches, i))).alias("start"), F.lit(kind).alias("kind"), end.alias("stop")))
        return found if keep is None else F.filter(found, lambda m, i: keep(i, F.get(matches, i)))

    def summed(matches: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), matches, lambda p, m: F.char_length(p) + F.char_length(m))
        return let(let(lengths, lambda x: running(x, lambda a, n: a + n, F.lit(0))), lambda ends: spans(matches, ends))

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), summed)).otherwise(F.array().cast(SPANS))


def apart(spans: Column, base: Column) -> Column:
    """The spans that overlap none of ``base``; both sorted by start.

    In one sorted list, a span overlaps a base span before it when the greatest stop so far lies behind its start, and
    one after it when the next base span begins before its stop.
    """
    far = F.lit(2**31 - 1)
    is_base = lambda m: m["kind"] != MARKOV

    def clear(merged: Column) -> Column:
        stops = F.transform(merged, lambda m: F.when(is_base(m), m["stop"]).otherwise(F.lit(0)))
        starts = F.transform(F.reverse(merged), lambda m: F.when(is_base(m), m["start"]).otherwise(far))
        before = let(stops, lambda x: running(x, lambda a, b: F.greatest(a, b), F.lit(0)))
        after = let(starts, lambda x: running(x, lambda a, b: F.least(a, b), far))
        return let(before, lambda most: let(after, lambda least: F.filter(merged, lambda m, i: ~is_base(m) & (
            F.get(most, i) <= m["start"]) & (F.get(least, F.size(least) - 1 - i) >= m["stop"]))))

    both = F.sort_array(F.concat(spans, base))
    return F.when((F.size(spans) == 0) | (F.size(base) == 0), spans).otherwise(let(both, clear))


def scan(docs: DataFrame, model: list[float], threshold: float = Training.threshold, text: str = "text") -> DataFrame:
    """Every input column but the text, and ``spans`` (start, kind, stop), sorted; kind is a place in ``KINDS``."""
    t = whole(F.col(text))
    kept = [c for c in docs.columns if c not in (text, "spans")]
    values = F.regexp_extract_all(F.col("__t"), F.lit(ASSIGN), F.lit(2))
    # Bound once: inside the test of each match the values would be searched again for each.
    assigned = let(values, lambda v: places(F.col("__t"), ASSIGN, 0, lambda i, m: F.char_length(F.get(v, i)) >= MIN_VALUE))
    base = docs.select(*[F.col(c) for c in kept], t.alias("__t"))
    base = base.select(*kept, "__t", F.sort_array(F.concat(
        assigned,
        F.when(F.col("__t").contains("AKIA"), places(F.col("__t"), ACCESS, 1)).otherwise(F.array().cast(SPANS)),
        places(F.col("__t"), HEX, 2))).alias("__base"))
    random = places(F.col("__t"), CANDIDATE, MARKOV, lambda i, m: score(m, model) > threshold)
    found = let(random, lambda r: apart(r, F.col("__base")))
    return base.select(*kept, F.sort_array(F.concat("__base", found)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(samples(docs))
    found = scan(docs, model)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))

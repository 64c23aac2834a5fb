"""How filters interact: survivors of every subset of filters, and every order of applying them.

Truth-table survival words. With up to five filters there are 32 subsets, one
bit each. Filter i has a fixed word whose bit S is set when subset S holds i; a
document's survival word is the complement of the OR of the words of the filters
it fails, so bit S says "survives when exactly the filters of S are applied".
Counting each bit over the documents of a part and label (positional popcount)
gives the survivors of all subsets in one pass; kept, removed, lost and Shapley
figures of every order are differences of those counts and never read a text.

The popcount is carry-save: three words become a sum word and a carry word of
twice the weight (full adders on whole vectors), until each weight has at most
two words; only those few are taken apart bit by bit. Tasks count their own rows
and hand on one array per part and label, so a hot part is added up before any
shuffle.

Repeats are found by SHA-256 of the whole text. Groups that hold over one
``HOT``-th of all rows are at most ``HOT`` in number and come by broadcast; the rest
join by a shuffle in which no group holds more than that. Labels join by id the
same way.

Defined results: a null or empty text has no words; a null part is the empty
string; equal texts under one id are no repeats of each other, and a row with a
null id repeats nothing and has no label; several label rows of an id count as one that
has any of their flags; repeated rows count each; an empty table has no
part and gives no row. Other columns are not read, so clashing names do no harm.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import SPACED_WORD, read_table, shared_folder, whole, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_FILTERS = 5
HOT = 10_000
HELD_WORDS = 1 << 20   # words a task holds before it adds them up

GOOD, TOXIC = 1, 2     # bits of a label class


# ------------------------------------------------------------------ words
def truth_columns(n: int) -> list[int]:
    """Per filter the 32-bit word whose bit S is set when subset S holds the filter (subsets of n filters)."""
    return [sum(1 << s for s in range(1 << n) if s >> i & 1) for i in range(n)]


def survival_word(fails: list[Column]) -> Column:
    """The word of a row from its failure conditions (null: not failed), as a long of 32 used bits."""
    if not 1 <= len(fails) <= MAX_FILTERS:
        raise ValueError(f"between 1 and {MAX_FILTERS} filters fit a 32-bit word")
    used = (1 << (1 << len(fails))) - 1
    dead = reduce(Column.bitwiseOR, [F.when(f, F.lit(t)).otherwise(F.lit(0)).cast("long") for f, t in zip(fails, truth_columns(len(fails)))])
    return dead.bitwiseXOR(F.lit(used).cast("long"))


def positional_popcount(words) -> list[int]:
    """How many of the uint32 words have each bit set, by carry-save addition."""
    import numpy as np

    counts, weight, now = [0] * 32, 1, np.asarray(words, "<u4")
    while len(now):
        carried = []
        while len(now) > 2:
            k = len(now) // 3
            a, b, c = now[:k], now[k:2 * k], now[2 * k:3 * k]
            half = a ^ b
            carried.append((a & b) | (half & c))
            now = np.concatenate([half ^ c, now[3 * k:]])
        for w in now.tolist():
            for bit in range(32):
                counts[bit] += weight * (w >> bit & 1)
        now, weight = np.concatenate(carried) if carried else now[:0], 2 * weight
    return counts


# ------------------------------------------------------------------ survivors
def subset_survivors(rows: DataFrame) -> DataFrame:
    """(part, label, n) with n[S] = rows that survive subset S, from rows of part, label and word."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held: dict[tuple[str, int], list] = {}
        n = 0

        def out() -> pa.RecordBatch:
            made = {k: positional_popcount(np.concatenate(v)) for k, v in held.items()}
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in made], pa.string()), pa.array([k[1] for k in made], pa.int32()),
                                               pa.array(list(made.values()), pa.list_(pa.int64()))], names=["part", "label", "n"])

        for b in batches:
            part, label = b.column("part").dictionary_encode(), b.column("label").to_numpy(zero_copy_only=False)
            names, key = part.dictionary.to_pylist(), part.indices.to_numpy(zero_copy_only=False) * 4 + label
            words = b.column("word").to_numpy(zero_copy_only=False).astype("<u4")
            order = np.argsort(key, kind="stable")
            key, words = key[order], words[order]
            edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)] if len(key) else []
            for low, high in itertools.pairwise(edges):
                held.setdefault((names[key[low] // 4], int(key[low] % 4)), []).append(words[low:high])
            n += len(words)
            if n > HELD_WORDS:
                yield out()
                held.clear()
                n = 0
        if held:
            yield out()

    counted = rows.select("part", F.col("label").cast("int").alias("label"), "word").mapInArrow(run, "part string, label int, n array<bigint>")
    return counted.groupBy("part", "label").agg(F.array(*[F.sum(F.get("n", F.lit(s))) for s in range(32)]).alias("n"))


def join_split(left: DataFrame, right: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Left join on ``key`` (unique in ``right``); keys that hold over one HOT-th of ``left`` by broadcast.

    ``counts`` has the rows of ``left`` per key that occurs in ``right`` (column __n).
    """
    total = left.count()
    missing = left.where(F.col(key).isNull())   # joins nothing, and would all go to one task
    left = left.where(F.col(key).isNotNull())
    hot = counts.where(F.col("__n") * HOT > total).select(key)
    hot_right = F.broadcast(right.join(F.broadcast(hot), key, "left_semi"))   # at most HOT rows
    rest = left.join(F.broadcast(hot), key, "left_anti")
    found = left.join(hot_right, key, "inner").unionByName(rest.join(right, key, "left"))
    return found.unionByName(missing, allowMissingColumns=True)


def repeats(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` (id, digest, ...) with ``again``: the same digest stands under a smaller id."""
    groups = rows.groupBy("digest").agg(F.min("id").alias("__first"), F.max("id").alias("__last"), F.count(F.lit(1)).alias("__n"))
    groups.where(F.col("__last") > F.col("__first")).select("digest", "__first", "__n").write.parquet(f"{folder}/copies")
    copies = rows.sparkSession.read.parquet(f"{folder}/copies")
    joined = join_split(rows, copies.select("digest", "__first"), "digest", copies)
    return joined.withColumn("again", F.coalesce(F.col("id") > F.col("__first"), F.lit(False))).drop("__first")


def label_classes(labels: DataFrame) -> DataFrame:
    """(id, label) with the bits GOOD and TOXIC; ids without either flag are left out."""
    flag = lambda c, bit: F.max(F.when(F.col(c) == 1, bit).otherwise(0))
    label = (flag("quality", GOOD) + flag("toxic", TOXIC)).cast("int")
    return labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(label.alias("label")).where("label > 0")


def with_labels(rows: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """``rows`` (id, ...) with the label class of their id, 0 without one."""
    label_classes(labels).write.parquet(f"{folder}/labels")
    classes = rows.sparkSession.read.parquet(f"{folder}/labels")
    counts = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").join(classes, "id", "left_semi")
    return join_split(rows, classes, "id", counts).withColumn("label", F.coalesce("label", F.lit(0)))


# ------------------------------------------------------------------ figures of every order
def audit(survivors: DataFrame, letters: str) -> DataFrame:
    """Per part, order of the filters and step: what the step's filter keeps, removes and loses."""
    full = (1 << len(letters)) - 1
    orders = ["".join(p) for p in itertools.permutations(letters)]
    by_label = {name: [F.sum(F.when(F.col("label").bitwiseAND(F.lit(bit)) == bit, F.get("n", F.lit(s))).otherwise(F.lit(0))) for s in range(full + 1)]
                for name, bit in (("n", 0), ("good", GOOD), ("toxic", TOXIC))}
    parts = survivors.groupBy("part").agg(*[F.array(*sums).alias(name) for name, sums in by_label.items()])
    steps = (parts.select("*", F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")))
    bit = F.create_map(*[F.lit(x) for i, c in enumerate(letters) for x in (c, 1 << i)])
    bits = lambda text: F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: a + F.coalesce(F.element_at(bit, c), F.lit(0)))
    steps = steps.select(
        "*", bits(F.expr("substring(filter_order, 1, step - 1)")).alias("before"), bits(F.expr("substring(filter_order, 1, step)")).alias("after"))
    steps = steps.withColumn("own", F.col("after") - F.col("before"))
    at = lambda c, s: F.get(F.col(c), s if isinstance(s, Column) else F.lit(s))
    gone = lambda c: at(c, F.col("before")) - at(c, F.col("after"))
    return steps.select(
        "part", "filter_order", "step", at("n", F.col("after")).alias("kept"), gone("n").alias("removed"),
        (at("n", 0) - at("n", F.col("own")) - gone("n")).alias("redundant"),
        (at("n", F.lit(full) - F.col("own")) - at("n", full)).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), shapley(F.col("n"), F.col("own"), len(letters)).alias("shapley"))


def shapley(n: Column, own: Column, filters: int) -> Column:
    """What the filter with bit ``own`` removes, summed over all orders, from survivors by subset."""
    from math import factorial

    weight = F.array(*[F.lit(factorial(k) * factorial(filters - 1 - k)).cast("long") for k in range(filters)])
    without = F.filter(F.sequence(F.lit(0), F.lit((1 << filters) - 1)), lambda s: s.bitwiseAND(own) == 0)
    return F.aggregate(without, F.lit(0).cast("long"),
                       lambda a, s: a + F.get(weight, F.bit_count(s)) * (F.get(n, s) - F.get(n, s + own)))


Filters = dict[str, Callable[[Column], Column]]


def survival(docs: DataFrame, labels: DataFrame, filters: Filters, repeat_filter: str | None = None, doc_id: str = "doc_id",
             text: str = "text", part: str = "lang") -> DataFrame:
    """id, part, label class and survival word of every document.

    ``filters`` maps a letter to a failure condition on the text; ``repeat_filter`` is the letter of the filter that
    fails a text which also stands under a smaller id. Letters are in alphabetical order of bits.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "filter-audit")
    t = whole(F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       *[F.coalesce(f(t), F.lit(False)).alias(f"f_{k}") for k, f in sorted(filters.items())],
                       F.unhex(F.sha2(t, 256)).alias("digest"))
    rows.write.parquet(f"{folder}/rows")   # texts are read once; all that follows reads these narrow rows
    rows = spark.read.parquet(f"{folder}/rows")
    fails = {k: F.col(f"f_{k}") for k in filters}
    if repeat_filter:
        rows = repeats(rows, folder)
        fails[repeat_filter] = F.col("again")
    words = rows.select("id", "part", survival_word([fails[k] for k in sorted(fails)]).alias("word"))
    if repeat_filter:
        words.write.parquet(f"{folder}/words")
        words = spark.read.parquet(f"{folder}/words")
    return with_labels(words, labels, folder)


def standard_filters() -> Filters:
    """Short, repetitive, shouting and symbol-laden texts."""
    words = lambda t: words_of(t, SPACED_WORD)
    capitals = lambda t: F.char_length(F.regexp_replace(t, "[^A-Z]+", ""))
    return {
        "A": lambda t: F.size(words(t)) < 100,
        "B": lambda t: F.size(F.array_distinct(words(t))) * 100 < F.size(words(t)) * 80,
        "C": lambda t: capitals(t).cast("long") * 100 > F.char_length(t).cast("long") * 10,
        "D": lambda t: t.rlike("[#$%&*|]"),
    }


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = survival(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), standard_filters(), "E")
    return audit(subset_survivors(rows), "ABCDE")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), w AS (
  SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY x) AS first_id FROM t
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws), 100 * len(regexp_extract_all(x, '[A-Z]')) > 10 * length(x),
          regexp_matches(x, '[#$%&*|]'), coalesce(w.doc_id > first_id, false)] AS fails
  FROM w LEFT JOIN l USING (doc_id)
), g AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), c AS (
  SELECT unnest(range(1, 6)) AS i
), o AS (
  SELECT [a.i, b.i, c3.i, d.i, e.i] AS p FROM c a, c b, c c3, c d, c e
  WHERE len(list_distinct([a.i, b.i, c3.i, d.i, e.i])) = 5
), s AS (
  SELECT g.*, p, step, p[step] AS own, len(list_filter(p[1:step - 1], lambda k: fails[k])) > 0 AS dead,
         len(list_filter(fails, lambda z: z)) AS n_fails FROM g, o, (SELECT i AS step FROM c)
), r AS (
  SELECT part, array_to_string(list_transform(p, lambda k: chr(CAST(64 + k AS INTEGER))), '') AS filter_order, step, own,
         CAST(coalesce(sum(n) FILTER (NOT dead AND NOT fails[own]), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT dead AND fails[own]), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (dead AND fails[own]), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (fails[own] AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (NOT dead AND fails[own]), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (NOT dead AND fails[own]), 0) AS BIGINT) AS toxic_lost
  FROM s GROUP BY part, p, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""

"""Benchmark decontamination: word windows of training texts against a broadcast set of test n-grams.

Benchmark items are lower-cased (A-Z) and cut into windows of ``width``
consecutive words (an item with fewer words, but not none, is one window).
Distinct windows, each with its list of items, form the hash set. Documents are
scanned once: a window's 64-bit hash probes the set, and equal words verify
each hit, so a hash collision can't mark a word.

Size of what is broadcast: windows are counted first. Up to
``max_broadcast`` windows go out as one broadcast; more are cut into blocks of
at most that many by their hash and the documents are probed block by block,
with the same result.

Defined results: a null text has no words and is never hit; a window found
again in a text, or in several items, counts each word once; repeated rows
(also with equal or null ids) each get their own result row; an empty
benchmark hits nothing and an empty table gives an empty result. Other columns
of either table are not read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ALNUM_WORD, SQL_ALNUM_WORD, ascii_lower, let, read_table, starts, whole, window_hashes, words_of

WIDTH = 10
MAX_BROADCAST = 500_000  # windows; about 200 bytes each, so 100 MB at most


def ngrams(benchmark: DataFrame, width: int = WIDTH, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct window: ``size`` (words), ``hash``, ``gram`` (the words), ``items`` (sorted ids)."""
    words = words_of(ascii_lower(whole(F.col(text))), ALNUM_WORD)
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(width))
    grams = items.select("item", F.explode(F.transform(starts(F.size("w"), size), lambda i: F.slice(F.col("w"), i + 1, size))).alias("gram"))
    grams = grams.groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items"))
    by_size = F.coalesce(*[F.when(F.size("gram") == k, F.get(window_hashes(F.col("gram"), k), F.lit(0)))
                           for k in range(width, 0, -1)])
    return grams.select(F.size("gram").alias("size"), by_size.alias("hash"), "gram", "items")


def _windows(words: Column, sizes: list[int]) -> Column:
    """Window hashes of a text, one size after the other, behind one null entry that each text has."""
    return F.concat(F.array(F.lit(None).cast("long")), *[window_hashes(words, k) for k in sizes])


def _place(at: Column, n: Column, sizes: list[int]) -> tuple[Column, Column]:
    """Size and start of entry ``at`` of ``_windows``; (0, -1) for the null entry."""
    size, start, before = F.lit(0), F.lit(-1), F.lit(1)
    for k in sizes:
        size, start = F.when(at >= before, F.lit(k)).otherwise(size), F.when(at >= before, at - before).otherwise(start)
        before = before + F.greatest(n - k + 1, F.lit(0))
    return size, start


def scan(docs: DataFrame, grams: DataFrame, doc_id: str = "doc_id", text: str = "text",
         max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per document row: doc_id, n_words, ``hit`` (sorted positions of hit words), ``items`` (sorted ids).

    One pass over the texts for each block of windows. Only windows that are
    hits, and one marker per text, are shuffled, by document, as positions.
    """
    n = grams.count()
    blocks = max(1, -(-n // max_broadcast))
    sizes = [r["size"] for r in grams.select("size").distinct().orderBy("size").collect()]  # at most WIDTH values
    t = ascii_lower(whole(F.col(text)))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.md5(whole(F.col(text)).cast("binary")).alias("digest"),
                       words_of(t, ALNUM_WORD).alias("words"))
    base = base.withColumn("runs", _windows(F.col("words"), sizes))
    flat = base.select("doc_id", "digest", "words", F.size("words").alias("n"), F.posexplode_outer("runs").alias("p", "hash"))
    size, at = _place(F.col("p"), F.col("n"), sizes)
    flat = flat.select("doc_id", "digest", "words", "n", "hash", size.alias("size"), at.alias("at"))
    out = None
    for b in range(blocks):
        part = grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == b)
        part = part.select(F.col("hash").alias("g_hash"), "gram", "items")
        found = flat.join(F.broadcast(part), F.col("hash") == F.col("g_hash"), "left")
        verified = F.slice("words", F.greatest(F.col("at") + 1, F.lit(1)), F.col("size")) == F.col("gram")
        marker = (F.col("at") < 0) & F.lit(b == 0)
        found = found.where(F.when(F.col("gram").isNull(), marker).otherwise(verified))
        found = found.select("doc_id", "digest", "n", "at", "size", "items")
        out = found if out is None else out.unionAll(found)
    # rows with equal id and text have equal results: they meet in one group and come out as often as they went in
    spans = F.transform(F.col("spans"), lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1))
    per_text = out.groupBy("doc_id", "digest", "n").agg(
        F.count(F.when(F.col("at") < 0, 1)).alias("copies"),
        F.collect_set(F.when(F.col("at") >= 0, F.struct("at", "size"))).alias("spans"),
        F.collect_set("items").alias("items"))
    per_text = per_text.select("doc_id", F.col("n").cast("long").alias("n_words"), "copies",
                               F.sort_array(F.array_distinct(F.flatten(spans))).alias("hit"),
                               F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"))
    once = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return per_text.select("*", once.alias("copy")).drop("copies", "copy")


def remove_documents(docs: DataFrame, grams: DataFrame, text: str = "text",
                     max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The rows of ``docs`` whose text has no verified window; columns unchanged.

    The hit texts' digests (few, deduplicated) are anti-joined; Spark
    broadcasts them only when their measured size is under its threshold.
    """
    keyed = docs.withColumn("__digest", F.md5(whole(F.col(text)).cast("binary")))
    hits = scan(keyed, grams, "__digest", text, max_broadcast).where(F.size("hit") > 0)
    bad = hits.select(F.col("doc_id").alias("__bad")).distinct()
    return keyed.join(bad, F.col("__digest") == F.col("__bad"), "left_anti").drop("__digest")


def cut_spans(text: Column, hit: Column) -> Column:
    """The text without its hit words: its words that stand, lower case kept as written, joined by spaces.

    ``hit`` holds word positions of the lower-cased text, whose words line up
    one to one with the words of the text as written.
    """
    as_written = words_of(whole(text), r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")
    return let(as_written, lambda w: F.array_join(
        F.filter(w, lambda x, i: ~F.array_contains(hit, i)), " "))


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    grams = ngrams(read_table(spark, sf_dir, "benchmark"))
    found = scan(read_table(spark, sf_dir, "documents"), grams)
    return found.select("doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hit") > 0).alias("contaminated"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_ALNUM_WORD}') AS w FROM documents
), b AS (
  SELECT item_id, w, least(len(w), 10) AS k
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_ALNUM_WORD}') AS w
        FROM benchmark) WHERE len(w) > 0
), g AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM b)
), x AS (
  SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)
), h AS (
  SELECT rid, i, g.k, item_id FROM x JOIN g USING (k, gram)
), n AS (
  SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + k - 1)) AS j FROM h) GROUP BY rid
), m AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)
"""

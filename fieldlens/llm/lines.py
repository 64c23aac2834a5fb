"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate. Lines are trimmed; each
distinct line hash gets a HyperLogLog sketch of its sites, built map-side and
merged by aggregation, so a line in a third of all documents is a few hundred
bytes per task. Where the estimate is within ``band`` of the threshold, sites
are counted exactly; above the band a line is boilerplate, below it isn't.
Boilerplate lines are then taken out of every document.

The band is four standard errors of the sketch, and counts of this size are
kept exactly by its sparse form, so verdicts are those of exact counts. Lines
with equal 64-bit hashes count as one.

What is shuffled: per task one sketch per line hash, exact (hash, site) pairs
near the threshold, and boilerplate hashes per document. Broadcasts follow a
count (``MAX_BROADCAST`` rows); beyond it Spark joins by shuffle.

Defined results: empty or white-space lines are never boilerplate and stay; a
null text is empty; a null site is one site of its own; a line repeated in one
document counts its site once; repeated rows are cleaned alike, each in its
own row; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import read_table, shared_folder, whole

MIN_SITES = 5
LG_K = 8
BAND = 4 * 1.04 / 2 ** (LG_K / 2)
MAX_BROADCAST = 200_000


def line_hashes(text: Column) -> Column:
    """Hash of every trimmed line, null for an empty one, in order."""
    return F.transform(F.split(text, "\n"), lambda x: _hash(x))


def _hash(line: Column) -> Column:
    bare = F.regexp_replace(line, r"^\s+|\s+$", "")
    return F.when(bare != "", F.xxhash64(bare))


def spread(docs: DataFrame, site: str = "source", text: str = "text") -> DataFrame:
    """(h, site) of every distinct line of every row."""
    hashes = F.array_distinct(line_hashes(whole(F.col(text))))
    site_key = F.when(F.col(site).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(site).cast("string")))
    return docs.select(site_key.alias("site"), F.explode_outer(hashes).alias("h")).where("h is not null")


def boilerplate(docs: DataFrame, folder: str, min_sites: int = MIN_SITES, site: str = "source", text: str = "text") -> DataFrame:
    """(h): hashes of lines on ``min_sites`` sites or more."""
    spark = docs.sparkSession
    seen = spread(docs, site, text)
    sketches = seen.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("n"))
    sketches.where(F.col("n") >= min_sites * (1 - BAND) - 0.5).write.parquet(f"{folder}/spread")
    some = spark.read.parquet(f"{folder}/spread")
    near = some.where(F.col("n") <= min_sites * (1 + BAND) + 0.5).select(F.col("h").alias("near"))
    near = F.broadcast(near) if near.count() <= MAX_BROADCAST else near
    exact = seen.join(near, F.col("h") == F.col("near"), "left_semi").groupBy("h").agg(F.countDistinct("site").alias("n"))
    sure = some.where(F.col("n") > min_sites * (1 + BAND) + 0.5).select("h")
    exact.where(F.col("n") >= min_sites).select("h").unionAll(sure).write.parquet(f"{folder}/boilerplate")
    return spark.read.parquet(f"{folder}/boilerplate")


def clean(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source", text: str = "text") -> DataFrame:
    """Every row with ``text`` freed of boilerplate lines, and ``n_lines`` and ``n_removed``."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "lines")
    bad = boilerplate(docs, folder, min_sites, site, text).select(F.col("h").alias("bad"))
    n_bad = bad.count()
    t = whole(F.col(text))
    digest = F.md5(t.cast("binary"))
    hit = docs.select(digest.alias("__d"), F.explode_outer(F.array_distinct(line_hashes(t))).alias("h"))
    hit = hit.join(F.broadcast(bad) if n_bad <= MAX_BROADCAST else bad, F.col("h") == F.col("bad"), "left_semi")
    hit.groupBy("__d").agg(F.collect_set("h").alias("__bad")).write.parquet(f"{folder}/hits")
    hits = spark.read.parquet(f"{folder}/hits").withColumnRenamed("__d", "__hit")
    hits = F.broadcast(hits) if hits.count() <= MAX_BROADCAST else hits
    rows = docs.withColumn("__d", digest).join(hits, F.col("__d") == F.col("__hit"), "left")
    lines = F.split(t, "\n")
    stay = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("__bad", _hash(x)), F.lit(False)))
    cleaned = F.when(F.col("__bad").isNull(), t).otherwise(F.array_join(stay, "\n"))
    n = F.size(lines)
    kept = F.when(F.col("__bad").isNull(), n).otherwise(F.size(stay))
    others = [F.col(c) for c in docs.columns if c not in (text, "n_lines", "n_removed")]
    return rows.select(*others, cleaned.alias(text), n.cast("long").alias("n_lines"), (n - kept).cast("long").alias("n_removed"))


def op4_lines(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return clean(docs).select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("kept_chars"),
                              F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS site, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT rid, doc_id, site, i, ls[i] AS line, regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare
  FROM (SELECT *, unnest(generate_series(1, len(ls))) AS i FROM d)
), b AS (
  SELECT bare FROM l WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 5
), x AS (
  SELECT l.*, b.bare IS NOT NULL AS gone FROM l LEFT JOIN b USING (bare)
), r AS (
  SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS t FROM x GROUP BY rid
)
SELECT doc_id, n_lines, n_removed, CAST(length(t) AS BIGINT) AS kept_chars, sha256(t) AS kept_sha256 FROM r
"""

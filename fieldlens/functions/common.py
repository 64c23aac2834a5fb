"""Small column helpers shared by the feeds and the medallion layers."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TOPIC_DEFAULT, TOPIC_RULES


def days_since(as_of: _dt.date, d: Column) -> Column:
    """Whole days from ``d`` to the as-of date (negative for future dates)."""
    return F.datediff(F.lit(as_of), d)


def first_upper(s: Column) -> Column:
    """Upper-case the first character only ('in-person' -> 'In-person')."""
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


_REGEX_SPECIAL = set("\\^$.|?*+()[]{}")


def literal_alternatives(pattern: str) -> list[str] | None:
    """The words of a pattern that is a plain alternation of literals, else None."""
    words = pattern.split("|")
    return None if any(set(w) & _REGEX_SPECIAL for w in words) else words


def matches(s: Column, pattern: str) -> Column:
    """``s RLIKE pattern``; a literal alternation runs as substring tests (same result, no regex)."""
    words = literal_alternatives(pattern)
    if words is None:
        return s.rlike(pattern)
    out = s.contains(words[0])
    for w in words[1:]:
        out = out | s.contains(w)
    return out


def classify_topic(topic: Column) -> Column:
    """Ordered cascade of the topic rules on lower(topic); first match wins (substring search)."""
    low = F.lower(topic)
    expr = None
    for pattern, label in TOPIC_RULES:
        hit = matches(low, pattern)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit(TOPIC_DEFAULT))


GROUP_BUCKETS = 4096          # of the hash of a group's keys
HOT_BUCKET_ROWS = 1_000_000   # a bucket of more rows, and of several times the usual, holds a hot group
HOT_BUCKET_SHARE = 8


def aggregate_by(rows: DataFrame, keys: list[str], aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``aggregate(rows)``, whose groups are those of ``keys`` or parts of them, with the rows shuffled by ``keys`` as they are.

    Where a task has about a row per group, rows as they are take less room in a shuffle than the states made of them, and
    all groups of equal ``keys`` come out in one place. Rows of hot keys are added up before they are shuffled:
    ``rows`` are counted first by the hash of their keys, so they should be stored.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(GROUP_BUCKETS))
    sizes = {r[0]: r[1] for r in rows.groupBy(bucket.alias("b")).count().collect()}   # at most GROUP_BUCKETS
    most = max(HOT_BUCKET_ROWS, HOT_BUCKET_SHARE * sum(sizes.values()) / GROUP_BUCKETS)
    hot = [b for b, n in sizes.items() if n > most]
    if not hot:
        return aggregate(rows.repartition(*keys))
    return aggregate(rows.where(~bucket.isin(hot)).repartition(*keys)).unionByName(aggregate(rows.where(bucket.isin(hot))))


def path_has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))

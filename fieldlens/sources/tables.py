"""Readers for the driver's star-schema Parquet tables."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; Catalyst prunes columns and pushes filters into the Parquet scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """A digest of path, length and time of change of every file of the tables under ``sf_dir``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    seen: list[str] = []
    for name in STAR_TABLES:
        table = jvm.org.apache.hadoop.fs.Path(root, f"{name}.parquet")
        if fs.exists(table):
            files = fs.listFiles(table, True)
            while files.hasNext():
                f = files.next()
                seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


BYTES_A_PARTITION = 4 << 20
SHUFFLED_BYTES_A_TASK = 16 << 20   # of narrow keys, which a task then builds and sorts ten times as wide rows from


def spread(spark: SparkSession, sf_dir: str) -> int:
    """Let shuffles begin with a partition per ``BYTES_A_PARTITION`` of the tables' files, if that is more than the session's own number.

    A task then sorts and aggregates about as many rows on large tables as on small ones; AQE merges what is
    too small, up to ``SHUFFLED_BYTES_A_TASK``: at its usual 64 MB a task gets millions of notes to sort and spills them. A larger
    number and a smaller size in the session stay. Returns the number that shuffles begin with.
    """
    jvm = spark.sparkContext._jvm
    merge = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(merge)) > SHUFFLED_BYTES_A_TASK:
        spark.conf.set(merge, str(SHUFFLED_BYTES_A_TASK))
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tables = [jvm.org.apache.hadoop.fs.Path(root, f"{name}.parquet") for name in STAR_TABLES]
    size = sum(fs.getContentSummary(t).getLength() for t in tables if fs.exists(t))
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-size // BYTES_A_PARTITION)
    if wanted > now:
        spark.conf.set(name, str(wanted))
    return max(now, wanted)


class StarTables:
    """Lazy accessor: ``StarTables(spark, dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        # one reader per table and instance: feeds that share a table (lineitem,
        # orders, customer) reuse its resolved relation instead of listing and
        # reading the footers again; the plan still scans per consumer
        if name in STAR_TABLES:
            if name not in self._read:
                self._read[name] = read_table(self.spark, self.sf_dir, name)
            return self._read[name]
        raise AttributeError(name)

"""The newest version of each key, kept in buckets of the key's hash, of which an update rewrites only those it hits.

A commit names the folder that holds each bucket. New versions are reduced to
one per key before anything is shuffled, the buckets they fall in are read,
merged and written to a new folder, and one commit points these buckets to it;
all other buckets keep the folder they have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commitlog import CommitLog

BUCKETS = 64


class NewestByKey:
    """``order`` gives the column by which the greatest version of a key is the newest."""

    def __init__(self, spark: SparkSession, root: str, key: str, order: Callable[[], Column], buckets: int = BUCKETS) -> None:
        self.spark, self.log, self.key, self.order, self.buckets = spark, CommitLog(spark, root), key, order, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame) -> DataFrame:
        columns = rows.columns
        best = rows.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max_by(F.struct(*columns), self.order()).alias("__r"))
        return best.select(*[F.col(f"__r.{c}").alias(c) for c in columns])

    def update(self, versions: DataFrame) -> dict | None:
        """Bring the store up to date with ``versions``; returns the commit, None when there is none to store."""
        def prepare(entries: list[dict]) -> dict | None:
            now = entries[-1]["folders"] if entries else {}
            staged, folder = self.log.folder_for_data("new"), self.log.folder_for_data("buckets")
            self._newest(versions).withColumn("__bucket", self._bucket()).write.parquet(staged)
            new = self.spark.read.parquet(staged)
            hit = sorted(r["__bucket"] for r in new.select("__bucket").distinct().collect())   # at most as many as buckets
            if not hit:
                return None
            both = new.drop("__bucket")
            stored = [now[str(b)] for b in hit if str(b) in now]
            if stored:
                both = both.unionByName(self.spark.read.schema(both.schema).parquet(*stored))
            merged = self._newest(both).withColumn("__bucket", self._bucket())
            merged.repartition("__bucket").write.partitionBy("__bucket").parquet(folder)
            return {"folders": now | {str(b): f"{folder}/__bucket={b}" for b in hit}, "hit": hit, "replaces": True}

        return self.log.append(prepare)

    def folders(self) -> dict[int, str]:
        entry = self.log.entry()
        return {int(b): f for b, f in entry["folders"].items()} if entry else {}

    def table(self, schema) -> DataFrame:
        """The newest version of every key."""
        folders = list(self.folders().values())
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

"""Operational serving: keyed queue snapshot, its change feed, review write-back log.

The queue is published as a keyed, versioned snapshot (unique ``hcp_id``); two
versions give the change feed that brings a copy up to date. Review decisions go
to an append-only log with an optimistic commit log (:mod:`..plans.commitlog`).
``action_id`` is a hash of the caller's request id, and every append keeps only
requests that the log doesn't have: a retried append, or two appenders at once,
write each request once, and equal decisions under different request ids are all
kept. ``review_id`` is a dense number in the order of commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Settings
from ..plans import publish as PB
from ..plans.commitlog import CommitLog

QUEUE_COLUMNS = ["hcp_id", "hcp_name", "specialty", "territory", "priority_tier", "msl_priority_score",
                 "engagement_segment", "trigger", "topic", "suggested_engagement", "recommended_date",
                 "overdue"]
REVIEW_COLUMNS = ["review_id", "action_id", "hcp_id", "msl_name", "review_decision", "review_notes",
                  "scheduled_channel", "scheduled_date", "reviewed_at"]
REVIEW_SCHEMA = ("review_id LONG, action_id STRING, hcp_id STRING, msl_name STRING, review_decision STRING, "
                 "review_notes STRING, scheduled_channel STRING, scheduled_date DATE, reviewed_at TIMESTAMP")


def action_queue(next_best: DataFrame) -> DataFrame:
    """The serving projection of next-best-engagement."""
    return next_best.select(*QUEUE_COLUMNS)


ROWS_PER_FILE = 200_000
ROW_GROUP_BYTES = 4 << 20


def publish_snapshot(queue: DataFrame, root: str, key: str = "hcp_id", rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """K3: write the queue to a new folder under ``root``, check the key, then switch readers to it.

    The check reads the written files (not the lineage). When it fails nothing
    is published and the former snapshot stays served. The served files are sorted
    by the key, have a Bloom filter of it per row group, and a directory of each
    file's least and greatest key, so :func:`lookup` opens only files that can hold a key.
    """
    spark = queue.sparkSession
    run = PB.new_run(root)
    before = PB.current(spark, root)
    queue.write.parquet(f"{run}-staged")
    staged = spark.read.parquet(f"{run}-staged")
    rows, keys = staged.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    if staged.where(F.col(key).isNull()).limit(1).count() or rows != keys:
        raise ValueError(f"snapshot key {key!r} is not unique in {run}-staged")
    files = max(1, -(-rows // rows_per_file))
    (staged.repartitionByRange(files, key).sortWithinPartitions(key).write
        .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(max(1, rows // files)))
        .option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(run))
    (spark.read.parquet(run).groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(key).alias("least"), F.max(key).alias("greatest"), F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(f"{run}-directory"))
    PB.publish(spark, root, run, before[0] if before else 0)
    return spark.read.parquet(run)


def lookup(spark: SparkSession, root: str, keys: list[str], key: str = "hcp_id") -> DataFrame:
    """The served rows of some keys (A2, A6, A9, A11): only files whose range holds one of them are opened.

    In those files the key filter is pushed down to the row groups' statistics and Bloom filters.
    """
    now = PB.current(spark, root)
    if now is None:
        raise ValueError(f"nothing is published under {root}")
    wanted = sorted(set(keys))
    some = F.lit(False)
    for k in wanted:
        some = some | F.lit(k).between(F.col("least"), F.col("greatest"))
    files = [r["file"] for r in spark.read.parquet(f"{now[1]}-directory").where(some).select("file").collect()]
    served = spark.read.parquet(now[1])
    if not files:
        return served.limit(0)
    return spark.read.schema(served.schema).parquet(*files).where(F.col(key).isin(wanted))


def served_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot that is published under ``root``."""
    now = PB.current(spark, root)
    if now is None:
        raise ValueError(f"nothing is published under {root}")
    return spark.read.parquet(now[1])


def snapshot_at(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(PB.run_of(spark, root, version))


def changes(old: DataFrame, new: DataFrame, key: str = "hcp_id") -> DataFrame:
    """The change feed between two versions: ``change`` (insert, update, delete), the key and the new row's columns.

    The old side brings only its key and a digest of its row; rows whose digests agree are left out. Columns of a
    deleted row are NULL but for the key.
    """
    rows = sorted(set(new.columns) - {key})
    digest = F.sha2(F.to_json(F.struct(*rows)), 256)
    before = old.select(F.col(key).alias("__key"), digest.alias("__before"))
    after = new.select("*", digest.alias("__after"))
    both = after.join(before, F.col(key) == F.col("__key"), "full")
    change = (F.when(F.col("__before").isNull(), "insert").when(F.col("__after").isNull(), "delete")
              .when(F.col("__before") != F.col("__after"), "update"))
    return (both.withColumn("change", change).where(F.col("change").isNotNull())
            .select("change", F.coalesce(F.col(key), F.col("__key")).alias(key), *[c for c in new.columns if c != key]))


def apply_changes(old: DataFrame, feed: DataFrame, key: str = "hcp_id") -> DataFrame:
    """The new version from the old one and the feed."""
    kept = old.join(feed.select(key), key, "left_anti").select(*old.columns)
    return kept.unionByName(feed.where("change != 'delete'").select(*old.columns))


def top_of_queue(queue: DataFrame, n: int) -> DataFrame:
    """Top-n by score (ties by hcp_id)."""
    return queue.orderBy(F.desc("msl_priority_score"), "hcp_id").limit(n)


def queue_check(queue: DataFrame, n: int = 5) -> DataFrame:
    """Row count of the served queue plus its head."""
    total = queue.agg(F.count(F.lit(1))).scalar()
    return top_of_queue(queue, n).select(
        "hcp_id", "hcp_name", "priority_tier", F.round("msl_priority_score", 1).alias("msl_priority_score"),
        "trigger", total.alias("queue_rows"))


def decisions(df: DataFrame) -> DataFrame:
    """Normalise decision records; ``action_id`` is a hash of the caller's ``request_id``.

    Content plays no part: two decisions with equal content and different
    request ids are two decisions. A NULL request id is refused.
    """
    content = ["hcp_id", "msl_name", "review_decision", "review_notes", "scheduled_channel", "scheduled_date"]
    checked = F.when(F.col("request_id").isNull(), F.raise_error(F.lit("a decision needs a request_id"))).otherwise(
        F.col("request_id").cast("string"))
    return df.select(F.sha2(checked, 256).alias("action_id"), *content, F.current_timestamp().alias("reviewed_at"))


def _rows_of(spark: SparkSession, entries: list[dict]) -> DataFrame:
    folders = [f for e in entries for f in e["folders"]]
    if folders:
        return spark.read.schema(REVIEW_SCHEMA).parquet(*folders)
    return spark.createDataFrame([], REVIEW_SCHEMA)  # an empty log has no files yet


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return _rows_of(spark, CommitLog(spark, path).entries())


def _next_id(entries: list[dict]) -> int:
    return entries[-1]["next_id"] if entries else 1


def numbered(rows: DataFrame, order: str, first: int, staged: str) -> tuple[DataFrame, int]:
    """``rows`` with ``review_id`` = first, first + 1, ... in ``order``, and how many there are.

    The rows are range-partitioned, sorted and written once to ``staged``; a row's number is its place in its partition
    plus the rows of the partitions before, of which there are as many counts as partitions.
    """
    spark = rows.sparkSession
    rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("__row", F.monotonically_increasing_id()).write.parquet(staged)
    written = spark.read.parquet(staged).withColumn("__part", F.shiftright("__row", 33))
    counts = written.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__row").alias("low")).orderBy("__part").collect()
    at, offsets = first, []
    for r in counts:
        offsets.append((r["__part"], at - r["low"]))
        at += r["n"]
    table = F.broadcast(spark.createDataFrame(offsets, "__part LONG, __offset LONG"))
    out = written.join(table, "__part").withColumn("review_id", F.col("__row") + F.col("__offset"))
    return out.drop("__row", "__part", "__offset"), at - first


def _commit(spark: SparkSession, log: CommitLog, make) -> dict | None:
    """Append the rows that ``make`` gives for the log's present entries."""
    def prepare(entries: list[dict]) -> dict | None:
        rows = make(entries)
        if rows is None:
            return None
        first = _next_id(entries)
        out, n = numbered(rows, "action_id", first, log.folder_for_data("staged"))
        if not n:
            return None
        folder = log.folder_for_data()
        out.select(*REVIEW_COLUMNS).write.parquet(folder)
        return {"folders": [folder], "rows": n, "next_id": first + n}

    return log.append(prepare)


def append_reviews(spark: SparkSession, new: DataFrame, path: str) -> dict | None:
    """K4: append every request that the log at ``path`` doesn't have; a retried append writes nothing.

    Of several rows with one request id the least in order of content counts. Returns the commit, None without new rows.
    """
    made = decisions(new)
    content = [c for c in made.columns if c != "action_id"]
    once = made.groupBy("action_id").agg(F.min(F.struct(*content)).alias("r")).select("action_id", "r.*")
    return _commit(spark, CommitLog(spark, path),
                   lambda entries: once.join(_rows_of(spark, entries).select("action_id"), "action_id", "left_anti"))


def seed_reviews(spark: SparkSession, queue: DataFrame, path: str, s: Settings) -> dict | None:
    """K5: when the log is empty, record an approval for the top decisions of the queue; only one of several seeders does."""
    top = top_of_queue(queue, s.seed_decisions).select(
        F.concat(F.lit("seed-"), "hcp_id").alias("request_id"), "hcp_id", F.lit(C.SEED_MSL).alias("msl_name"), F.lit(C.SEED_DECISION).alias("review_decision"),
        F.lit(C.SEED_NOTES).alias("review_notes"), F.lit(C.SEED_CHANNEL).alias("scheduled_channel"),
        F.date_add(F.lit(s.as_of), s.seed_schedule_days).alias("scheduled_date"))
    return _commit(spark, CommitLog(spark, path), lambda entries: None if entries else decisions(top))


def compact_log(spark: SparkSession, path: str) -> dict | None:
    """Rewrite the log's rows to one folder and commit an entry that replaces all before it; ids stay."""
    log = CommitLog(spark, path)

    def prepare(entries: list[dict]) -> dict | None:
        if len(entries) < 2:
            return None
        folder = log.folder_for_data()
        _rows_of(spark, entries).repartitionByRange("review_id").write.parquet(folder)
        return {"folders": [folder], "rows": 0, "next_id": _next_id(entries), "replaces": True}

    return log.append(prepare)


def recent_reviews(log: DataFrame, n: int) -> DataFrame:
    """Newest n decisions per HCP."""
    w = Window.partitionBy("hcp_id").orderBy(F.desc("reviewed_at"), F.desc("action_id"))
    return log.withColumn("recency_rank", F.row_number().over(w)).filter(F.col("recency_rank") <= n)

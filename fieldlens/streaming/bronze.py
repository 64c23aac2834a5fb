"""Bronze ingest: CSV drop folders -> append-only Parquet tables.

Each feed is a Structured Streaming source of the files (``.csv`` or ``.csv.gz``) in its drop folders. A
micro-batch takes the paths of the files that arrived, groups them by header
(:mod:`.headers`) and writes their mapped rows with the lineage columns
(``_ingested_at`` = processing time, ``_source_file`` = the file's path) to a
folder named after the batch, so a batch that runs again after a failure
replaces its own rows and no file is stored twice. The stream runs with
``trigger(availableNow=True)``: every call processes the files that arrived
since the last call and stops, so a scheduler can run it as a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType

from ..session import shuffles_freed
from ..sources.feeds import BATCH_COLUMN, bronze_schema, feed_columns, write_feed_csv
from .headers import read_mapped

# The columns that a source of files has; only the path is read.
FILES = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def file_stream(spark: SparkSession, source_glob: str, max_files: int = 1000) -> DataFrame:
    """The paths of the files under the drop folders, as they arrive."""
    return (spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.{csv,csv.gz}")
            .option("maxFilesPerTrigger", max_files).load(source_glob).select("path"))


def start(spark: SparkSession, feed: str, source_glob: str, table_path: str, checkpoint: str, max_files: int = 1000) -> StreamingQuery:
    """Begin to process every not-yet-seen file of ``source_glob`` into ``table_path``."""
    def store(files: DataFrame, batch: int) -> None:
        session = files.sparkSession
        paths = [r["path"] for r in files.distinct().collect()]   # at most max_files
        rows = read_mapped(session, feed, paths).withColumn("_ingested_at", F.current_timestamp())
        stored = rows.select(*[f.name for f in bronze_schema(feed)]).write.mode("overwrite").option("compression", "zstd")
        stored.parquet(f"{table_path}/{BATCH_COLUMN}={batch}")

    return (file_stream(spark, source_glob, max_files).writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def ingest(spark: SparkSession, feed: str, source_glob: str, table_path: str, checkpoint: str, max_files: int = 1000) -> None:
    """Process every not-yet-seen file of ``source_glob`` into ``table_path`` once."""
    finish(start(spark, feed, source_glob, table_path, checkpoint, max_files))


def drop_files(df: DataFrame, folder: str, files: int | None = None, gzip: bool = False) -> None:
    """Upstream side: land a feed extract as headered CSV files in a drop folder."""
    with shuffles_freed(df.sparkSession):
        write_feed_csv(df, folder, files, gzip)


def read_bronze(spark: SparkSession, feed: str, table_path: str) -> DataFrame:
    """The stored rows with the number of the batch that brought them."""
    return spark.read.schema(bronze_schema(feed).add(BATCH_COLUMN, IntegerType())).parquet(table_path)


def bronze_view(spark: SparkSession, feed: str, table_path: str) -> DataFrame:
    """The bronze table with what is the same in every run of the two lineage columns.

    ``source_drop`` is the drop folder in ``_source_file``; ``ingest_batch`` is the batch, of one ``_ingested_at``.
    """
    t = read_bronze(spark, feed, table_path)
    ok = F.col("_ingested_at").isNotNull() & F.col("_source_file").rlike(r"\.csv(\.gz)?$")
    return t.select(*feed_columns(feed), F.col("_rescued").alias("rescued"),
                    F.regexp_extract("_source_file", r"/([^/]+)/[^/]+$", 1).alias("source_drop"), F.col(BATCH_COLUMN).alias("ingest_batch"),
                    ok.alias("ingest_ok"))

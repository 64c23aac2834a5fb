"""Headers of dropped CSV files: what each file calls its columns, and one mapped read per header.

Upstream systems reorder, add and drop columns. The names in a file's first
record decide where its cells go, never their place: known names (any case) are
read with the feed's type, names that the feed doesn't have are kept as text in
the rescue column, and columns that the file lacks are NULL.

Only the first record of each file is read to find its header (a few hundred
bytes, unpacked if the file's ending names a codec, by the driver, for the files of one micro-batch, whose number is bounded).
Files with the same header are read together by one typed scan.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.feeds import RESCUE_COLUMN, csv_options, feed_schema

RECORD = "__record"          # the reader's corrupt-record column
HEADER_BYTES = 64 << 10      # a header record is shorter than this
PARALLEL = 16


def first_record(spark: SparkSession, path: str, separator: str = ",") -> tuple[str, ...]:
    """The cells of a file's first record; empty for an empty file."""
    jvm = spark.sparkContext._jvm
    place, conf = jvm.org.apache.hadoop.fs.Path(path), spark.sparkContext._jsc.hadoopConfiguration()
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        if codec is not None:
            if stream.read() < 0:
                return ()   # without a byte it is no compressed file
            stream.seek(0)
            stream = codec.createInputStream(stream)
        data = bytes(stream.readNBytes(HEADER_BYTES))
    finally:
        stream.close()
    if not data:
        return ()
    text = data.decode("utf-8-sig", errors="replace")
    return tuple(next(csv.reader(io.StringIO(text, newline=""), delimiter=separator, doublequote=True), ()))


@dataclass(frozen=True)
class Header:
    """Names of a file's columns in their order, each unique."""

    known: tuple[str | None, ...]   # the feed's column, or None for one that the feed doesn't have
    names: tuple[str, ...]          # as the file writes them


def match(cells: Iterable[str], feed: str) -> Header:
    """Which of the feed's columns each cell of a header names: case and outer space don't count, the first of equal names wins."""
    columns = {f.name.lower(): f.name for f in feed_schema(feed, with_rescue=False)}
    known: list[str | None] = []
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = cell.strip()
        column = columns.get(name.lower())
        known.append(column if column not in known else None)
        plain = name or f"column_{i + 1}"
        names.append(plain if plain not in names else f"{plain}_{i + 1}")
    return Header(tuple(known), tuple(names))


def inventory(spark: SparkSession, paths: list[str], feed: str) -> dict[Header, list[str]]:
    """Files by header; empty files have the empty header."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        headers = list(pool.map(lambda p: match(first_record(spark, p), feed), paths))
    groups: dict[Header, list[str]] = {}
    for path, header in sorted(zip(paths, headers), key=lambda x: x[0]):
        groups.setdefault(header, []).append(path)
    return groups


def _rescued(extra: dict[str, str]) -> Column:
    """Cells of unknown columns and the text of a record that didn't fit, as one JSON object; NULL when there is nothing."""
    cells = [F.col(c).alias(name) for c, name in extra.items()] + [F.col(RECORD).alias("_record")]
    return F.when(F.coalesce(*[F.col(c) for c in (*extra, RECORD)]).isNotNull(), F.to_json(F.struct(*cells)))


def read_group(spark: SparkSession, feed: str, header: Header, paths: list[str]) -> DataFrame:
    """The rows of files with one header in the feed's columns, with the rescue column and ``_source_file``."""
    types = {f.name: f.dataType for f in feed_schema(feed, with_rescue=False)}
    fields, extra = [], {}
    for i, (known, name) in enumerate(zip(header.known, header.names)):
        column = known or f"__extra_{i}"
        fields.append(StructField(column, types.get(known, StringType()), True))
        if known is None:
            extra[column] = name
    options = csv_options(feed) | {"enforceSchema": "true", "columnNameOfCorruptRecord": RECORD}   # names were matched above
    rows = spark.read.schema(StructType([*fields, StructField(RECORD, StringType(), True)])).options(**options).csv(paths)
    return rows.select(*[(F.col(c) if c in header.known else F.lit(None).cast(t)).alias(c) for c, t in types.items()],
                       _rescued(extra).alias(RESCUE_COLUMN), F.col("_metadata.file_path").alias("_source_file"))


def read_mapped(spark: SparkSession, feed: str, paths: list[str]) -> DataFrame:
    """All rows of the files, whatever their headers."""
    out = spark.createDataFrame([], feed_schema(feed).add("_source_file", StringType()))
    for header, files in inventory(spark, paths, feed).items():
        if header.names:
            out = out.unionByName(read_group(spark, feed, header, files))
    return out

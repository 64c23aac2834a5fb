"""WARC archives with a two-level capture index.

Archives: one gzip member per record (WARC/1.1). A ``response`` record's block
is an HTTP response with the payload; a ``revisit`` has the same HTTP header,
whose Content-Length is the payload's, and no body. Of records with equal
payloads of at least ``min_bytes`` bytes that with the largest page id is the
response and the others revisit it; smaller ones are all responses.

Index: captures are range-partitioned and sorted by reversed-host URL key, page
id, file and offset; each partition writes blocks of ``BLOCK`` captures, each
block compressed on its own, and returns one directory row per block (first
key, file, offset, length). A search is a binary search in the directory,
range reads of the blocks that can hold the key, and range reads of the
records. ``read_back`` reads every record that way, block by block in parallel,
in file order.

Recovery: archives and blocks get names of their own and count only once they
are in the stored manifest, so a task that runs again leaves at most an unused
file. The page ids that repeat payloads refer to are broadcast when a count
shows at most ``MAX_BROADCAST`` of them, else joined (Spark splits a hot digest).

Defined results: null html is an empty payload; a null URL has the empty key
and no target header; rows that repeat the largest page id with an equal
payload are all responses; with null ids only, all are responses; an empty
table gives no file and an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import read_table, shared_folder, whole

BLOCK = 3000
LEVEL = 4
MIN_BYTES = 1000
MAX_BROADCAST = 1_000_000
DATE = "2024-01-01T00:00:00Z"
CAPTURE = "key string, page_id long, file string, offset long, length long"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query: ``org,example,www)/a?b``. Empty for null."""
    if url is None:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return url
    at = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return f"{at}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def _header_value(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit when ``refers_to`` is given."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def parse(member: bytes) -> dict:
    """The capture that a record holds: page_id, payload, payload_bytes, payload_digest, record_type, refers_to."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, stated = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != stated:
        raise ValueError(f"payload digest differs: {fields['warc-record-id']}")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("x-page-id"), "payload": payload if kind == "response" else None, "payload_digest": stated,
            "payload_bytes": len(payload) if kind == "response" else int(_fields(http)["content-length"]),
            "record_type": kind, "refers_to": number("x-refers-to-page-id")}


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Writes the archives under ``folder``; the stored captures (key, page_id, file, offset, length)."""
    import pyarrow as pa

    spark = pages.sparkSession
    payload = whole(F.col(html)).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    same = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    same.select(F.col("digest").alias("d"), "first").write.parquet(f"{folder}-repeats")
    repeats = spark.read.parquet(f"{folder}-repeats")
    repeats = F.broadcast(repeats) if repeats.count() <= MAX_BROADCAST else repeats
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    rows = rows.join(repeats, F.col("digest") == F.col("d"), "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        place, at = _open(folder)
        place.create_dir(at, recursive=True)
        name, offset = f"pages-{uuid.uuid4().hex}.warc.gz", 0
        with place.open_output_stream(f"{at}/{name}", compression=None) as out:
            for b in itertools.chain([first], batches):
                made = []
                for i in range(b.num_rows):
                    page, link, data, digest, ref = (c[i].as_py() for c in b.columns)
                    member = record(page, link, data, digest, ref)
                    out.write(member)
                    made.append((_header_value(url_key(link)), page, name, offset, len(member)))
                    offset += len(member)
                k, p, f, o, n = zip(*made)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(p, pa.int64()), pa.array(f), pa.array(o, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["key", "page_id", "file", "offset", "length"])

    rows.mapInArrow(run, CAPTURE).write.parquet(f"{folder}-captures")
    return spark.read.parquet(f"{folder}-captures")


def write_index(captures: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Writes the sorted, compressed blocks under ``folder``; the stored sparse directory, one row per block."""
    import pyarrow as pa

    spark = captures.sparkSession
    order = ["key", "page_id", "file", "offset"]
    rows = captures.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, "length", F.spark_partition_id().alias("part"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = lines(batches)
        first = next(rest, None)
        if first is None:
            return
        rest = itertools.chain([first], rest)
        place, at = _open(folder)
        place.create_dir(at, recursive=True)
        name, offset, made = f"index-{uuid.uuid4().hex}.cdx.gz", 0, []
        with place.open_output_stream(f"{at}/{name}", compression=None) as out:
            while some := list(itertools.islice(rest, block)):
                body = "\n".join("\t".join((k, "" if p is None else str(p), f, str(o), str(n))) for k, p, f, o, n, _ in some)
                data = zlib.compress(body.encode(), LEVEL)
                out.write(data)
                made.append((first[5], len(made), some[0][0], name, offset, len(data)))
                offset += len(data)
        part, no, key, file, off, n = zip(*made)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(no, pa.int64()), pa.array(key), pa.array(file), pa.array(off, pa.int64()),
                                          pa.array(n, pa.int64())], names=["part", "no", "key", "file", "offset", "length"])

    rows.mapInArrow(run, "part long, no long, key string, file string, offset long, length long").write.parquet(f"{folder}-directory")
    return spark.read.parquet(f"{folder}-directory")


def read_block(place, at: str, file: str, offset: int, length: int) -> list[tuple[str, int | None, str, int, int]]:
    """The captures of one index block."""
    with place.open_input_file(f"{at}/{file}") as f:
        body = zlib.decompress(f.read_at(length, offset)).decode()
    split = (x.split("\t") for x in body.split("\n"))
    return [(k, int(p) if p else None, f, int(o), int(n)) for k, p, f, o, n in split]


class Search:
    """Look-up of captures by URL or key prefix; holds the sparse directory only."""

    def __init__(self, directory: DataFrame, index: str, archives: str) -> None:
        self.blocks = [tuple(r) for r in directory.orderBy("part", "no").select("key", "file", "offset", "length").collect()]
        self.keys = [b[0] for b in self.blocks]  # UTF-8 order equals code-point order
        self.index, self.archives = _open(index), _open(archives)

    def captures(self, key: str, prefix: bool = False) -> list[tuple[str, int | None, str, int, int]]:
        key = _header_value(key)
        hit = (lambda k: k.startswith(key)) if prefix else (lambda k: k == key)
        out = []
        # the block before the first one that starts at the key or later can end with it
        for i in range(max(0, bisect_left(self.keys, key) - 1), len(self.blocks)):
            if self.keys[i] > key and not hit(self.keys[i]):
                break
            rows = read_block(*self.index, *self.blocks[i][1:])
            out += [r for r in rows[bisect_left(rows, (key,)):] if hit(r[0])]
        return out

    def records(self, url: str) -> list[dict]:
        place, at = self.archives
        out = []
        for _, _, file, offset, length in self.captures(url_key(url)):
            with place.open_input_file(f"{at}/{file}") as f:
                out.append(parse(f.read_at(length, offset)))
        return out


TASK_BYTES = 16 << 20        # of archives that one task reads
DIRECTORY_ROWS = 1 << 18     # of the sparse directory that tasks search at once


def blocks_of(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """(file, offset, length, wanted): the index blocks that can hold each key, found by binary search in the directory.

    A key's captures lie in the block before the first one that begins with it or later, and in all that begin with it.
    A directory of more than ``DIRECTORY_ROWS`` blocks is searched in slices, so no task holds more of it.
    """
    import pyarrow as pa

    ordered = directory.orderBy("part", "no").select("key", "file", "offset", "length")
    slices = -(-directory.count() // DIRECTORY_ROWS)
    out = None
    for i in range(slices):
        rows = [tuple(r) for r in ordered.offset(i * DIRECTORY_ROWS).limit(DIRECTORY_ROWS).collect()]
        first = [r[0] for r in rows]

        def run(batches: Iterator[pa.RecordBatch], rows=rows, first=first) -> Iterator[pa.RecordBatch]:
            for b in batches:
                made = []
                for key in b.column("key").to_pylist():
                    at = max(0, bisect_left(first, key) - 1)
                    while at < len(first) and (first[at] <= key):
                        made.append((*rows[at][1:], key))
                        at += 1
                if made:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["file", "offset", "length", "key"])

        found = keys.mapInArrow(run, "file string, offset long, length long, key string")
        out = found if out is None else out.unionAll(found)
    if out is None:
        out = keys.select("key", F.lit("").alias("file"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("length")).where("false")
    # a block lists its own keys and at most one that only begins in the next block
    return out.groupBy("file", "offset", "length").agg(F.collect_set("key").alias("wanted"))


def look_up(keys: DataFrame, directory: DataFrame, index: str, archives: str, archive_bytes: int = 0) -> DataFrame:
    """The records of all captures of ``keys`` (column key, distinct): directory, then index blocks, then range reads in archive order.

    The records are dealt out by the bytes of the archives, not of their index entries, which are a thousandth of them.
    """
    import pyarrow as pa

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at = _open(index)
        for b in batches:
            for *block, wanted in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length", "wanted"))):
                wanted = set(wanted)
                hits = [(f, o, n) for k, _, f, o, n in read_block(place, at, *block) if k in wanted]
                if hits:
                    f, o, n = zip(*hits)
                    yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(o, pa.int64()), pa.array(n, pa.int64())], names=["file", "offset", "length"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at = _open(archives)
        name, file = None, None
        for b in batches:
            out = []
            for f, o, n in zip(*(c.to_pylist() for c in b.columns)):
                if f != name:
                    if file is not None:
                        file.close()
                    name, file = f, place.open_input_file(f"{at}/{f}")
                r = parse(file.read_at(n, o))
                out.append((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if file is not None:
            file.close()

    entries = blocks_of(keys, directory).mapInArrow(expand, "file string, offset long, length long")
    entries = entries.repartitionByRange(1 + archive_bytes // TASK_BYTES, "file", "offset").sortWithinPartitions("file", "offset")
    return entries.mapInArrow(fetch, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = shared_folder(spark, "warc")
    captures = write_archives(read_table(spark, sf_dir, "pages"), archives)
    directory = write_index(captures, f"{archives}-index")
    size = captures.agg(F.sum("length")).first()[0] or 0
    return look_up(captures.select("key").distinct(), directory, f"{archives}-index", archives, size)


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t FROM pages
), d AS (
  SELECT page_id, octet_length(encode(t)) AS n, sha1(t) AS digest FROM p
), m AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS last FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM m
"""

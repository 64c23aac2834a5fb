"""Token ids in seekable files: independent zstandard frames, a trailing seek table, per-frame checksums.

File layout (all integers little-endian):

* data frames: each an independent zstandard frame with the ids of some whole
  documents, unsigned 32-bit, one after the other. A frame closes at
  ``FRAME_IDS`` ids; a longer document has a frame of its own;
* a directory of the documents (id or null, number of ids, frame), compressed,
  in a skippable frame (magic 0x184D2A50);
* the seek table of the public zstandard seekable format: a skippable frame
  (magic 0x184D2A5E) with compressed size, content size and checksum (low 32
  bits of XXH64 of the content) of each frame before it, then the number of
  frames, a descriptor byte and the magic 0x8F92EAB1. The directory's frame is
  the last entry, with content size 0 and the checksum of its payload.

A plain zstandard reader still decodes the whole file. ``read_documents``
decompresses only the frames that hold the wanted documents.

Documents are range-partitioned and sorted by id (then by a hash of the text),
each partition writes one file under a name of its own and returns a manifest
row; only files named in the stored manifest count, so a task that is run
again after a lost executor leaves at most an unused file. The driver sees one
manifest row per file.

Encoding uses the tokenizers library. Text is cut where a space stands between
two other characters and at the tokenizer's own word boundaries, which its
merges never cross, and equal pieces are encoded once per worker (bounded
memo); ``encode`` therefore equals encoding the whole text. By default a special
token's name inside a text is ordinary text (``plain_special``); the query takes
the library's default, which gives it the token's own id.

Defined results: null and empty texts have only the end id; null ids come
first; rows with equal ids stay separate, next to each other; an empty table
gives no file and an empty result; other columns are not read.
"""

from __future__ import annotations

import contextlib
import gc
import itertools
import json
import re
import struct
import sys
import types
import uuid
from collections import Counter
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import read_table, shared_folder, whole

FRAME_IDS = 1 << 16
END_ID = 0
MEMO_BYTES = 260 << 20  # what a worker remembers of pieces and their ids
MEMO_CHARS = 64         # longer pieces aren't remembered
ENTRY_BYTES = 220       # of a piece with its ids: two objects and their place
WORDS_AT_ONCE = 256     # of words in one text for the library
BATCH_CHARS = 2_000_000
ENCODE_CHARS = 50_000   # of texts encoded at once: their pieces stay in a core's cache from cut to join
BATCH_ROWS = 512  # texts handed to Python at once
SKIP_DIRECTORY, SKIP_SEEK, SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
TOKENIZER = "byte_bpe_50k.json"

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The word boundaries of byte-level BPE tokenizers with the GPT-2 pattern, in the standard library's syntax.
WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# Outside plain white space, ASCII, Latin letters and common punctuation two regex engines may differ: left to the library.
ODD = re.compile("[^\t-\r -~\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf-\u024f]")
FIRST = "\0"  # marks what has no space before it; an odd character, so in no piece
MARKS = frozenset(",.;:!?")
SPACE = "\u0120"  # how byte-level tokenizers write a space
GAPS = re.compile(r" \s|\s ")


def _gaps(text: str) -> bool:
    """True when a space stands beside other white space."""
    if any(c in text for c in "\t\r\x0b\x0c"):
        return GAPS.search(text) is not None
    return "  " in text or " \n" in text or "\n " in text


def _missing(ids: list[bytes | None]) -> list[int]:
    """Where ``ids`` has no value."""
    where, at = [], -1
    with contextlib.suppress(ValueError):   # raised behind the last one
        while True:
            at = ids.index(None, at + 1)
            where.append(at)
    return where


class Encoder:
    """Ids of whole texts as little-endian bytes, with a memo of pieces."""

    def __init__(self, path: str, plain_special: bool = True, memo_bytes: int = MEMO_BYTES) -> None:
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_special
        with open(path) as f:
            spec = json.load(f)
        added = [t for t in spec.get("added_tokens") or [] if not (plain_special and t["special"])]
        self.added = re.compile("|".join(re.escape(t["content"]) for t in added)) if added else None
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                         and spec.get("normalizer") is None and spec.get("post_processor") is None)
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)   # tokens that begin with a space
        self.begins[[i for t, i in vocabulary.items() if t[0] == SPACE]] = True
        self.known: dict[str, bytes] = {}
        self.held, self.memo_bytes = 0, memo_bytes
        self.marks = dict(zip(sorted(MARKS), self._library(sorted(MARKS))))

    def _library(self, texts: list[str]) -> list[bytes]:
        from array import array

        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in made]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Lists of pieces hold no cycles: the collector, which would walk them again and again, rests."""
        resting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if resting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        easy = [self.by_piece and not _gaps(t) and not ODD.search(t) and not (self.added and self.added.search(t)) for t in texts]
        known, split, found, gaps = self.known, [], [], []
        for t, e in zip(texts, easy):  # one look-up a piece; what is missing is filled in below
            pieces = t.split(" ") if e else []
            if pieces:
                pieces[0] = FIRST + pieces[0]
            ids = list(map(known.get, pieces))
            split.append(pieces)
            found.append(ids)
            gaps.append(_missing(ids))
        new = {pieces[i] for pieces, where in zip(split, gaps) for i in where}
        made = self._pieces(new)
        hard = iter(self._library([t for t, e in zip(texts, easy) if not e]))
        for pieces, ids, where in zip(split, found, gaps):
            for i in where:
                ids[i] = made[pieces[i]]
        out = [b"".join(ids) if e else next(hard) for ids, e in zip(found, easy)]
        if self.held > self.memo_bytes:
            self._forget()
        return out

    def _pieces(self, new: set[str]) -> dict[str, bytes]:
        """The ids of pieces that aren't remembered; they and their words are from now on.

        A piece or word stands for itself behind a space; one without a space before it has FIRST there.
        """
        known, marks, marked, cut, words = self.known, self.marks, [], [], {}
        for p in new:
            if p.isalpha():   # the usual pieces: a word, and a word with a mark
                words[p] = None
                continue
            if p[-1:] in marks and (body := p[:-1]).isalpha():
                marked.append(p)
                if body not in known:
                    words[body] = None
                continue
            ws = [w[1:] if w[0] == " " else FIRST + w for w in WORDS.findall(p[1:] if p[:1] == FIRST else " " + p)]
            if len(ws) == 1:
                words[p] = None
            else:
                cut.append((p, ws))
                for w in ws:
                    words[w] = known.get(w)
        unknown = [w for w, ids in words.items() if ids is None]
        words.update(zip(unknown, self._words(unknown)))
        made = [(p, b"".join([words[w] for w in ws])) for p, ws in cut]
        words.update(made)
        for p in marked:
            body = p[:-1]
            words[p] = (words.get(body) or known[body]) + marks[p[-1]]
        short = words if max(map(len, words), default=0) <= MEMO_CHARS else {p: ids for p, ids in words.items() if len(p) <= MEMO_CHARS}
        before = len(known)
        known.update(short)
        self.held += (len(known) - before) * ENTRY_BYTES
        return words

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of single words. Those that begin with a space are handed on many at a time: their first tokens tell them apart."""
        import numpy as np

        spaced = [w for w in words if w and w[0] != FIRST]
        found: dict[str, bytes] = {}
        for low in range(0, len(spaced), WORDS_AT_ONCE):
            some = spaced[low:low + WORDS_AT_ONCE]
            data = self._library([" " + " ".join(some)])[0]
            begins = (np.flatnonzero(self.begins[np.frombuffer(data, np.uint32)]) * 4).tolist()
            if len(begins) != len(some):
                raise ValueError("words and tokens that begin with a space differ in number")
            found.update(zip(some, map(data.__getitem__, map(slice, begins, [*begins[1:], len(data)]))))
        other = [w for w in words if w not in found]
        found.update(zip(other, self._library([w[1:] if w else " " for w in other])))
        return [found[w] for w in words]

    def _forget(self) -> None:
        """Half of the memory is freed; the shorter pieces stay, which come again most."""
        lengths, left, longest = Counter(map(len, self.known)), self.memo_bytes // 2, 0
        for longest in sorted(lengths):
            left -= lengths[longest] * ENTRY_BYTES
            if left < 0:
                break
        gone = -(left // ENTRY_BYTES) if left < 0 else 0   # of the longest that stay some go
        drop = [p for p in self.known if len(p) > longest]
        drop += itertools.islice((p for p in self.known if len(p) == longest), gone)
        for p in drop:
            del self.known[p]
        self.held = len(self.known) * ENTRY_BYTES


def _encoder(path: str, plain_special: bool, memo_bytes: int = MEMO_BYTES) -> Encoder:
    """One encoder per Python worker, so its memo outlives a task."""
    held = sys.modules.setdefault("_token_file_encoders", types.ModuleType("_token_file_encoders"))
    key = f"{path} {plain_special} {memo_bytes}"
    if key not in held.__dict__:
        held.__dict__[key] = Encoder(path, plain_special, memo_bytes)
    return held.__dict__[key]


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class FileWriter:
    """Writes one file; documents are added in order."""

    def __init__(self, stream) -> None:
        import zstandard

        self.stream, self.zstd = stream, zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.pending: list[bytes] = []
        self.ids = self.n_ids = self.n_bytes = 0
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        if self.pending and self.ids + n > FRAME_IDS:
            self._frame()
        self.docs.append((doc_id, n, len(self.table)))
        self.pending.append(ids)
        self.ids += n
        self.n_ids += n

    def _frame(self) -> None:
        from xxhash import xxh64_intdigest

        content = b"".join(self.pending)
        data = self.zstd.compress(content)
        self._write(data)
        self.table.append((len(data), len(content), xxh64_intdigest(content) & 0xFFFFFFFF))
        self.pending, self.ids = [], 0

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.n_bytes += len(data)

    def close(self) -> None:
        import numpy as np
        from xxhash import xxh64_intdigest

        if self.pending:
            self._frame()
        known = np.array([d[0] is not None for d in self.docs], "u1")
        columns = [known, np.array([d[0] or 0 for d in self.docs], "<i8"), np.array([d[1] for d in self.docs], "<u4"),
                   np.array([d[2] for d in self.docs], "<u4")]
        payload = self.zstd.compress(struct.pack("<I", len(self.docs)) + b"".join(c.tobytes() for c in columns))
        self._write(struct.pack("<II", SKIP_DIRECTORY, len(payload)) + payload)
        self.table.append((len(payload) + 8, 0, xxh64_intdigest(payload) & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        foot = struct.pack("<IBI", len(self.table), 0x80, SEEK_END)
        self._write(struct.pack("<II", SKIP_SEEK, len(entries) + len(foot)) + entries + foot)


class FileReader:
    """Random access to one file; every frame that is read is checked."""

    def __init__(self, file) -> None:
        import numpy as np
        import zstandard

        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEK_END or flags != 0x80:
            raise ValueError("no seek table")
        raw = file.read_at(12 * n, size - 9 - 12 * n)
        self.table = list(struct.iter_unpack("<III", raw))
        self.offsets = [0, *itertools.accumulate(e[0] for e in self.table)]
        payload = self._raw(n - 1)[8:]
        self._check(n - 1, payload)
        body = self.zstd.decompress(payload)
        (d,) = struct.unpack_from("<I", body)
        known = np.frombuffer(body, "u1", d, 4).astype(bool)
        ids = np.frombuffer(body, "<i8", d, 4 + d)
        self.counts = np.frombuffer(body, "<u4", d, 4 + 9 * d)
        self.frames = np.frombuffer(body, "<u4", d, 4 + 13 * d)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]

    def _raw(self, frame: int) -> bytes:
        return self.file.read_at(self.table[frame][0], self.offsets[frame])

    def _check(self, frame: int, content: bytes) -> None:
        from xxhash import xxh64_intdigest

        if xxh64_intdigest(content) & 0xFFFFFFFF != self.table[frame][2]:
            raise ValueError(f"checksum of frame {frame} differs")

    def documents(self, wanted: set[int | None] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc id, ids before it in the file, ids) of the wanted documents, default all, in file order."""
        start, now, content, at = 0, -1, b"", 0
        for doc, n, frame in zip(self.doc_ids, self.counts.tolist(), self.frames.tolist()):
            if now != frame:
                now, content, at = frame, None, 0
            if wanted is None or doc in wanted:
                if content is None:
                    content = self.zstd.decompress(self._raw(frame), max_output_size=max(1, self.table[frame][1]))
                    self._check(frame, content)
                yield doc, start, content[at:at + 4 * n]
            at += 4 * n
            start += n


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Actions inside hand at most ``rows`` rows to Python at once, so long texts stay few in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                      plain_special: bool = True, memo_bytes: int = MEMO_BYTES, batch_chars: int = ENCODE_CHARS) -> DataFrame:
    """Writes the files under ``folder``; the stored manifest, one row per file, in file order.

    A worker remembers pieces in about ``memo_bytes`` and encodes texts of ``batch_chars`` at once (one text at least):
    both move memory and time only.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<I", END_ID)
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part, coder = first.column("part")[0].as_py(), _encoder(tokenizer, plain_special, memo_bytes)
        place, at = _filesystem(folder)
        place.create_dir(at, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.zst"
        with place.open_output_stream(f"{at}/{name}", compression=None) as out:
            writer = FileWriter(out)
            for b in itertools.chain([first], batches):
                ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
                chars = [0, *itertools.accumulate(map(len, texts))]
                low = 0
                while low < len(texts):
                    high = low + 1
                    while high < len(texts) and chars[high + 1] - chars[low] <= batch_chars:
                        high += 1
                    for doc, made in zip(ids[low:high], coder.encode(texts[low:high])):
                        writer.add(doc, made + end)
                    low = high
            writer.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "name": [name], "n_docs": [len(writer.docs)],
                                          "n_ids": [writer.n_ids], "bytes": [writer.n_bytes]})

    made = rows.mapInArrow(run, "part long, name string, n_docs long, n_ids long, bytes long")
    with small_batches(spark, BATCH_ROWS):
        made.write.parquet(f"{folder}-manifest")
    return spark.read.parquet(f"{folder}-manifest").orderBy("part")


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) of the wanted documents, default all, read from the files; ids as bytes."""
    import pyarrow as pa

    files = manifest.collect()  # one short row per file
    starts = [0, *itertools.accumulate(r["n_ids"] for r in files)]
    todo = spark.createDataFrame([(r["name"], s) for r, s in zip(files, starts)], "name string, first long")
    todo = todo.repartition(max(1, len(files)), "name")
    chosen = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at = _filesystem(folder)
        for b in batches:
            for name, first in zip(b.column("name").to_pylist(), b.column("first").to_pylist()):
                with place.open_input_file(f"{at}/{name}") as f:
                    found = FileReader(f).documents(chosen)
                    while some := list(itertools.islice(found, 256)):
                        yield pa.RecordBatch.from_arrays([pa.array([d for d, _, _ in some], pa.int64()),
                                                          pa.array([first + s for _, s, _ in some], pa.int64()),
                                                          pa.array([i for _, _, i in some], pa.binary())],
                                                         names=["doc_id", "start", "ids"])

    return todo.mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, plain_special: bool = True,
               memo_bytes: int = MEMO_BYTES, batch_chars: int = ENCODE_CHARS) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, from the files it writes."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    folder = shared_folder(spark, "tokens")
    manifest = write_token_files(docs, folder, tokenizer, plain_special=plain_special, memo_bytes=memo_bytes, batch_chars=batch_chars)
    back = read_documents(spark, folder, manifest)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, read_table(spark, sf_dir, "documents"), plain_special=False)

"""An optimistic commit log on shared storage: writers prepare data, then race for the next version.

``<root>/_log/<version>.json`` holds one entry per commit. A writer reads the
entries, writes its data to folders of its own, and creates the file of the next
version; creation is atomic and fails when the file exists, so exactly one of
several writers gets a version. The others read the new entry, prepare again and
try the next one. Readers use only folders named in entries, so what a failed or
late writer left is never seen.

Local paths are committed with a hard link, other file systems with a rename
that must not replace its target (atomic on HDFS; an object store needs a
file-system client that makes it so).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

Entry = dict


class CommitConflict(RuntimeError):
    """Another writer got the version."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = f"{self.root}/_log"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(self._conf)

    def _file(self, version: int) -> str:
        return f"{self.folder}/{version:020d}.json"

    def _read(self, version: int) -> Entry:
        stream = self._fs.open(self._path(self._file(version)))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def last(self) -> int:
        """The newest version, 0 before the first."""
        if not self._fs.exists(self._path(self.folder)):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."), default=0)

    def entry(self, version: int | None = None) -> Entry | None:
        """The entry of a version (default: the newest), with its ``version``; None before the first."""
        version = self.last() if version is None else version
        return self._read(version) | {"version": version} if version else None

    def entries(self) -> list[Entry]:
        """The entries that make up the present state, oldest first: back to the newest one that replaces all before it."""
        out: list[Entry] = []
        for version in range(self.last(), 0, -1):
            out.append(self._read(version) | {"version": version})
            if out[-1].get("replaces"):
                break
        return out[::-1]

    def create(self, version: int, entry: Entry) -> None:
        """Write the entry of ``version``, or raise CommitConflict when another writer has."""
        text = json.dumps({k: v for k, v in entry.items() if k != "version"})
        draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"
        if self._fs.getScheme() == "file":
            local = lambda p: self._path(p).toUri().getPath()
            os.makedirs(local(self.folder), exist_ok=True)
            with open(local(draft), "w") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(local(draft), local(self._file(version)))
            except FileExistsError:
                raise CommitConflict(f"version {version} of {self.root} is taken") from None
            finally:
                os.unlink(local(draft))
            return
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(draft).toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(draft), self._path(self._file(version)), none)
        except Exception as e:   # a Java exception, or Spark's wrapper of one
            self._fs.delete(self._path(draft), False)
            if "FileAlreadyExists" not in (str(e) if not isinstance(e, PySparkException) else repr(e)):
                raise
            raise CommitConflict(f"version {version} of {self.root} is taken") from None

    def append(self, prepare: Callable[[list[Entry]], Entry | None], attempts: int = 100) -> Entry | None:
        """Commit what ``prepare`` makes of the entries so far; prepared anew when another writer came first.

        ``prepare`` returns None when there is nothing to commit.
        """
        for _ in range(attempts):
            before = self.entries()
            entry = prepare(before)
            if entry is None:
                return None
            version = before[-1]["version"] + 1 if before else 1
            try:
                self.create(version, entry)
            except CommitConflict:
                continue
            return entry | {"version": version}
        raise CommitConflict(f"no version of {self.root} in {attempts} attempts")

    def folder_for_data(self, name: str = "data") -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

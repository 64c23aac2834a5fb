"""Versioned publishing: outputs go to a new folder, and one small atomic commit switches readers to it.

The commit log of a root names a run folder per version. A version is
committed only when the run is complete and checked, so a failed run leaves the
former version served, and of two publishers one gets the version and the other
an error. Old run folders stay until removed, so versions can be compared.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from .commitlog import CommitLog


def new_run(root: str) -> str:
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"


def current(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, run folder) that readers get, or None."""
    now = CommitLog(spark, root).entry()
    return (now["version"], now["run"]) if now else None


def run_of(spark: SparkSession, root: str, version: int) -> str:
    """The run folder of a version."""
    return CommitLog(spark, root).entry(version)["run"]


def counts(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows per table of the published version, as counted while they were written."""
    return CommitLog(spark, root).entry()["counts"]


def publish(spark: SparkSession, root: str, run: str, after: int | None = None, counts: dict[str, int] | None = None,
            stored: dict[str, list[str]] | None = None) -> int:
    """Switch readers of ``root`` to the finished run folder; returns its version.

    ``after`` is the version that the publisher started from (default: the newest one): when another publisher has
    committed since, CommitConflict is raised and nothing changes.
    """
    log = CommitLog(spark, root)
    version = (log.last() if after is None else after) + 1
    log.create(version, {"run": run, "counts": counts or {}, "stored": stored or {}})
    return version

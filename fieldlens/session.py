"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # many small partitions to begin with; AQE merges what is too small
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fieldlens", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests. On a cluster, spark-submit supplies the master."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, list] = {}   # session -> writers inside, the setting before the first of them
_freeing_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as soon as they are done.

    Without it they stay on the disks until the driver's garbage collector finds the plan, so a job of several writes
    holds the shuffles of all of them. Only for frames that are written once: one that runs again shuffles again.
    """
    session = spark._jsparkSession.sessionUUID()
    with _freeing_lock:
        inside = _freeing.setdefault(session, [0, spark.conf.get(FREE_SHUFFLES, None)])
        inside[0] += 1
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            inside[0] -= 1
            if not inside[0]:
                del _freeing[session]
                spark.conf.unset(FREE_SHUFFLES) if inside[1] is None else spark.conf.set(FREE_SHUFFLES, inside[1])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read as is. Only
    when it is unset (local tests) is a private folder created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="fieldlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's outputs."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    path = f"{root}{sep}{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path

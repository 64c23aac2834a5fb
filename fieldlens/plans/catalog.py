"""Named tables of the medallion flow and their dependencies.

``Lakehouse`` resolves a table name to a lazy DataFrame built from its
inputs; nothing runs until an action. ``refresh`` materialises the silver and
gold tables to Parquet in dependency order (full-refresh semantics) and
swaps each in-memory entry for a read of what was written, so every
downstream table reads the stored columns instead of recomputing the chain.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..operators import extract as X
from ..functions.common import aggregate_by, path_has_files
from ..operators import gold as G
from ..operators import governance as GOV
from ..operators import silver as S
from ..session import shuffles_freed
from ..sources.feeds import FEEDS
from ..sources.tables import StarTables
from ..sources.testbind import bind_feed
from . import publish as PB

BRONZE = {f"bronze_{f}": f for f in FEEDS}


class Lakehouse:
    def __init__(self, spark: SparkSession, sf_dir: str | None, settings: Settings = DEFAULT,
                 extractor=None, bronze_paths: dict[str, str] | None = None,
                 extract_cache: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.inputs: str | None = None   # state of the input files that this graph was built for
        self.extract_cache = extract_cache
        self.settings = settings
        self.extractor = extractor
        self.star = StarTables(spark, sf_dir)
        self.bronze_paths = bronze_paths or {}
        self._tables: dict[str, DataFrame] = {}
        self._stored: set[str] = set()   # tables that a refresh has written
        self._bronze_counts: dict[str, Observation] = {}
        s = settings
        t = self.table
        self.builders: dict[str, tuple[list[str], Callable[[], DataFrame]]] = {
            "silver_hcp": (["bronze_hcp_master"], lambda: S.silver_hcp(t("bronze_hcp_master"))),
            "silver_inquiries": (["bronze_medical_inquiries"],
                                 lambda: S.silver_inquiries(t("bronze_medical_inquiries"), s)),
            "silver_congress": (["bronze_congress_events"], lambda: S.silver_congress(t("bronze_congress_events"))),
            "silver_digital": (["bronze_digital_engagement"],
                               lambda: S.silver_digital(t("bronze_digital_engagement"))),
            "silver_publications": (["bronze_publications_trials"],
                                    lambda: S.silver_publications(t("bronze_publications_trials"))),
            "silver_claims": (["bronze_patient_claims_summary"],
                              lambda: S.silver_claims(t("bronze_patient_claims_summary"))),
            "silver_content": (["bronze_approved_content"], lambda: S.silver_content(t("bronze_approved_content"))),
            "silver_content_shared": (["bronze_content_shared"],
                                      lambda: S.silver_content_shared(t("bronze_content_shared"))),
            "silver_extracted": (["bronze_msl_interactions"], self._extracted),
            "gold_inquiries": (["silver_inquiries"], lambda: G.gold_inquiries(t("silver_inquiries"))),
            "gold_publications": (["silver_publications"], lambda: G.gold_passthrough(t("silver_publications"))),
            "gold_content": (["silver_content"], lambda: G.gold_passthrough(t("silver_content"))),
            "gold_content_shared": (["silver_content_shared"],
                                    lambda: G.gold_passthrough(t("silver_content_shared"))),
            "note_rollup": (["silver_extracted"], lambda: self._by_hcp("silver_extracted", lambda rows: G.note_rollup(rows, s))),
            # rollups that several tables read: a refresh makes each once
            "msl_rollup": (["note_rollup"], lambda: G.msl_rollup(t("note_rollup"), s)),
            "congress_rollup": (["silver_congress"], lambda: self._by_hcp("silver_congress", G.congress_rollup)),
            "digital_rollup": (["silver_digital"], lambda: G.digital_rollup(t("silver_digital"))),
            "inquiry_rollup": (["silver_inquiries"], lambda: G.inquiry_rollup(t("silver_inquiries"))),
            "pubs_rollup": (["silver_publications"], lambda: G.pubs_tracked(t("silver_publications"))),
            "interaction_summary": (["msl_rollup"], lambda: G.interaction_summary(t("msl_rollup"))),
            "topic_interest": (["note_rollup"], lambda: G.topic_interest(t("note_rollup"), s)),
            "congress_engagement": (["congress_rollup", "silver_hcp"], lambda: G.congress_engagement(
                t("congress_rollup"), t("silver_hcp"))),
            "channel_engagement": (
                ["silver_hcp", "digital_rollup", "msl_rollup", "congress_rollup", "inquiry_rollup"],
                lambda: G.channel_engagement(t("silver_hcp"), t("digital_rollup"), t("msl_rollup"), t("congress_rollup"),
                                             t("inquiry_rollup"), s)),
            "hcp_profile": (
                ["silver_hcp", "msl_rollup", "digital_rollup", "congress_rollup", "inquiry_rollup", "pubs_rollup"],
                lambda: G.profile_of_rollups(t("silver_hcp"), t("msl_rollup"), t("digital_rollup"), t("congress_rollup"),
                                             t("inquiry_rollup"), t("pubs_rollup"), s)),
            "hcp_360": (["hcp_profile"], lambda: G.hcp_360(t("hcp_profile"))),
            "hcp_priority": (["hcp_profile"], lambda: G.hcp_priority(t("hcp_profile"), s)),
            "next_best_engagement": (["hcp_profile"], lambda: G.next_best_engagement(t("hcp_profile"), s)),
            "territory_opportunity": (["hcp_profile", "silver_claims"], lambda: G.territory_opportunity(
                t("hcp_profile"), t("silver_claims"), s)),
        }

    def _extracted(self) -> DataFrame:
        notes = self.table("bronze_msl_interactions")
        if not self.extract_cache:
            return X.silver_extracted(notes, self.extractor)
        # the stored responses; `refresh` adds those of new notes before this table is built
        if not path_has_files(self.spark, self.extract_cache):
            return X.silver_extracted(notes, self.extractor)
        cache = self.spark.read.schema("note_hash STRING, extracted_raw STRING").parquet(self.extract_cache)
        return X.table_from_cache(notes, cache)

    def _by_hcp(self, name: str, rollup: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A rollup of a table's rows; those that are stored are shuffled once, as they are, by HCP."""
        rows = self.table(name)
        return aggregate_by(rows, ["hcp_id"], rollup) if name in self._stored else rollup(rows)

    def update_extract_cache(self) -> None:
        """Send the notes that the stored cache doesn't have to the extractor, each distinct one once."""
        if self.extract_cache:
            X.extract_incremental(self.spark, self.table("bronze_msl_interactions"), self.extract_cache, self.extractor)

    # -- resolution ---------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._build(name)
        return self._tables[name]

    def replace(self, name: str, table: DataFrame) -> None:
        """Use ``table`` for ``name`` in everything built from now on."""
        self._tables[name] = table

    def _build(self, name: str) -> DataFrame:
        if name in BRONZE:
            feed = BRONZE[name]
            if feed in self.bronze_paths:
                from ..sources.feeds import BATCH_COLUMN, bronze_schema
                from ..streaming.bronze import read_bronze

                path = self.bronze_paths[feed]
                if path_has_files(self.spark, path):
                    return read_bronze(self.spark, feed, path).drop(BATCH_COLUMN)
                return self.spark.createDataFrame([], bronze_schema(feed))  # nothing landed yet
            return bind_feed(self.star, feed, self.settings)
        if name not in self.builders:
            raise KeyError(f"unknown table {name!r}")
        return self.builders[name][1]()

    def order(self, targets: list[str] | None = None) -> list[str]:
        """Topological order of the derived tables needed for ``targets``."""
        out: list[str] = []

        def visit(n: str) -> None:
            if n in out or n in BRONZE:
                return
            for dep in self.builders[n][0]:
                visit(dep)
            out.append(n)

        for n in targets or list(self.builders):
            visit(n)
        return out

    def levels(self, targets: list[str] | None = None) -> list[list[str]]:
        """The tables of :meth:`order` grouped by dependency depth: a table's inputs all
        sit in earlier levels, so the tables of one level are independent."""
        depth: dict[str, int] = {}
        for n in self.order(targets):
            depth[n] = 1 + max((depth.get(d, 0) for d in self.builders[n][0]), default=0)
        out: list[list[str]] = [[] for _ in range(max(depth.values(), default=0))]
        for n, d in depth.items():
            out[d - 1].append(n)
        return out

    # -- full refresh -------------------------------------------------------
    def refresh(self, out_dir: str, targets: list[str] | None = None, parallel: int = 4,
                stored: dict[str, list[str]] | None = None) -> dict[str, str]:
        """Write every needed table once into a new run folder, in dependency order, then publish the folder.

        The tables of one dependency level are written by concurrent jobs (up to
        ``parallel``). Each written table replaces its in-memory plan with a read
        of the files, which also cuts lineage between layers. Classified tables
        carry their tags, and a masked copy is written beside each. Readers of
        ``published(spark, out_dir)`` get the new tables only after all of them
        are written: a failed run leaves the former version in place. The rows of every table, and of the bronze
        tables that they read, are counted while they are written (``Observation``) and kept in the published entry.
        A table's shuffles are removed when it is written.
        ``stored`` names the folders of tables that an incremental store keeps: they are published as they are.
        """
        stored = stored or {}
        from concurrent.futures import ThreadPoolExecutor

        run = PB.new_run(out_dir)
        before = PB.current(self.spark, out_dir)
        written: dict[str, str] = {}
        counts: dict[str, int] = {}
        for name, folders in stored.items():
            self._tables[name] = self.spark.read.parquet(*folders)
        for name in BRONZE:
            self._observed(name)
        if "silver_extracted" in self.order(targets) and "silver_extracted" not in stored:
            self.update_extract_cache()
        with shuffles_freed(self.spark), ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            for level in self.levels(targets):
                level = [name for name in level if name not in stored]
                frames = {name: self.table(name) for name in level}  # plans built on this thread
                plain, seen = frames, {name: Observation() for name in level}
                frames = {name: df.observe(seen[name], F.count(F.lit(1)).alias("rows")) for name, df in frames.items()}
                for name in [n for n in level if n in GOV.CLASSIFIED_TABLES]:
                    frames[name] = GOV.classify_derived(frames[name])
                    frames[f"{name}_masked"] = GOV.publishable(GOV.mask(GOV.classify_derived(plain[name]), self.settings.mask_key))
                paths = {name: os.path.join(run, name) for name in frames}
                jobs = [pool.submit(frames[n].write.option("compression", "zstd").parquet, paths[n]) for n in frames]
                for job in jobs:
                    job.result()
                for name in level:
                    self._tables[name] = self.spark.read.parquet(paths[name])
                self._stored.update(level)
                written.update(paths)
                counts.update({name: o.get["rows"] for name, o in seen.items()})
                for name in [n for n in self._bronze_counts if any(n in self.builders[t][0] for t in level)]:
                    counts[name] = self._bronze_counts.pop(name).get["rows"]
        PB.publish(self.spark, out_dir, run, before[0] if before else 0, counts, stored)
        return written

    def _observed(self, name: str) -> None:
        """Count a bronze table's rows in the one job that reads it."""
        readers = [t for t, (deps, _) in self.builders.items() if name in deps]
        if len(readers) == 1 and readers[0] not in self._tables:
            self._bronze_counts[name] = Observation()
            self._tables[name] = self.table(name).observe(self._bronze_counts[name], F.count(F.lit(1)).alias("rows"))


def published(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A table of the published refresh under ``out_dir``."""
    now = PB.CommitLog(spark, out_dir).entry()
    if now is None:
        raise ValueError(f"nothing is published under {out_dir}")
    return spark.read.parquet(*now["stored"].get(name, [os.path.join(now["run"], name)]))

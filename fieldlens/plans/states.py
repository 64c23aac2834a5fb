"""Incremental refresh of everything that comes from notes: mergeable partial states per HCP, topic and day.

A refresh extracts only notes that arrived since the last one, adds them up per
(HCP, topic, day) and commits the extracted rows, the states and how far it has
read in one entry of a commit log. Sums, counts and the newest note merge, so
the rollup of all notes, at any ``as_of``, follows from the stored states; no note is
read or extracted twice. A state row stands for all notes of a day, and
``compact`` merges what many refreshes left of the same day; days of one refresh only are copied as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.common import aggregate_by
from ..operators import gold as G
from ..session import shuffles_freed
from .commitlog import CommitLog

KEYS = ["hcp_id", "topic_category", "day"]
SUMS = ["n", "w_sum", "dur_sum", "dur_n", "follow_ups"]
STATES = "day-states"   # how folders of states are named; those of the former form are named "states"


def day_states(extracted: DataFrame) -> DataFrame:
    """The state of each (HCP, topic, day) of the extracted notes."""
    return extracted.groupBy("hcp_id", "topic_category", F.col("interaction_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(G.interest_weight()).alias("w_sum"),
        F.sum("duration_minutes").alias("dur_sum"), F.count("duration_minutes").alias("dur_n"),
        F.count(F.when(F.col("follow_up_requested"), 1)).alias("follow_ups"),
        F.max("sentiment").alias("max_sentiment"), F.max(G.whole_note()).alias("newest"))


def merged(states: DataFrame, keys: list[str], more: dict[str, Column] | None = None) -> DataFrame:
    """States of equal ``keys`` as one, with ``more`` aggregates of the merged rows."""
    return states.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("max_sentiment").alias("max_sentiment"),
        F.max("newest").alias("newest"), *[c.alias(name) for name, c in (more or {}).items()])


def rollup(states: DataFrame, s: Settings) -> DataFrame:
    """What ``gold.note_rollup`` makes of all notes, from their states, as of ``s.as_of``."""
    age = F.datediff(F.lit(s.as_of), F.col("day"))
    within = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    rows = merged(states, ["hcp_id", "topic_category"], {
        "n30": within(age <= s.recent_days), "n31_60": within(age.between(s.recent_days + 1, s.prior_days)),
        "n90": within(age <= s.reach_days), "n180": within(age <= s.half_year_days), "last_date": F.max("day")})
    return rows.select("*", G.latest_signals("newest").alias("latest"), G.briefing_note("newest").alias("brief")).drop("newest")


class NoteStates:
    """The store: one commit per refresh, each with the folders of its extracted rows and states."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.log = spark, CommitLog(spark, root)

    def through(self) -> int:
        """The newest batch of notes whose states are stored, -1 before the first."""
        entry = self.log.entry()
        return entry["through"] if entry else -1

    def update(self, through: int, extracted: Callable[[int], DataFrame]) -> dict | None:
        """Store the notes of the batches after the stored ones up to ``through``.

        ``extracted(after)`` gives their extracted rows. Extraction runs once, in the write of the rows; the states are
        made from what was written, those of an HCP and topic in one file, so a rollup adds them up before it shuffles them.
        When another refresh came first, the batches that it stored are left out.
        """
        def prepare(entries: list[dict]) -> dict | None:
            after = entries[-1]["through"] if entries else -1
            if through <= after:
                return None
            rows, states = self.log.folder_for_data("extracted"), self.log.folder_for_data(STATES)
            with shuffles_freed(self.spark):
                extracted(after).write.option("compression", "zstd").parquet(rows)
                made = aggregate_by(self.spark.read.parquet(rows), KEYS[:2], day_states)
                made.write.option("compression", "zstd").parquet(states)
            return {"extracted": [*(entries[-1]["extracted"] if entries else []), rows],
                    "states": [*(entries[-1]["states"] if entries else []), states], "through": through, "replaces": True}

        return self.log.append(prepare)

    def extracted(self) -> DataFrame:
        """All extracted rows, as stored."""
        return self.spark.read.parquet(*self.folders("extracted"))

    def states(self) -> DataFrame:
        return self._read(self.folders("states"))

    def _read(self, folders: list[str], *more: Column) -> DataFrame:
        """The states under ``folders``, with columns ``more`` of the files; those stored with two structs get the one that holds both."""
        now = [f for f in folders if f"/{STATES}-" in f]
        former = [f for f in folders if f not in now]
        parts = [self.spark.read.parquet(*now).select(*KEYS, *SUMS, "max_sentiment", "newest", *more)] if now else []
        if former:
            note = F.struct(F.col("latest_key.interaction_date"), F.col("latest_key.interaction_id"),
                            *[F.col(f"brief.{c}") for c in G.BRIEF_COLUMNS], F.col("latest.preferred_channel"))
            parts.append(self.spark.read.parquet(*former).select(*KEYS, *SUMS, "max_sentiment", note.alias("newest"), *more))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def folders(self, kind: str) -> list[str]:
        entry = self.log.entry()
        if not entry:
            raise ValueError(f"no notes are stored under {self.log.root}")
        return entry[kind]

    def rollup(self, s: Settings, as_of: dt.date | None = None) -> DataFrame:
        from dataclasses import replace

        return rollup(self.states(), replace(s, as_of=as_of) if as_of else s)

    def compact(self) -> dict | None:
        """Merge the states of all commits to one row per HCP, topic and day.

        A commit has each key once, so only days that several commits have are shuffled; of them there are as many as days
        in the notes' span.
        """
        def prepare(entries: list[dict]) -> dict | None:
            if not entries or len(entries[-1]["states"]) < 2:
                return None
            folder = self.log.folder_for_data(STATES)
            rows = self._read(entries[-1]["states"], F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/", 1).alias("__commit"))
            days = (rows.select(F.col("day").alias("__day"), "__commit").distinct().groupBy("__day").count()
                    .where("count > 1").select("__day"))
            several = F.col("day").eqNullSafe(F.col("__day"))
            kept = rows.join(F.broadcast(days), several, "left_anti").drop("__commit")
            both = merged(rows.join(F.broadcast(days), several, "left_semi"), KEYS)
            with shuffles_freed(self.spark):
                kept.unionByName(both).write.option("compression", "zstd").parquet(folder)
            return {**{k: entries[-1][k] for k in ("extracted", "through")}, "states": [folder], "replaces": True}

        return self.log.append(prepare)

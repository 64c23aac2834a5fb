"""Calls to a text model from Spark tasks, and a versioned store of its responses.

A call may be slow or fail. Each task keeps a bounded number of calls in flight,
repeats a failed one a bounded number of times with growing waits, and gives an
error text in place of a response when all attempts fail, so no prompt fails the
job. Responses are stored per model version under a commit log: a prompt is sent
once while its response is stored, failed ones are sent again by the next run,
and another version of the model starts anew.

``template_model`` and ``briefing_model`` are deterministic stand-ins for a hosted
model: they answer from labelled statements in the prompt alone.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.commitlog import CommitLog
from .extract import apply_defaults, clean_json, extract_prompt, parse_response
from ..functions.common import classify_topic

RESPONSES = "prompt_hash STRING, response STRING, error STRING, attempts INT"


@dataclass(frozen=True)
class CallPolicy:
    in_flight: int = 8          # calls of one task at the same time
    attempts: int = 3
    first_wait: float = 0.2     # seconds before the second attempt; doubled before each further one
    batch: int = 256            # prompts that a task holds at once


class ModelCalls:
    """``call(prompt) -> response`` for every prompt, under a policy."""

    def __init__(self, call: Callable[[str], str], version: str, policy: CallPolicy = CallPolicy()) -> None:
        self.call, self.version, self.policy = call, version, policy

    def _one(self, prompt: str) -> tuple[str | None, str | None, int]:
        for attempt in range(1, self.policy.attempts + 1):
            try:
                return str(self.call(prompt)), None, attempt
            except Exception as e:   # whatever the client raises: the prompt gets an error, the job goes on
                error = f"{type(e).__name__}: {e}"
            if attempt < self.policy.attempts:
                time.sleep(self.policy.first_wait * 2 ** (attempt - 1))
        return None, error, self.policy.attempts

    def ask(self, prompts: DataFrame) -> DataFrame:
        """prompt_hash, response, error and attempts of each row of (prompt_hash, prompt)."""
        one, policy = self._one, self.policy

        def run(batches: Iterator) -> Iterator:
            from concurrent.futures import ThreadPoolExecutor

            import pandas as pd

            with ThreadPoolExecutor(policy.in_flight) as pool:
                for pdf in batches:
                    for low in range(0, len(pdf), policy.batch):
                        some = pdf.iloc[low:low + policy.batch]
                        made = list(pool.map(one, some["prompt"].tolist()))
                        yield pd.DataFrame({"prompt_hash": some["prompt_hash"].tolist(), "response": [m[0] for m in made],
                                            "error": [m[1] for m in made], "attempts": [m[2] for m in made]})

        return prompts.select("prompt_hash", "prompt").mapInPandas(run, RESPONSES)


def hashed(prompts: DataFrame, prompt: str = "prompt") -> DataFrame:
    return prompts.withColumn("prompt_hash", F.sha2(F.col(prompt), 256))


class ResponseStore:
    """Responses of each model version under one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, version: str) -> CommitLog:
        name = re.sub(r"[^A-Za-z0-9._-]", lambda m: f"%{ord(m[0]):X}", version)
        return CommitLog(self.spark, f"{self.root}/model={name}")

    def all_responses(self, version: str) -> DataFrame:
        """Every stored outcome, failed calls included."""
        folders = [f for e in self._log(version).entries() for f in e["folders"]]
        return self.spark.read.schema(RESPONSES).parquet(*folders) if folders else self.spark.createDataFrame([], RESPONSES)

    def answers(self, version: str) -> DataFrame:
        """One row per prompt: its response, or the error of the last calls when none succeeded."""
        rows = self.all_responses(version)
        return rows.groupBy("prompt_hash").agg(F.min("response").alias("response"), F.max("error").alias("error")).select(
            "prompt_hash", "response", F.when(F.col("response").isNull(), F.col("error")).alias("error"))

    def update(self, prompts: DataFrame, calls: ModelCalls) -> dict | None:
        """Send each distinct prompt without a stored response of this version, and commit what came back."""
        log = self._log(calls.version)

        def prepare(entries: list[dict]) -> dict | None:
            distinct = hashed(prompts).where(F.col("prompt").isNotNull()).groupBy("prompt_hash").agg(F.min("prompt").alias("prompt"))
            done = self.answers(calls.version).where(F.col("response").isNotNull()).select("prompt_hash")
            folder = log.folder_for_data("responses")
            calls.ask(distinct.join(done, "prompt_hash", "left_anti")).write.parquet(folder)
            counts = self.spark.read.schema(RESPONSES).parquet(folder).agg(F.count(F.lit(1)), F.count("error")).first()
            return {"folders": [folder], "asked": counts[0], "failed": counts[1]} if counts[0] else None

        return log.append(prepare)

    def answered(self, prompts: DataFrame, version: str) -> DataFrame:
        """``prompts`` with ``response`` and ``error``; prompts that were never sent have neither."""
        return hashed(prompts).join(self.answers(version), "prompt_hash", "left").drop("prompt_hash")


def extract_with_model(notes: DataFrame, store: ResponseStore, calls: ModelCalls) -> DataFrame:
    """S9 with a model: the extraction table and ``error``; a note without a response gets the defaults."""
    prompts = extract_prompt(notes)
    store.update(prompts.select("prompt"), calls)
    parsed = store.answered(prompts, calls.version).withColumn("j", parse_response(clean_json(F.col("response"))))
    return apply_defaults(parsed, more=["error"]).withColumn("topic_category", classify_topic(F.col("scientific_topic")))


def generate(prompts: DataFrame, store: ResponseStore, calls: ModelCalls) -> DataFrame:
    """``prompts`` with the generated text in ``response`` and ``error``."""
    store.update(prompts.select("prompt"), calls)
    return store.answered(prompts, calls.version)


# ------------------------------------------------------------------ stand-ins
def template_model(prompt: str) -> str:
    """A fenced JSON answer from the labelled statements of the note at the end of the prompt."""
    note = prompt.rsplit("Note: ", 1)[-1]
    said = lambda label: (re.search(rf"{label}: ([^.\n]+)\.", note) or ["", None])[1]
    title = lambda v: v and v[0].upper() + v[1:]
    answer = {"scientific_topic": said("Subject"), "information_need": said("Ask"), "sentiment": title(said("Mood")),
              "interest_level": title(said("Interest")), "follow_up_requested": "Call back agreed" in note}
    return f"```json{json.dumps(answer)}```"


def briefing_model(prompt: str) -> str:
    """The lines on person, engagement and open questions of a briefing prompt, in one paragraph."""
    return " ".join(line for line in prompt.split("\n") if line.startswith(("HCP: ", "Engagement: ", "Open medical inquiries: ")))

"""Structured fields from free-text field notes (S9a-S9g, S10).

The step is split the way the application splits it: prompt assembly, one
extractor response per note, fence stripping, JSON parsing into a fixed
10-field struct, defaulting, follow-up date and topic classification.

The extractor is pluggable:

* :class:`RegexExtractor` (default) answers with JVM-side ``regexp_extract``
  over the note template, so it stays inside whole-stage codegen and is
  deterministic, which the tests and the SQL oracle need.
* :class:`BatchModelExtractor` sends each *distinct* prompt once to a batch
  function (for example a hosted model client) from ``mapInPandas``; Arrow
  batches keep the Python hop vectorised.

Responses that are malformed, fenced or missing never drop a row: they parse
to NULL fields and the defaults apply.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    COMPETITORS, DEFAULT, EVIDENCE_TYPES, EXTRACTION_DEFAULTS, EXTRACTION_INSTRUCTION, EXTRACTION_SCHEMA, PRODUCTS, TOPIC_DEFAULT,
)
from ..functions.common import classify_topic, first_upper, path_has_files

NOTE_COLUMNS = ["interaction_id", "hcp_id", "msl_name", "interaction_date", "channel",
                "duration_minutes"]


def extract_prompt(interactions: DataFrame) -> DataFrame:
    """Constant instruction followed by the note (NULL note -> NULL prompt)."""
    return interactions.withColumn("prompt", F.concat(F.lit(EXTRACTION_INSTRUCTION), F.col("raw_notes")))


def note_hash(col: Column) -> Column:
    return F.sha2(F.coalesce(col, F.lit("")), 256)


# Per-field search patterns of the note template (any text: first match wins).
FIELD_PATTERNS = {
    "preferred_channel": r"Contact \(([^)\n]+)\)",
    "scientific_topic": r"Subject: ([^.\n]+)\.",
    "product_or_indication": r"Product: ([^.\n]+)\.",
    "sentiment": r"Mood: (\w+)",
    "interest_level": r"Interest: (\w+)",
    "information_need": r"Ask: ([^.\n]+)\.",
    "evidence_type_requested": r"Evidence: ([^.\n]+)\.",
    "competitor_mentioned": r"Also considered: ([^.\n]+)\.",
}
# The same fields in one anchored pass over a note that follows the template,
# groups in FIELD_PATTERNS order. Every group excludes its closing character,
# so nothing backtracks, and the DOTALL tail consumes the rest.
TEMPLATE_PATTERN = (
    r"^Contact \(([^)\n]++)\)\. Subject: ([^.\n]++)\. Product: ([^.\n]++)\. Mood: (\w++)\. Interest: (\w++)\."
    r" Ask: ([^.\n]++)\. Evidence: ([^.\n]++)\.(?: Also considered: ([^.\n]++)\.)?(?s:.*)"
)
# Notes in free wording: what is looked for when a label is missing. The first
# entry that matches the lower-cased note wins; topics use the topic rules.
FREE_SENTIMENT = [("Negative", r"\b(sceptical|skeptical|critical|annoyed|disappointed|negative)\b"),
                  ("Positive", r"\b(enthusiastic|impressed|pleased|keen|positive)\b"), ("Neutral", r"\b(neutral|reserved)\b")]
FREE_INTEREST = [("High", r"\b(very interested|enthusiastic|keen|high interest|strong interest)\b"),
                 ("Low", r"\b(little interest|low interest|not interested)\b"), ("Medium", r"\b(some interest|moderate interest)\b")]
FREE_CHANNEL = [("Phone", r"\b(phone|phoned|telephone)\b"), ("Virtual", r"\b(video|virtual|online)\b"),
                ("Congress", r"\b(congress|symposium|conference)\b"), ("Email", r"\be-?mail\b"),
                ("In-person", r"\b(in person|in-person|visited|visit)\b")]
FREE_EVIDENCE = [("Registry", r"\b(registry|real[- ]world)\b"), ("Safety", r"\b(safety|adverse|toxicity)\b"),
                 ("Biomarker", r"\b(biomarker|assay|testing)\b"), ("Dosing", r"\b(dosing|dose)\b"),
                 ("Comparative", r"\b(versus|head[- ]to[- ]head|compared)\b"), ("Efficacy", r"\b(efficacy|survival|response rate)\b")]
FREE_CALL_BACK = r"\b(call (me |him |her |them )?back|follow[- ]up|get back to)\b"
FREE_NO_CALL_BACK = r"\bno (call back|follow[- ]up)\b"
_SEP = "\u0001"


def _seldom(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)`` for a branch that few rows take: as a lambda it adds no code to the generated method of the others.

    The JVM never compiles a method of over 8,000 bytes of code; all rows then run interpreted, several times as slow.
    """
    return F.get(F.transform(F.array(value), make), F.lit(0))


class RegexExtractor:
    """Deterministic extractor for the field-note sentence template.

    It reads the note column itself rather than the prompt: the instruction
    prefix carries no fields, and skipping it keeps every pattern scan short.

    A note that follows the template is parsed by one anchored regex pass
    (``regexp_replace`` packs the groups, ``split`` unpacks them); any other
    note falls back to one search per field. Both run JVM-side in codegen, and
    the captures are projected once before the struct is built, so no pattern
    runs twice per note.
    """

    name = "regex"

    def __init__(self, source_col: str = "raw_notes"):
        self.source_col = source_col

    @staticmethod
    def captures(df: DataFrame, note: Column) -> DataFrame:
        """``df`` plus one ``_cap_<field>`` column per pattern (NULL when absent), ``_cap_free`` (:meth:`free_values`) and
        ``_cap_lower``, the lower-cased note.

        Lambdas have no generated code, so a projection with one copies its rows: all lambdas are in one projection.
        """
        packed = F.when(~note.contains(_SEP), F.split(
            F.regexp_replace(note, TEMPLATE_PATTERN, _SEP.join(f"${i}" for i in range(1, 9))), _SEP))
        staged = df.withColumn("_cap_packed", packed)
        fast = F.size("_cap_packed") == len(FIELD_PATTERNS)
        searched = _seldom(note, lambda n: F.array(*[F.regexp_extract(n, pattern, 1) for pattern in FIELD_PATTERNS.values()]))
        staged = staged.select("*", F.when(fast, F.col("_cap_packed")).otherwise(searched).alias("_cap_all"),
                               F.when(~F.coalesce(fast, F.lit(False)), RegexExtractor.free_values(note)).alias("_cap_free"))
        caps = [F.nullif(F.get("_cap_all", F.lit(i)), F.lit("")).alias(f"_cap_{name}") for i, name in enumerate(FIELD_PATTERNS)]
        # the lower-cased note feeds keyword tests: project it once
        return staged.select("*", *caps, F.lower(note).alias("_cap_lower")).drop("_cap_packed", "_cap_all")

    @staticmethod
    def free_values(note: Column) -> Column:
        """What words say in a note without a subject, as a struct; NULL for a note with one."""
        def found(low: Column) -> Column:
            def free(entries: list[tuple[str, str]]) -> Column:
                out = F.lit(None).cast("string")
                for value, pattern in reversed(entries):
                    out = F.when(low.rlike(pattern), F.lit(value)).otherwise(out)
                return out

            def named(values: list[str]) -> Column:
                some = F.filter(F.array(*[F.lit(v) for v in values]), lambda v: F.contains(low, F.lower(v)))
                return F.get(some, F.lit(0))

            return F.struct(
                F.nullif(classify_topic(low), F.lit(TOPIC_DEFAULT)).alias("topic"), named(PRODUCTS).alias("product"),
                free(FREE_SENTIMENT).alias("sentiment"), free(FREE_INTEREST).alias("interest"), free(FREE_CHANNEL).alias("channel"),
                free(FREE_EVIDENCE).alias("evidence"), named([c for c in COMPETITORS if c != "None"]).alias("competitor"),
                F.when(low.rlike(FREE_NO_CALL_BACK), F.lit(False)).when(low.rlike(FREE_CALL_BACK), F.lit(True)).alias("call_back"))

        # a labelled note has a subject; only a note without one is searched for words
        subject = FIELD_PATTERNS["scientific_topic"]
        return _seldom(note, lambda n: F.when(F.regexp_extract(n, subject, 1) == "", _seldom(F.lower(n), found)))

    @staticmethod
    def struct_from_captures(note: Column) -> Column:
        cap = lambda name: F.col(f"_cap_{name}")
        low = F.col("_cap_lower")
        or_free = lambda labelled, name: F.coalesce(labelled, F.col(f"_cap_free.{name}"))
        evidence_raw = cap("evidence_type_requested")
        canonical = F.create_map(*[F.lit(x) for e in EVIDENCE_TYPES for x in (e.lower(), e)])
        evidence = F.coalesce(F.element_at(canonical, F.lower(evidence_raw)), first_upper(evidence_raw))
        follow = (F.when(note.contains("No call back."), F.lit(False)).when(note.contains("Call back agreed."), F.lit(True))
                  .otherwise(F.col("_cap_free.call_back")))
        return F.struct(
            F.when(low.contains("leukemia") | low.contains("lymphoma") | low.contains("myeloma"),
                   F.lit("Hematology-Oncology"))
            .when(note.isNotNull(), F.lit("Oncology")).alias("therapeutic_area"),
            or_free(cap("scientific_topic"), "topic").alias("scientific_topic"),
            cap("information_need").alias("information_need"),
            or_free(cap("product_or_indication"), "product").alias("product_or_indication"),
            or_free(first_upper(cap("sentiment")), "sentiment").alias("sentiment"),
            or_free(first_upper(cap("interest_level")), "interest").alias("interest_level"),
            follow.alias("follow_up_requested"),
            F.when(note.isNotNull(), F.coalesce(or_free(cap("competitor_mentioned"), "competitor"), F.lit("None"))).alias("competitor_mentioned"),
            or_free(first_upper(cap("preferred_channel")), "channel").alias("preferred_channel"),
            or_free(evidence, "evidence").alias("evidence_type_requested"),
        )

    def _with_struct(self, df: DataFrame, prompt_col: str, out: str, to_text: bool) -> DataFrame:
        if self.source_col in df.columns:
            note = F.col(self.source_col)
        else:  # the instruction names the possible values: it must not be searched for them
            prompt, n = F.col(prompt_col), len(EXTRACTION_INSTRUCTION)
            note = F.when(prompt.startswith(EXTRACTION_INSTRUCTION), F.substring(prompt, n + 1, 1 << 30)).otherwise(prompt)
        staged = self.captures(df, note)
        s = self.struct_from_captures(note)
        return staged.withColumn(out, F.to_json(s) if to_text else s).drop(
            *[f"_cap_{name}" for name in FIELD_PATTERNS], "_cap_lower", "_cap_free")

    def apply(self, df: DataFrame, prompt_col: str = "prompt") -> DataFrame:
        """The response text (JSON), as any extractor returns it."""
        return self._with_struct(df, prompt_col, "extracted_raw", True)

    def parsed(self, df: DataFrame, prompt_col: str = "prompt") -> DataFrame:
        """The parsed struct directly: parsing this extractor's own JSON is the identity,
        so the table path skips the text round trip."""
        return self._with_struct(df, prompt_col, "j", False)


class BatchModelExtractor:
    """Calls ``predict(list_of_prompts) -> list_of_responses`` once per distinct prompt.

    Distinct prompts are found with a hash aggregate (partial, skew-safe), the
    model runs in ``mapInPandas`` over Arrow batches, and responses join back
    on the hash. A note that repeats a million times is sent once.
    """

    name = "model"

    def __init__(self, predict: Callable[[list[str]], list[str]], batch_size: int = 64):
        self.predict = predict
        self.batch_size = batch_size

    def responses(self, prompts: DataFrame) -> DataFrame:
        predict, batch_size = self.predict, self.batch_size

        def run(batches: Iterator) -> Iterator:
            import pandas as pd

            for pdf in batches:
                out = []
                texts = pdf["prompt"].tolist()
                for i in range(0, len(texts), batch_size):
                    out.extend(predict(texts[i:i + batch_size]))
                yield pd.DataFrame({"note_hash": pdf["note_hash"], "extracted_raw": out})

        return prompts.mapInPandas(run, "note_hash string, extracted_raw string")

    def apply(self, df: DataFrame, prompt_col: str = "prompt") -> DataFrame:
        keyed = df.withColumn("note_hash", note_hash(F.col(prompt_col)))
        distinct = (keyed.filter(F.col(prompt_col).isNotNull())
                    .groupBy("note_hash").agg(F.min(prompt_col).alias("prompt")))
        return keyed.join(self.responses(distinct), "note_hash", "left").drop("note_hash")


def clean_json(raw: Column) -> Column:
    """Strip markdown code fences."""
    return F.regexp_replace(raw, "```(json)?", "")


def parse_response(clean: Column) -> Column:
    """S9d: PERMISSIVE parse into the 10-field struct (bad JSON -> all-NULL struct)."""
    return F.from_json(F.trim(clean), EXTRACTION_SCHEMA)


def apply_defaults(df: DataFrame, parsed: str = "j", more: list[str] | None = None) -> DataFrame:
    """S9e + S9f: per-field defaults, channel fallback, follow-up date; columns ``more`` are carried."""
    j = lambda f: F.col(f"{parsed}.{f}")
    d = EXTRACTION_DEFAULTS
    return df.select(
        *NOTE_COLUMNS,
        *[F.coalesce(j(f), F.lit(d[f])).alias(f) for f in [
            "therapeutic_area", "scientific_topic", "information_need", "product_or_indication",
            "sentiment", "interest_level", "follow_up_requested", "competitor_mentioned"]],
        F.coalesce(F.nullif(j("preferred_channel"), F.lit("None")), F.col("channel")).alias("preferred_channel"),
        F.coalesce(j("evidence_type_requested"), F.lit(d["evidence_type_requested"])).alias("evidence_type_requested"),
        F.when(j("follow_up_requested"), F.date_add(F.col("interaction_date"), DEFAULT.followup_after_days))
        .alias("recommended_follow_up_date"),
        "raw_notes", *(more or []),
    )


def silver_extracted(interactions: DataFrame, extractor=None, more: list[str] | None = None) -> DataFrame:
    """The composed extraction table, one row per interaction; input columns ``more`` are carried."""
    extractor = extractor or RegexExtractor()
    prompts = extract_prompt(interactions)
    if hasattr(extractor, "parsed"):
        parsed = extractor.parsed(prompts)
    else:
        raw = extractor.apply(prompts)
        parsed = raw.withColumn("j", parse_response(clean_json(F.col("extracted_raw"))))
    fixed = apply_defaults(parsed, more=more)
    return fixed.withColumn("topic_category", classify_topic(F.col("scientific_topic")))


def new_responses(interactions: DataFrame, cache: DataFrame | None, extractor=None) -> DataFrame:
    """S10, first half: (note_hash, extracted_raw) of the distinct notes that ``cache`` doesn't have.

    The caller appends these rows to the stored cache. Each new distinct note is
    sent to the extractor once, when that write runs.
    """
    extractor = extractor or RegexExtractor()
    notes = interactions.filter(F.col("raw_notes").isNotNull()).select("raw_notes")
    # notes travel without the instruction, hashes as bytes: half as long as their text
    keyed = extract_prompt(notes).select(F.unhex(note_hash(F.col("prompt"))).alias("note_key"), "raw_notes")
    todo = keyed.groupBy("note_key").agg(F.min("raw_notes").alias("raw_notes"))
    if cache is not None:
        todo = todo.join(cache.select(F.unhex("note_hash").alias("note_key")), "note_key", "left_anti")
    todo = extract_prompt(todo).withColumn("note_hash", F.lower(F.hex("note_key")))
    if hasattr(extractor, "responses"):
        return extractor.responses(todo.select("note_hash", "prompt")).select("note_hash", "extracted_raw")
    return extractor.apply(todo.drop("note_key")).select("note_hash", "extracted_raw")


def table_from_cache(interactions: DataFrame, cache: DataFrame) -> DataFrame:
    """S10, second half: the extraction table from stored responses; nothing is extracted here.

    A cache that two runs filled at once may hold several responses of one note: the least counts, for every interaction.
    """
    cache = cache.groupBy(F.unhex("note_hash").alias("note_key")).agg(F.min("extracted_raw").alias("extracted_raw"))
    prompts = extract_prompt(interactions).withColumn("note_key", F.unhex(note_hash(F.col("prompt"))))
    raw = prompts.join(cache, "note_key", "left").drop("note_key")
    parsed = raw.withColumn("j", parse_response(clean_json(F.col("extracted_raw"))))
    return apply_defaults(parsed).withColumn("topic_category", classify_topic(F.col("scientific_topic")))


def extract_incremental(spark: SparkSession, interactions: DataFrame, cache_path: str, extractor=None) -> DataFrame:
    """Append responses of new notes to the cache at ``cache_path``, then build the table from the stored cache.

    An unchanged input extracts nothing; table and cache hold the same answers,
    also for an extractor that would answer differently if asked again.
    """
    schema = "note_hash STRING, extracted_raw STRING"
    stored = spark.read.schema(schema).parquet(cache_path) if path_has_files(spark, cache_path) else None
    new_responses(interactions, stored, extractor).write.mode("append").option("compression", "zstd").parquet(cache_path)
    return table_from_cache(interactions, spark.read.schema(schema).parquet(cache_path))

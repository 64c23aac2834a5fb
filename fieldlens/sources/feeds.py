"""The nine raw feeds: explicit read schemas in header order, plus CSV I/O.

OSS Spark has no schema hints, so the types of a feed's columns are stated here and
files are mapped to them by the names in their headers (``streaming/headers.py``).
Inference would need an extra pass over 100 TB and guesses types per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {"STRING": StringType(), "INT": IntegerType(), "DOUBLE": DoubleType(), "DATE": DateType(),
          "BOOLEAN": BooleanType()}

FEED_DDL = {
    "hcp_master": (
        "hcp_id STRING, hcp_name STRING, specialty STRING, institution STRING, city STRING, "
        "state STRING, territory STRING, practice_setting STRING, hcp_tier STRING, "
        "publication_count INT, trial_participation INT, influence_score INT, npi STRING, "
        "primary_therapeutic_area STRING"),
    "msl_interactions": (
        "interaction_id STRING, hcp_id STRING, msl_name STRING, interaction_date DATE, "
        "channel STRING, duration_minutes INT, raw_notes STRING"),
    "medical_inquiries": (
        "inquiry_id STRING, hcp_id STRING, inquiry_date DATE, inquiry_topic STRING, "
        "evidence_type_requested STRING, indication STRING, response_status STRING, "
        "response_time_days INT, sla_met BOOLEAN, sla_target_days INT, product STRING"),
    "congress_events": (
        "event_attendance_id STRING, hcp_id STRING, event_name STRING, event_date DATE, "
        "session_topic STRING, therapeutic_area STRING, attendance_status STRING, "
        "visited_medical_booth BOOLEAN"),
    "digital_engagement": (
        "engagement_id STRING, hcp_id STRING, activity_date DATE, emails_sent INT, "
        "emails_opened INT, content_title STRING, content_type STRING, webpage_clicks INT, "
        "attended_webinar BOOLEAN, content_minutes_viewed INT"),
    "publications_trials": (
        "record_id STRING, hcp_id STRING, record_type STRING, title STRING, "
        "journal_or_registry STRING, year INT, therapeutic_area STRING, trial_id STRING, "
        "citation_count INT"),
    "patient_claims_summary": (
        "claim_summary_id STRING, city STRING, state STRING, territory STRING, diagnosis STRING, "
        "primary_therapy STRING, diagnosed_patient_count INT, treated_patient_count INT, "
        "treatment_penetration_rate DOUBLE"),
    "approved_content": (
        "content_id STRING, content_title STRING, content_type STRING, topic_category STRING, "
        "indication STRING, product STRING, approval_date DATE, approval_status STRING, "
        "med_review_id STRING"),
    "content_shared": (
        "share_id STRING, hcp_id STRING, content_id STRING, content_title STRING, "
        "content_type STRING, topic_category STRING, shared_date DATE, shared_by_msl STRING, "
        "share_channel STRING"),
}
FEEDS = list(FEED_DDL)

# Feeds whose free text may contain quotes and line breaks.
MULTILINE_FEEDS = {"msl_interactions"}

RESCUE_COLUMN = "_rescued"
LINEAGE_COLUMNS = ["_ingested_at", "_source_file"]
BATCH_COLUMN = "_batch"   # partition of a bronze table: the micro-batch that wrote it


def _fields(feed: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in FEED_DDL[feed].split(", ")]


def feed_schema(feed: str, with_rescue: bool = True) -> StructType:
    """Explicit schema (built without a session, so it can be used at import time)."""
    fields = [StructField(n, _TYPES[t], True) for n, t in _fields(feed)]
    if with_rescue:
        fields.append(StructField(RESCUE_COLUMN, StringType(), True))
    return StructType(fields)


def bronze_schema(feed: str) -> StructType:
    """Schema of a bronze table: the feed, the rescue column and the lineage columns."""
    return StructType(feed_schema(feed).fields + [StructField("_ingested_at", TimestampType(), True),
                                                  StructField("_source_file", StringType(), True)])


def feed_columns(feed: str) -> list[str]:
    return [n for n, _ in _fields(feed)]


def csv_options(feed: str) -> dict[str, str]:
    """Reader options: header, RFC-4180 quoting, PERMISSIVE with a rescue column."""
    opts = {
        "header": "true",
        "enforceSchema": "false",  # without a mapped header, other names fail instead of swapping columns
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RESCUE_COLUMN,
        "dateFormat": "yyyy-MM-dd",
        "escape": '"',
    }
    if feed in MULTILINE_FEEDS:
        # A multiLine file is read by one task; writers must keep these files small.
        opts["multiLine"] = "true"
    return opts


def write_feed_csv(df: DataFrame, path: str, files: int | None = None, gzip: bool = False) -> None:
    """Write a feed as headered CSV the way an upstream system would drop files.

    ``gzip`` is for files that are not split anyway (multi-line feeds): each is read by one task.
    """
    out = df.select(*[c for c in df.columns if not c.startswith("_")])
    if files:
        out = out.repartition(files)
    how = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"} if gzip else {}
    (out.write.mode("overwrite").option("header", "true").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .option("dateFormat", "yyyy-MM-dd").options(**how).csv(path))


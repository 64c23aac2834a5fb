"""Silver: cleaned, validated, de-duplicated entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.common import days_since

HCP_COLUMNS = ["hcp_id", "hcp_name", "specialty", "institution", "city", "state", "territory",
               "practice_setting", "hcp_tier", "primary_therapeutic_area", "publication_count",
               "trial_participation", "influence_score", "npi"]


def silver_hcp(bronze: DataFrame) -> DataFrame:
    """Newest row per ``hcp_id`` (by ingest time), trimmed name, typed counts.

    ``max_by`` is an ordinary aggregate with map-side partial aggregation, so
    an HCP with millions of re-sent versions is reduced inside each map task;
    a ``row_number`` window would sort every version of that HCP in one task.
    Ties on ``_ingested_at`` are broken by source file, then the row itself,
    so the result does not depend on partitioning.
    """
    payload = [c for c in HCP_COLUMNS if c != "hcp_id"]
    newest = (bronze.filter(F.col("hcp_id").isNotNull())
              .groupBy("hcp_id")
              .agg(F.max_by(F.struct(*payload), version_order()).alias("r")))
    return cleaned_hcp(newest.select("hcp_id", "r.*"))


def version_order() -> Column:
    """By which the greatest version of an HCP is the newest."""
    first = ["_ingested_at", "_source_file", "hcp_name", "influence_score"]
    return F.struct(*first, *[c for c in HCP_COLUMNS if c not in (*first, "hcp_id")])


def cleaned_hcp(newest: DataFrame) -> DataFrame:
    """The silver columns of the newest version of each HCP."""
    return newest.select(
        "hcp_id",
        F.trim("hcp_name").alias("hcp_name"), "specialty", "institution", "city", "state", "territory",
        "practice_setting", "hcp_tier", "primary_therapeutic_area",
        *[F.col(c).try_cast("int").alias(c) for c in ["publication_count", "trial_participation", "influence_score"]],
        "npi")


def silver_inquiries(bronze: DataFrame, settings: Settings) -> DataFrame:
    """Typed inquiries plus the NULL-propagating overdue flag."""
    overdue = ((F.col("response_status") != "Closed")
               & (days_since(settings.as_of, F.col("inquiry_date")) > F.col("sla_target_days")))
    return bronze.filter(F.col("inquiry_id").isNotNull()).select(
        "inquiry_id", "hcp_id", "inquiry_date", "inquiry_topic", "evidence_type_requested",
        "indication", "product", "response_status", "response_time_days", "sla_target_days",
        "sla_met", overdue.alias("overdue"))


def _project(bronze: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return bronze.filter(F.col(key).isNotNull()).select(*cols)


def silver_congress(bronze: DataFrame) -> DataFrame:
    return _project(bronze, "event_attendance_id", [
        "event_attendance_id", "hcp_id", "event_name", "event_date", "session_topic",
        "therapeutic_area", "attendance_status", "visited_medical_booth"])


def silver_digital(bronze: DataFrame) -> DataFrame:
    return _project(bronze, "engagement_id", [
        "engagement_id", "hcp_id", "activity_date", "emails_sent", "emails_opened", "content_title",
        "content_type", "webpage_clicks", "attended_webinar", "content_minutes_viewed"])


def silver_publications(bronze: DataFrame) -> DataFrame:
    return _project(bronze, "record_id", [
        "record_id", "hcp_id", "record_type", "title", "journal_or_registry", "year",
        "therapeutic_area", "trial_id", "citation_count"])


def silver_claims(bronze: DataFrame) -> DataFrame:
    return _project(bronze, "claim_summary_id", [
        "claim_summary_id", "city", "state", "territory", "diagnosis", "primary_therapy",
        "diagnosed_patient_count", "treated_patient_count", "treatment_penetration_rate"])


def silver_content(bronze: DataFrame) -> DataFrame:
    return _project(bronze, "content_id", [
        "content_id", "content_title", "content_type", "topic_category", "indication", "product",
        "approval_date", "approval_status", "med_review_id"])


def silver_content_shared(bronze: DataFrame) -> DataFrame:
    return _project(bronze, "share_id", [
        "share_id", "hcp_id", "content_id", "content_title", "content_type", "topic_category",
        "shared_date", "shared_by_msl", "share_channel"])

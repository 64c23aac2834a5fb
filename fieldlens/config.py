"""Parameters, weights and fixed vocabularies.

Every score weight and threshold lives in :class:`Settings`; results are
reproducible because the as-of date is explicit instead of ``current_date()``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    as_of: _dt.date = _dt.date(2024, 1, 31)

    # recency windows (days)
    recent_days: int = 30
    prior_days: int = 60
    reach_days: int = 90
    half_year_days: int = 180
    cadence_days: int = 60
    never_contacted_days: int = 999
    influence_threshold: int = 60
    followup_after_days: int = 14
    last_engagement_floor: _dt.date = _dt.date(2000, 1, 1)

    # topic interest score = 10*mentions + 8*current + 6*avg weight
    topic_w_mentions: int = 10
    topic_w_current: int = 8
    topic_w_interest: int = 6

    # HCP 360 scores (all capped at 100)
    digital_w_open_rate: int = 50
    digital_w_webinar: int = 10
    digital_click_cap: int = 20
    need_w_open_inquiry: int = 12
    need_w_follow_up: int = 8
    need_w_top_topic: str = "0.25"
    engage_w_interactions_90d: int = 14
    engage_w_attended: int = 8
    engage_w_open_rate: int = 20

    # priority = 0.40*influence + 0.35*need + 0.25*(100 - engagement)
    priority_w_influence: str = "0.40"
    priority_w_need: str = "0.35"
    priority_w_disengagement: str = "0.25"
    tier_high: int = 65
    tier_medium: int = 45
    segment_high: int = 60
    segment_moderate: int = 30

    # territory opportunity = 2*under-engaged + 0.5*avg need
    territory_w_under_engaged: int = 2
    territory_w_need: str = "0.5"

    # serving / app defaults
    queue_limit: int = 50
    dashboard_queue_limit: int = 25
    recent_limit: int = 5
    publications_limit: int = 8
    briefing_topics: int = 4
    briefing_open_inquiries: int = 3
    seed_decisions: int = 2
    seed_schedule_days: int = 14

    # key of the masked identifiers (at most 64 bytes); set an own secret in production
    mask_key: str = "change-me"

DEFAULT = Settings()


# ---------------------------------------------------------------------------
# These must equal the source application's for equal results.
# ---------------------------------------------------------------------------

# Topic classifier, evaluated in this order on lower(scientific_topic); first match wins.
TOPIC_RULES = [
    ("ild|pneumonitis|interstitial|lung|safety|adverse|toxicity", "Safety / ILD Management"),
    ("real-world|rwe|real world", "Real-World Evidence"),
    ("long-term|duration of response|outcome|survival", "Long-term Efficacy & Outcomes"),
    ("biomarker|trop2|her2|testing|diagnostic|selection|amplif|ihc", "Biomarker & Patient Selection"),
    ("cns|brain|metasta", "CNS / Brain Metastases"),
    ("dosing|dose|administration|nausea|management", "Dosing & Administration"),
    ("sequenc|resistance|combination|immunotherap", "Sequencing & Combinations"),
    ("comparative|head-to-head|versus|compar", "Comparative Evidence"),
    ("efficacy", "Long-term Efficacy & Outcomes"),
]
TOPIC_DEFAULT = "General Scientific Exchange"

# Defaults applied to each extracted field when the extractor returns nothing usable.
EXTRACTION_DEFAULTS = {
    "therapeutic_area": "Oncology",
    "scientific_topic": "General scientific exchange",
    "information_need": "Scientific information request",
    "product_or_indication": "Portfolio",
    "sentiment": "Neutral",
    "interest_level": "Medium",
    "follow_up_requested": False,
    "competitor_mentioned": "None",
    "evidence_type_requested": "Efficacy",
}

# The JSON contract returned by an extractor (field order = schema order).
EXTRACTION_SCHEMA = (
    "therapeutic_area STRING, scientific_topic STRING, information_need STRING, "
    "product_or_indication STRING, sentiment STRING, interest_level STRING, "
    "follow_up_requested BOOLEAN, competitor_mentioned STRING, preferred_channel STRING, "
    "evidence_type_requested STRING"
)

EXTRACTION_INSTRUCTION = (
    "You are a Medical Affairs analyst. Extract structured fields from this MSL interaction note "
    "as JSON with EXACTLY these keys: "
    "therapeutic_area, scientific_topic, information_need, product_or_indication, sentiment "
    "(one of Positive/Neutral/Negative), "
    "interest_level (one of High/Medium/Low), follow_up_requested (true or false), "
    "competitor_mentioned (competitor name or None), "
    "preferred_channel (one of In-person/Virtual/Phone/Email/Congress/None), evidence_type_requested. "
    "Return ONLY valid minified JSON, no markdown, no prose. Note: "
)

BRIEFING_INSTRUCTION = (
    "Prepare a field visit. From the facts listed under Context, and nothing else, write a short briefing "
    "(at most four sentences) for the medical liaison: what this professional asked about lately, which need is "
    "still open, where they were met, and what was promised. Stay factual and balanced, name only approved "
    "evidence, add no facts, and close with one point to talk about. Context:\n"
)

# Next-best-engagement trigger cascade and texts.
TRIGGER_OVERDUE = "Open medical inquiry overdue"
TRIGGER_UNDER_ENGAGED = "High-influence KOL under-engaged"
TRIGGER_FOLLOW_UP = "Outstanding MSL follow-up requested"
TRIGGER_COMPETITOR = "Competitive scientific interest expressed"
TRIGGER_CADENCE = "Scientific engagement cadence"
REVIEW_STATUS_PENDING = "Pending MSL review"
WINDOW_14 = "Within 14 days"
WINDOW_30 = "Within 30 days"
WINDOW_60 = "Within 60 days"
DEFAULT_CHANNEL = "In-person"
ASSET_FALLBACK = "MSL to identify approved asset"
SEGMENT_HIGH = "Highly Engaged"
SEGMENT_MODERATE = "Moderately Engaged"
SEGMENT_UNDER = "Under-Engaged"

# Seeded review decision.
SEED_MSL = "Dr. Amara Osei"
SEED_DECISION = "Approved"
SEED_NOTES = "Confirmed next-best-engagement; will share approved evidence."
SEED_CHANNEL = "In-person"

# ---------------------------------------------------------------------------
# Own vocabularies of the bound feeds (nothing has to equal anything but the
# topic rules above and the safety topic that N5 asks for).
# ---------------------------------------------------------------------------
PRODUCT_INDICATIONS = [
    ("Velomab", "velotuzumab", "advanced ductal carcinoma"),
    ("Velomab", "velotuzumab", "early ductal carcinoma"),
    ("Corvexa", "corvexinib", "renal cell carcinoma"),
    ("Corvexa", "corvexinib", "hepatocellular carcinoma"),
    ("Lumirase", "lumiraselide", "small cell carcinoma"),
    ("Lumirase", "lumiraselide", "mesothelioma"),
    ("Ondalyn", "ondalimod", "follicular lymphoma"),
    ("Ondalyn", "ondalimod", "multiple myeloma"),
    ("Tavelio", "tavelocept", "cutaneous melanoma"),
]
PRODUCTS = ["Velomab", "Corvexa", "Lumirase", "Ondalyn", "Tavelio"]

# Topic phrases and the category that the rules give them.
TOPIC_LIBRARY = [
    ("grading of pneumonitis on treatment", "Safety / ILD Management"),
    ("dose reduction after cycle two", "Dosing & Administration"),
    ("which assay to use for patient selection", "Biomarker & Patient Selection"),
    ("registry results from real-world cohorts", "Real-World Evidence"),
    ("five-year survival", "Long-term Efficacy & Outcomes"),
    ("lesions in the brain", "CNS / Brain Metastases"),
    ("what to give after resistance", "Sequencing & Combinations"),
    ("benefit versus the older standard", "Comparative Evidence"),
    ("pipeline overview", "General Scientific Exchange"),
]
COMPETITORS = ["None", "Brenzumab", "None", "Quorivast", "None", "Salotinib", "None", "Hexavir"]
INFO_NEEDS = [
    "send the pooled analysis", "explain the endpoint", "share the poster", "list open study sites",
    "clarify monitoring intervals", "provide the label section", "show results by age group",
    "compare infusion times", "summarise the registry", "describe the mode of action",
]
EVIDENCE_TYPES = ["Registry", "Safety", "Efficacy", "Mechanism", "Dosing", "Comparative", "Biomarker", "Quality of life"]
SENTIMENTS = ["Neutral", "Positive", "Negative", "Positive", "Neutral"]
INTEREST = ["Medium", "High", "Low", "High", "Medium"]
CHANNELS = ["In-person", "Virtual", "Phone", "Congress", "Email"]
PRACTICE_SETTINGS = ["Teaching hospital", "Regional clinic", "Day hospital", "Group practice", "Research institute"]
INQUIRY_TOPICS = ["Safety / ILD management", "Storage conditions", "Missed dose", "Assay choice", "Use in older patients",
                  "Renal impairment", "Study enrolment", "Infusion reactions", "Registry access"]
CONGRESS_EVENTS = ["Northern Oncology Forum", "Rare Tumour Days", "Harbour Lung Meeting", "Spring Haematology Week",
                   "Clinical Trials Summit", "Breast Care Conference", "Melanoma Round Table"]

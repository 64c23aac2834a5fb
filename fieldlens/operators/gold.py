"""Gold: per-HCP aggregates, scores, priorities and recommendations.

Plan shape. Each source table is aggregated by ``hcp_id`` exactly once (a
*rollup*), and every per-HCP table is a projection of those rollups joined to
the HCP master. All rollups come out of a hash aggregate keyed on ``hcp_id``,
so they are already hash-partitioned on the join key and the eight left
joins of the 360 profile add no exchange of their own. The priority and
next-best tables are projections of the same profile instead of self-joins.

Scores are exact DECIMAL arithmetic rounded HALF_UP (see
:mod:`fieldlens.functions.numeric`); stored scores are DOUBLE and are read
back as DECIMAL at their known scale, which is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import Settings
from ..functions.common import days_since
from ..functions.numeric import dec, exact_avg, quotient


def d1(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(10,1)")


def _dbl(c: Column) -> Column:
    return c.cast("double")


# --------------------------------------------------------------------------- pass-through

def gold_inquiries(silver_inq: DataFrame) -> DataFrame:
    return silver_inq.select(
        "inquiry_id", "hcp_id", "inquiry_date", "inquiry_topic", "evidence_type_requested",
        "indication", "product", "response_status", "response_time_days", "sla_target_days",
        "sla_met", "overdue")


def gold_passthrough(silver: DataFrame) -> DataFrame:
    return silver.select("*")


# --------------------------------------------------------------------------- rollups

def interest_weight() -> Column:
    return (F.when(F.col("interest_level") == "High", 3)
            .when(F.col("interest_level") == "Medium", 2).otherwise(1))


LATEST_COLUMNS = ["recent_question", "recent_evidence_request", "recent_competitor_interest", "preferred_channel"]
BRIEF_COLUMNS = ["channel", "scientific_topic", "information_need", "sentiment",
                 "interest_level", "follow_up_requested", "evidence_type_requested", "competitor_mentioned"]


def _of_note(columns: list, note: str | None = None) -> Column:
    """Day and id of a note, then ``columns``: the greatest such struct is the newest note's."""
    return F.struct(*[F.col(f"{note}.{c}" if note else c) for c in ("interaction_date", "interaction_id")], *columns)


def latest_signals(note: str | None = None) -> Column:
    """What the profile takes from an HCP's newest note (the columns, or a struct column ``note`` of them)."""
    c = lambda name: F.col(f"{note}.{name}" if note else name)
    return _of_note([
        c("information_need").alias("recent_question"),
        c("evidence_type_requested").alias("recent_evidence_request"),
        F.nullif(c("competitor_mentioned"), F.lit("None")).alias("recent_competitor_interest"),
        c("preferred_channel")], note)


def briefing_note(note: str | None = None) -> Column:
    """What a briefing takes from an HCP's newest note."""
    return _of_note([F.col(f"{note}.{c}" if note else c) for c in BRIEF_COLUMNS], note)


def whole_note() -> Column:
    """All that :func:`latest_signals` and :func:`briefing_note` take."""
    return _of_note([F.col(c) for c in [*BRIEF_COLUMNS, "preferred_channel"]])


def note_rollup(extracted: DataFrame, s: Settings, more: Sequence[str] = ()) -> DataFrame:
    """One aggregate of the extracted notes per (HCP, topic) holding every partial
    that the per-HCP and per-topic tables need.

    Both :func:`msl_rollup` and :func:`topic_interest` read this frame, so a
    plan that needs both scans and extracts the notes once and shuffles them
    once; the per-HCP level then re-aggregates at most one row per topic.
    Columns ``more`` are further keys.
    """
    age = days_since(s.as_of, F.col("interaction_date"))
    return extracted.groupBy("hcp_id", "topic_category", *more).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(age <= s.recent_days, 1)).alias("n30"),
        F.count(F.when(age.between(s.recent_days + 1, s.prior_days), 1)).alias("n31_60"),
        F.count(F.when(age <= s.reach_days, 1)).alias("n90"),
        F.count(F.when(age <= s.half_year_days, 1)).alias("n180"),
        F.sum(interest_weight()).alias("w_sum"),
        F.sum("duration_minutes").alias("dur_sum"),
        F.count("duration_minutes").alias("dur_n"),
        F.count(F.when(F.col("follow_up_requested"), 1)).alias("follow_ups"),
        F.max("interaction_date").alias("last_date"),
        F.max("sentiment").alias("max_sentiment"),
        # day and id begin each struct, so a row carries them once in each of the two that a query reads
        F.max(latest_signals()).alias("latest"),
        F.max(briefing_note()).alias("brief"),
    )


ROLLUP_SUMS = ["n", "n30", "n31_60", "n90", "n180", "w_sum", "dur_sum", "dur_n", "follow_ups"]


def merged_rollup(parts: DataFrame) -> DataFrame:
    """:func:`note_rollup` of all notes from the rollups of disjoint parts of them, as of the same day: sums add up, greatest values stay."""
    greatest = [c for c in parts.columns if c not in ("hcp_id", "topic_category", *ROLLUP_SUMS)]
    return parts.groupBy("hcp_id", "topic_category").agg(
        *[F.sum(c).alias(c) for c in ROLLUP_SUMS], *[F.max(c).alias(c) for c in greatest]).select(*parts.columns)


def topic_frame(notes_r: DataFrame, s: Settings) -> DataFrame:
    """Per (HCP, topic): the partials plus the rounded interest weight and score."""
    avg_w = quotient(F.col("w_sum"), F.col("n"))
    score = (F.col("n") * s.topic_w_mentions + F.col("n30") * s.topic_w_current
             + avg_w * s.topic_w_interest)
    return notes_r.withColumn("avg_w_dec", F.round(avg_w, 2)).withColumn("score_dec", F.round(score, 1))


def msl_rollup(notes_r: DataFrame, s: Settings) -> DataFrame:
    """Per-HCP note aggregates from :func:`note_rollup`: cadence (G5, G8), latest-note
    signals (G9c), top topic (G9a) and emerging topics (G9b) in one aggregate.

    Keeping every per-HCP note signal in one aggregate means a plan joins the
    notes to the HCP master once; separate consumers of one rollup are pruned
    to different columns and would no longer be reused as one exchange.
    """
    t = topic_frame(notes_r, s)
    last = F.max("last_date")
    emerging = F.array_sort(F.collect_set(F.when(F.col("n30") > F.col("n31_60"), F.col("topic_category"))))
    return t.groupBy("hcp_id").agg(
        F.sum("n").alias("total_interactions"),
        F.sum("n30").alias("interactions_30d"),
        F.sum("n90").alias("interactions_90d"),
        F.sum("n180").alias("interactions_180d"),
        F.round(quotient(F.sum("dur_sum"), F.sum("dur_n")), 1).alias("avg_duration_dec"),
        last.alias("last_interaction_date"),
        F.datediff(F.lit(s.as_of), last).alias("days_since_last_interaction"),
        F.sum("follow_ups").alias("follow_ups_requested"),
        F.count("topic_category").alias("distinct_topics"),
        F.max("max_sentiment").alias("sample_sentiment"),
        F.max("latest").alias("latest"),
        F.max("brief").alias("brief"),
        # one entry per topic category of the HCP: bounded by the classifier's categories
        F.collect_list(F.struct("topic_category", "score_dec", "n")).alias("topic_list"),
        F.min_by(F.struct(F.col("topic_category").alias("topic"), F.col("score_dec").alias("score")),
                 F.struct(-F.col("score_dec"), -F.col("n"), F.col("topic_category"))).alias("top"),
        emerging.alias("emerging_all"),
    ).withColumn("emerging_topics", F.when(F.size("emerging_all") > 0, F.col("emerging_all"))).drop("emerging_all")


def interaction_summary(msl_r: DataFrame) -> DataFrame:
    """Per-HCP interaction recency and cadence."""
    return msl_r.select(
        "hcp_id", "total_interactions", "interactions_30d", "interactions_90d", "interactions_180d",
        _dbl(F.col("avg_duration_dec")).alias("avg_duration_min"), "last_interaction_date",
        "days_since_last_interaction", "follow_ups_requested", "distinct_topics", "sample_sentiment")


def latest_note(msl_r: DataFrame) -> DataFrame:
    """Signals of the newest note per HCP (ties: highest interaction_id)."""
    return msl_r.select("hcp_id", *[F.col(f"latest.{c}") for c in LATEST_COLUMNS])


def topic_interest(notes_r: DataFrame, s: Settings) -> DataFrame:
    """Per HCP and topic: mentions, 30-day vs prior 30-day, interest weight, score."""
    return topic_frame(notes_r, s).select(
        "hcp_id", "topic_category",
        F.col("n").alias("mentions"),
        F.col("n30").alias("mentions_current_30d"),
        F.col("n31_60").alias("mentions_prior_30d"),
        _dbl(F.col("avg_w_dec")).alias("avg_interest_weight"),
        F.col("last_date").alias("last_mention_date"),
        _dbl(F.col("score_dec")).alias("topic_interest_score"),
    )


def top_topic(topics: DataFrame) -> DataFrame:
    """Highest score, then most mentions, then topic name (ascending)."""
    best = F.min_by(F.struct("topic_category", "topic_interest_score"),
                    F.struct(-F.col("topic_interest_score"), -F.col("mentions"), F.col("topic_category")))
    return (topics.groupBy("hcp_id").agg(best.alias("t"))
            .select("hcp_id", F.col("t.topic_category").alias("top_scientific_topic"),
                    F.col("t.topic_interest_score").alias("top_topic_interest_score")))


def emerging_topics(topics: DataFrame) -> DataFrame:
    """Topics mentioned more in the last 30 days than in the 30 before (sorted array)."""
    return (topics.filter(F.col("mentions_current_30d") > F.col("mentions_prior_30d"))
            .groupBy("hcp_id")
            .agg(F.array_sort(F.collect_set("topic_category")).alias("emerging_topics")))


def congress_rollup(congress: DataFrame) -> DataFrame:
    """Two levels: rows are added up per HCP and event, whose number of rows per HCP is then the distinct events.

    The only sets are of topics, which the output lists.
    """
    attended = F.col("attendance_status") == "Attended"
    events = congress.groupBy("hcp_id", "event_name").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(attended, 1)).alias("attended"),
        F.count(F.when(F.col("visited_medical_booth"), 1)).alias("booth"), F.collect_set("session_topic").alias("topics"),
        F.max("event_date").alias("last_date"))
    return events.groupBy("hcp_id").agg(
        F.sum("n").alias("sessions_registered"),
        F.sum("attended").alias("sessions_attended"),
        F.sum("booth").alias("booth_visits"),
        F.count("event_name").alias("distinct_events"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("topics")))).alias("session_topics"),
        F.max("last_date").alias("last_congress_date"),
    )


def congress_engagement(congress_r: DataFrame, hcp: DataFrame) -> DataFrame:
    """Aggregate first, then attach HCP attributes (the master is unique on hcp_id)."""
    attrs = hcp.select("hcp_id", "hcp_name", "territory", "specialty")
    return congress_r.join(attrs, "hcp_id", "left").select(
        "hcp_id", "hcp_name", "territory", "specialty", "sessions_registered", "sessions_attended",
        "booth_visits", "distinct_events", "session_topics", "last_congress_date")


def digital_rollup(digital: DataFrame) -> DataFrame:
    return digital.groupBy("hcp_id").agg(
        F.sum("emails_sent").alias("emails_sent"),
        F.sum("emails_opened").alias("emails_opened"),
        F.sum("webpage_clicks").alias("webpage_clicks"),
        F.count(F.when(F.col("attended_webinar"), 1)).alias("webinars_attended"),
        F.max("activity_date").alias("last_digital_date"),
    )


def inquiry_rollup(inquiries: DataFrame) -> DataFrame:
    """Inquiry counts for G8 (all), G9d (not Closed) and G11 (overdue) in one aggregate."""
    return inquiries.groupBy("hcp_id").agg(
        F.count(F.lit(1)).alias("medical_inquiries"),
        F.max("inquiry_date").alias("last_inquiry_date"),
        F.count(F.when(F.col("response_status") != "Closed", 1)).alias("open_inquiries"),
        F.count(F.when(F.col("overdue"), 1)).alias("overdue_inquiries"),
    )


def open_inquiries(inq_r: DataFrame) -> DataFrame:
    """G9d: HCPs with at least one inquiry whose status is not Closed."""
    return inq_r.filter(F.col("open_inquiries") > 0).select("hcp_id", "open_inquiries")


def pubs_tracked(publications: DataFrame) -> DataFrame:
    """G9e."""
    return publications.groupBy("hcp_id").agg(
        F.count(F.when(F.col("record_type") == "Publication", 1)).alias("publications_tracked"),
        F.count(F.when(F.col("record_type") == "Clinical Trial", 1)).alias("trials_tracked"))


# --------------------------------------------------------------------------- G8-G11

def rollup_frame(hcp: DataFrame, msl_r: DataFrame, dig_r: DataFrame, cg_r: DataFrame, inq_r: DataFrame,
                 pubs_r: DataFrame | None = None) -> DataFrame:
    """The HCP master with each rollup left-joined exactly once on ``hcp_id``."""
    j = (hcp.join(msl_r, "hcp_id", "left").join(dig_r, "hcp_id", "left")
         .join(cg_r, "hcp_id", "left").join(inq_r, "hcp_id", "left"))
    return j if pubs_r is None else j.join(pubs_r, "hcp_id", "left")


def _z(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def _open_rate() -> Column:
    return F.round(quotient(_z("emails_opened"), F.col("emails_sent")), 3)


def _channel_columns(s: Settings) -> dict[str, Column]:
    floor = F.lit(s.last_engagement_floor)
    used = lambda c: F.when(_z(c) > 0, 1).otherwise(0)
    return {
        "msl_interactions": _z("total_interactions"),
        "avg_msl_duration_min": _dbl(F.col("avg_duration_dec")),
        "emails_sent": _z("emails_sent"),
        "emails_opened": _z("emails_opened"),
        "email_open_rate": _dbl(_open_rate()),
        "webpage_clicks": _z("webpage_clicks"),
        "webinars_attended": _z("webinars_attended"),
        "congress_sessions_attended": _z("sessions_attended"),
        "medical_inquiries": _z("medical_inquiries"),
        "channels_used": (used("total_interactions") + used("emails_sent") + used("sessions_attended")
                          + used("medical_inquiries")),
        "last_msl_date": F.col("last_interaction_date"),
        "last_digital_date": F.col("last_digital_date"),
        "last_congress_date": F.col("last_congress_date"),
        "last_inquiry_date": F.col("last_inquiry_date"),
        "last_any_engagement": F.greatest(
            F.coalesce("last_interaction_date", floor), F.coalesce("last_digital_date", floor),
            F.coalesce("last_congress_date", floor), F.coalesce("last_inquiry_date", floor)),
    }


CHANNEL_COLUMNS = ["hcp_id", "hcp_name", "territory", "specialty", "msl_interactions",
                   "avg_msl_duration_min", "emails_sent", "emails_opened", "email_open_rate",
                   "webpage_clicks", "webinars_attended", "congress_sessions_attended",
                   "medical_inquiries", "channels_used", "last_msl_date", "last_digital_date",
                   "last_congress_date", "last_inquiry_date", "last_any_engagement"]


def channel_engagement(hcp, dig_r, msl_r, cg_r, inq_r, s: Settings) -> DataFrame:
    """Omnichannel roll-up per HCP of the master."""
    cols = _channel_columns(s)
    j = rollup_frame(hcp, msl_r, dig_r, cg_r, inq_r)
    return j.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in CHANNEL_COLUMNS])


def hcp_profile(hcp: DataFrame, notes_r: DataFrame, inquiries: DataFrame, congress: DataFrame,
                digital: DataFrame, publications: DataFrame, s: Settings) -> DataFrame:
    """Wide per-HCP frame from which G9, G10 and G11 are projected."""
    return profile_of_rollups(hcp, msl_rollup(notes_r, s), digital_rollup(digital), congress_rollup(congress),
                              inquiry_rollup(inquiries), pubs_tracked(publications), s)


def profile_of_rollups(hcp: DataFrame, msl_r: DataFrame, dig_r: DataFrame, cg_r: DataFrame, inq_r: DataFrame,
                       pubs_r: DataFrame, s: Settings) -> DataFrame:
    """:func:`hcp_profile` from rollups that may be stored."""
    j = rollup_frame(hcp, msl_r, dig_r, cg_r, inq_r, pubs_r)
    ch = _channel_columns(s)
    z = _z
    rate = F.coalesce(_open_rate(), dec("0.000"))
    days = F.coalesce(F.col("days_since_last_interaction"), F.lit(s.never_contacted_days))
    top_score = F.col("top.score")
    digital_score = F.round(F.least(
        dec(100), rate * s.digital_w_open_rate + z("webinars_attended") * s.digital_w_webinar
        + F.least(z("webpage_clicks"), F.lit(s.digital_click_cap)) * dec("1.0")), 1)
    need = F.round(F.least(
        dec(100), z("open_inquiries") * s.need_w_open_inquiry + z("follow_ups_requested") * s.need_w_follow_up
        + F.coalesce(top_score, dec("0.0")) * dec(s.need_w_top_topic)), 1)
    engagement = F.round(F.least(
        dec(100), z("interactions_90d") * s.engage_w_interactions_90d
        + z("sessions_attended") * s.engage_w_attended + rate * s.engage_w_open_rate), 1)
    under = (F.col("influence_score") >= s.influence_threshold) & (days > s.reach_days)
    window = (F.when(under | (z("open_inquiries") > 0), F.lit(C.WINDOW_14))
              .when(days > s.cadence_days, F.lit(C.WINDOW_30)).otherwise(F.lit(C.WINDOW_60)))
    return j.select(
        "hcp_id", "hcp_name", "specialty", "institution", "city", "state", "territory",
        "practice_setting", "hcp_tier", "primary_therapeutic_area", "publication_count",
        "trial_participation", "influence_score", "npi",
        ch["msl_interactions"].alias("msl_interactions"),
        ch["avg_msl_duration_min"].alias("avg_msl_duration_min"),
        _dbl(rate).alias("email_open_rate"),
        ch["webinars_attended"].alias("webinars_attended"),
        ch["congress_sessions_attended"].alias("congress_sessions_attended"),
        ch["medical_inquiries"].alias("medical_inquiries"),
        ch["channels_used"].alias("channels_used"),
        ch["last_any_engagement"].alias("last_any_engagement"),
        z("interactions_30d").alias("interactions_30d"),
        z("interactions_90d").alias("interactions_90d"),
        z("interactions_180d").alias("interactions_180d"),
        days.alias("days_since_last_msl"),
        z("follow_ups_requested").alias("follow_ups_requested"),
        F.col("top.topic").alias("top_scientific_topic"),
        _dbl(top_score).alias("top_topic_interest_score"),
        "emerging_topics",
        F.col("latest.recent_question").alias("recent_question"),
        F.col("latest.recent_evidence_request").alias("recent_evidence_request"),
        F.col("latest.recent_competitor_interest").alias("recent_competitor_interest"),
        z("publications_tracked").alias("publications_tracked"),
        z("trials_tracked").alias("trials_tracked"),
        _dbl(digital_score).alias("digital_engagement_score"),
        _dbl(need).alias("educational_need_score"),
        _dbl(engagement).alias("engagement_score"),
        under.alias("under_engaged_priority"),
        ch["avg_msl_duration_min"].alias("avg_engagement_duration"),
        F.coalesce(F.col("latest.preferred_channel"), F.lit(C.DEFAULT_CHANNEL)).alias("preferred_engagement_channel"),
        window.alias("recommended_follow_up_window"),
        z("overdue_inquiries").alias("overdue_inquiries"),
        "brief", "topic_list",  # newest-note detail and per-topic scores for the briefing (A14)
    )


HCP_360_COLUMNS = [
    "hcp_id", "hcp_name", "specialty", "institution", "city", "state", "territory",
    "practice_setting", "hcp_tier", "primary_therapeutic_area", "publication_count",
    "trial_participation", "influence_score", "npi", "msl_interactions", "avg_msl_duration_min",
    "email_open_rate", "webinars_attended", "congress_sessions_attended", "medical_inquiries",
    "channels_used", "last_any_engagement", "interactions_30d", "interactions_90d",
    "interactions_180d", "days_since_last_msl", "follow_ups_requested", "top_scientific_topic",
    "top_topic_interest_score", "emerging_topics", "recent_question", "recent_evidence_request",
    "recent_competitor_interest", "publications_tracked", "trials_tracked",
    "digital_engagement_score", "educational_need_score", "engagement_score",
    "under_engaged_priority", "avg_engagement_duration", "preferred_engagement_channel",
    "recommended_follow_up_window"]


def hcp_360(profile: DataFrame) -> DataFrame:
    """Unified profile, one row per HCP."""
    return profile.select(*HCP_360_COLUMNS)


def _priority_score(s: Settings) -> Column:
    return F.round(F.col("influence_score") * dec(s.priority_w_influence)
                   + d1("educational_need_score") * dec(s.priority_w_need)
                   + (dec(100) - d1("engagement_score")) * dec(s.priority_w_disengagement), 1)


def with_priority(profile: DataFrame, s: Settings) -> DataFrame:
    score = _priority_score(s)
    eng = F.col("engagement_score")
    return (profile
            .withColumn("msl_priority_score", _dbl(score))
            .withColumn("engagement_segment",
                        F.when(eng >= s.segment_high, C.SEGMENT_HIGH)
                        .when(eng >= s.segment_moderate, C.SEGMENT_MODERATE).otherwise(C.SEGMENT_UNDER))
            # tiers test the rounded score, as stored
            .withColumn("priority_tier",
                        F.when(F.col("msl_priority_score") >= s.tier_high, "High")
                        .when(F.col("msl_priority_score") >= s.tier_medium, "Medium").otherwise("Low")))


PRIORITY_COLUMNS = [
    "hcp_id", "hcp_name", "specialty", "territory", "hcp_tier", "primary_therapeutic_area",
    "influence_score", "engagement_score", "educational_need_score", "digital_engagement_score",
    "under_engaged_priority", "days_since_last_msl", "follow_ups_requested", "top_scientific_topic",
    "top_topic_interest_score", "recent_competitor_interest", "msl_priority_score",
    "engagement_segment", "priority_tier"]


def hcp_priority(profile: DataFrame, s: Settings) -> DataFrame:
    """priority = 0.40 influence + 0.35 need + 0.25 (100 - engagement), segment and tier."""
    return with_priority(profile, s).select(*PRIORITY_COLUMNS)


NEXT_BEST_COLUMNS = [
    "hcp_id", "hcp_name", "specialty", "territory", "priority_tier", "msl_priority_score",
    "engagement_segment", "trigger", "topic", "suggested_engagement", "suggested_channel_topic",
    "recommended_date", "overdue", "review_status"]


def with_next_best(profile: DataFrame, s: Settings) -> DataFrame:
    p = with_priority(profile, s)
    topic = F.col("top_scientific_topic")
    trigger = (F.when(F.col("overdue_inquiries") > 0, C.TRIGGER_OVERDUE)
               .when(F.col("under_engaged_priority"), C.TRIGGER_UNDER_ENGAGED)
               .when(F.col("follow_ups_requested") > 0, C.TRIGGER_FOLLOW_UP)
               .when(F.col("recent_competitor_interest").isNotNull(), C.TRIGGER_COMPETITOR)
               .otherwise(C.TRIGGER_CADENCE))
    win = F.col("recommended_follow_up_window")
    days = {w: int(w.split()[1]) for w in (C.WINDOW_14, C.WINDOW_30, C.WINDOW_60)}  # "Within 14 days"
    date = (F.when(win == C.WINDOW_14, F.date_add(F.lit(s.as_of), days[C.WINDOW_14]))
            .when(win == C.WINDOW_30, F.date_add(F.lit(s.as_of), days[C.WINDOW_30]))
            .otherwise(F.date_add(F.lit(s.as_of), days[C.WINDOW_60])))
    return (p.withColumn("trigger", trigger)
            .withColumn("topic", F.coalesce(topic, F.lit(C.TOPIC_DEFAULT)))
            .withColumn("suggested_engagement", F.concat(
                F.lit("Address "), F.coalesce(F.col("recent_question"), F.lit("outstanding scientific question")),
                F.lit(" with approved evidence on "), F.coalesce(topic, F.lit("the portfolio"))))
            .withColumn("suggested_channel_topic", F.concat(
                F.col("preferred_engagement_channel"), F.lit(" · "),
                F.coalesce(topic, F.lit("Scientific exchange"))))
            .withColumn("recommended_date", date)
            .withColumn("overdue", F.col("overdue_inquiries") > 0)
            .withColumn("review_status", F.lit(C.REVIEW_STATUS_PENDING)))


def next_best_engagement(profile: DataFrame, s: Settings) -> DataFrame:
    """Trigger cascade, suggested texts and a recommended date per HCP."""
    return with_next_best(profile, s).select(*NEXT_BEST_COLUMNS)


# --------------------------------------------------------------------------- G12

def claims_by_territory(claims: DataFrame) -> DataFrame:
    return claims.groupBy("territory").agg(
        F.sum("diagnosed_patient_count").alias("diagnosed_patients"),
        F.sum("treated_patient_count").alias("treated_patients"),
        F.round(exact_avg(F.col("treatment_penetration_rate").cast("decimal(12,2)")), 2)
        .alias("avg_penetration_dec"))


def territory_opportunity(profile: DataFrame, claims: DataFrame, s: Settings) -> DataFrame:
    """Per territory reach and opportunity; HCP side aggregated before the claims join.

    The profile is unique on ``hcp_id`` (asserted in tests), so the distinct
    counts of the definition are plain conditional counts: no Expand, and the
    partial aggregate absorbs a territory holding most HCPs.
    """
    p = with_priority(profile, s)
    hz = p.groupBy("territory").agg(
        F.count(F.lit(1)).alias("total_hcps"),
        F.count(F.when(F.col("priority_tier") == "High", 1)).alias("priority_hcps"),
        F.count(F.when(F.col("days_since_last_msl") <= s.reach_days, 1)).alias("engaged_90d"),
        F.count(F.when(F.col("under_engaged_priority"), 1)).alias("under_engaged_priority_hcps"),
        exact_avg(d1("engagement_score")).alias("avg_eng"),
        exact_avg(d1("educational_need_score")).alias("avg_need"),
    )
    cl = claims_by_territory(claims)
    j = hz.join(cl, hz["territory"] == cl["territory"], "left").drop(cl["territory"])
    return j.select(
        "territory", "total_hcps", "priority_hcps", "engaged_90d", "under_engaged_priority_hcps",
        _dbl(F.round(quotient(F.col("engaged_90d") * 100, F.col("total_hcps")), 1)).alias("reach_rate"),
        _dbl(F.round("avg_eng", 1)).alias("avg_engagement_score"),
        _dbl(F.round("avg_need", 1)).alias("avg_educational_need"),
        F.coalesce("diagnosed_patients", F.lit(0)).alias("diagnosed_patients"),
        F.coalesce("treated_patients", F.lit(0)).alias("treated_patients"),
        _dbl(F.coalesce("avg_penetration_dec", dec("0.00"))).alias("avg_treatment_penetration"),
        _dbl(F.round(F.col("under_engaged_priority_hcps") * s.territory_w_under_engaged
                     + F.col("avg_need") * dec(s.territory_w_need), 1)).alias("territory_opportunity_score"),
    )

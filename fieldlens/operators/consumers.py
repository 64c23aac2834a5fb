"""Dashboard datasets, natural-language answers and cockpit reads.

The cockpit's per-HCP lookups are produced here for *all* HCPs as one table
each, partitioned by ``hcp_id`` through the aggregation that builds them; a
lookup for one HCP is a filter on that table.

Per-HCP "latest N" lists use ``row_number() <= N``. Spark plans that as a
partial ``WindowGroupLimit`` before the shuffle, so every map task forwards
at most N rows per HCP and a single HCP with a third of all rows costs no
more than any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Settings
from ..functions.numeric import exact_avg, quotient
from . import gold as G


def _dbl(c: Column) -> Column:
    return c.cast("double")


# ----------------------------------------------------------------------------- dashboard

def kpi_headline(profile: DataFrame, inquiries: DataFrame, s: Settings) -> DataFrame:
    """One row of headline KPIs. HCP figures come from one aggregate over the
    profile; inquiry figures are uncorrelated scalar subqueries (one per source)."""
    p = G.with_priority(profile, s)
    inq = inquiries.agg(F.struct(
        F.count(F.when(F.col("overdue"), 1)).alias("overdue_inquiries"),
        _dbl(F.round(exact_avg(F.when(F.col("response_status") == "Closed", F.col("response_time_days"))), 1))
        .alias("avg_response_days"))).scalar()  # one subquery, referenced twice
    return p.agg(
        F.count(F.lit(1)).alias("total_hcps"),
        F.count(F.when(F.col("priority_tier") == "High", 1)).alias("priority_high"),
        _dbl(F.round(quotient(F.count(F.when(F.col("days_since_last_msl") <= s.reach_days, 1)),
                              F.count(F.lit(1))), 3)).alias("reach_90d_pct"),
        F.count(F.when(F.col("under_engaged_priority"), 1)).alias("under_engaged"),
    ).select("*", inq.getField("overdue_inquiries").alias("overdue_inquiries"),
             inq.getField("avg_response_days").alias("avg_response_days"))


def reach_by_territory(territory: DataFrame) -> DataFrame:
    """D2."""
    return territory.select(
        "territory", "total_hcps", "reach_rate", "under_engaged_priority_hcps",
        F.round("territory_opportunity_score", 1).alias("opportunity_score"),
    ).orderBy(F.col("reach_rate").asc_nulls_first(), "territory")


def topic_interest_totals(topics: DataFrame) -> DataFrame:
    """D3: topic rows are unique per (HCP, topic), so distinct HCPs = rows per topic."""
    return (topics.groupBy("topic_category")
            .agg(F.sum("mentions").alias("mentions"), F.count(F.lit(1)).alias("hcps"))
            .orderBy(F.desc("mentions"), "topic_category"))


def inquiry_sla_by_product(inquiries: DataFrame) -> DataFrame:
    """Total, overdue and SLA-met fraction of closed inquiries (3 dp)."""
    return (inquiries.groupBy("product").agg(
        F.count(F.lit(1)).alias("total_inquiries"),
        F.count(F.when(F.col("overdue"), 1)).alias("overdue_inquiries"),
        _dbl(F.round(quotient(F.count(F.when(F.col("sla_met"), 1)),
                              F.count(F.when(F.col("response_status") == "Closed", 1))), 3))
        .alias("sla_met_pct"))
        .orderBy(F.desc("total_inquiries"), "product"))


def priority_distribution(priority: DataFrame) -> DataFrame:
    """D5."""
    return priority.groupBy("priority_tier").agg(F.count(F.lit(1)).alias("hcps"))


def queue_top25(next_best: DataFrame, s: Settings) -> DataFrame:
    """Top-k by score (ties by hcp_id) -> TakeOrderedAndProject, no full sort."""
    return (next_best.orderBy(F.desc("msl_priority_score"), "hcp_id").limit(s.dashboard_queue_limit)
            .select("hcp_id", "hcp_name", "territory", "priority_tier",
                    F.round("msl_priority_score", 1).alias("msl_priority_score"),
                    "trigger", "topic", "recommended_date"))


# ----------------------------------------------------------------------------- NL answers

def nl_high_under_engaged(next_best_wide: DataFrame) -> DataFrame:
    """High priority, under-engaged (influential, no visit for > 90 days) and overdue (a late open inquiry)."""
    return (next_best_wide.filter((F.col("priority_tier") == "High") & F.col("under_engaged_priority") & F.col("overdue"))
            .select("hcp_id", "hcp_name", "territory", "msl_priority_score", "days_since_last_msl",
                    "trigger", "overdue", "recommended_date"))


def nl_top_topics(topics: DataFrame, k: int = 5) -> DataFrame:
    """Top scientific topics by mentions (top-k report)."""
    return topic_interest_totals(topics).orderBy(F.desc("mentions"), "topic_category").limit(k)


def nl_lowest_reach(territory: DataFrame, k: int = 5) -> DataFrame:
    """Territories with RANK() <= k by reach ascending, ties kept.

    ``rank() <= k`` with a literal k is planned with a partial
    ``WindowGroupLimit``: each map task forwards only its rows of rank <= k
    (ties included), so the final single-partition window sees at most that
    many rows per task, and the territory table is computed once (a k-th value
    subquery would compute it a second time).
    """
    valid = territory.filter(F.col("territory").isNotNull() & F.col("reach_rate").isNotNull()
                             & F.col("under_engaged_priority_hcps").isNotNull())
    ranked = valid.withColumn("reach_rank", F.rank().over(Window.orderBy("reach_rate")))
    return (ranked.filter(F.col("reach_rank") <= k)
            .select("territory", "reach_rate", "under_engaged_priority_hcps")
            .orderBy("reach_rate", "territory"))


def nl_overdue_avg(inquiries: DataFrame) -> DataFrame:
    """Overdue count and mean response time (all statuses, 1 dp)."""
    return inquiries.agg(
        F.count(F.when(F.col("overdue"), 1)).alias("overdue_inquiries"),
        _dbl(F.round(exact_avg(F.col("response_time_days")), 1)).alias("avg_response_days"))


def nl_tier1_safety(hcp: DataFrame, inquiries: DataFrame) -> DataFrame:
    """Tier-1 KOLs with open inquiries on Safety / ILD management (case-insensitive)."""
    open_safety = inquiries.filter((F.col("response_status") != "Closed")
                                   & (F.lower("inquiry_topic") == "safety / ild management"))
    return (hcp.filter(F.col("hcp_tier") == "Tier 1 KOL").select("hcp_id", "hcp_name", "territory")
            .join(open_safety.select("hcp_id", "inquiry_id", "inquiry_date", "response_status", "product"),
                  "hcp_id"))


def extraction_distribution(extracted: DataFrame) -> DataFrame:
    """Topic x sentiment x interest counts."""
    return (extracted.groupBy("topic_category", "sentiment", "interest_level")
            .agg(F.count(F.lit(1)).alias("notes")).orderBy(F.desc("notes"), "topic_category", "sentiment", "interest_level"))


def row_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Rows per table and layer, from the counts that a refresh observed while it wrote the tables."""
    layer = lambda n: n.split("_", 1)[0] if n.startswith(("bronze_", "silver_")) else "gold"
    return spark.createDataFrame([(layer(n), n, c) for n, c in counts.items()], "layer STRING, table_name STRING, row_count LONG")


# ----------------------------------------------------------------------------- cockpit

def app_hcp_list(priority_wide: DataFrame) -> DataFrame:
    """A1: priority joined to the profile; both are projections of one frame."""
    return (priority_wide.select("hcp_id", "hcp_name", "specialty", "territory", "hcp_tier",
                                 "msl_priority_score", "priority_tier")
            .orderBy(F.desc("msl_priority_score"), "hcp_name", "hcp_id"))


def _latest(df: DataFrame, order: list[Column], n: int, rank_name: str) -> DataFrame:
    w = Window.partitionBy("hcp_id").orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)


def app_recent_interactions(extracted: DataFrame, s: Settings) -> DataFrame:
    """A3: five newest notes per HCP."""
    return shown_interactions(_latest(extracted, [F.desc("interaction_date"), F.desc("interaction_id")], s.recent_limit, "recency_rank"))


def shown_interactions(ranked: DataFrame) -> DataFrame:
    """The columns of A3 of extracted notes that carry their ``recency_rank``."""
    return ranked.select(
        "hcp_id", "recency_rank", "interaction_id", "interaction_date", "channel", "msl_name",
        "topic_category", "scientific_topic", "information_need", "sentiment", "interest_level",
        "follow_up_requested", "competitor_mentioned", "evidence_type_requested")


def app_topic_interests(topics: DataFrame) -> DataFrame:
    """A4: topics per HCP ordered by score, then mentions; momentum = current - prior."""
    w = Window.partitionBy("hcp_id").orderBy(F.desc("topic_interest_score"), F.desc("mentions"),
                                             "topic_category")
    return topics.select(
        "hcp_id", F.row_number().over(w).alias("interest_rank"), "topic_category", "mentions",
        "topic_interest_score", "mentions_current_30d", "mentions_prior_30d", "last_mention_date",
        (F.col("mentions_current_30d") - F.col("mentions_prior_30d")).alias("momentum"))


def app_recent_inquiries(inquiries: DataFrame, s: Settings) -> DataFrame:
    """A5: five newest inquiries per HCP."""
    return _latest(inquiries, [F.desc("inquiry_date"), F.desc("inquiry_id")], s.recent_limit,
                   "recency_rank").select(
        "hcp_id", "recency_rank", "inquiry_id", "inquiry_date", "inquiry_topic",
        "evidence_type_requested", "indication", "product", "response_status", "response_time_days",
        "overdue")


def app_publications(publications: DataFrame, s: Settings) -> DataFrame:
    """Eight newest publications/trials per HCP by year."""
    return _latest(publications, [F.desc("year"), F.desc("record_id")], s.publications_limit,
                   "recency_rank").select(
        "hcp_id", "recency_rank", "record_id", "record_type", "title", "journal_or_registry", "year",
        "therapeutic_area", "trial_id")


CONTENT_COLUMNS = ["content_id", "content_title", "content_type", "topic_category", "indication",
                   "product", "approval_status", "med_review_id", "approval_date"]


def rank_catalogue(content: DataFrame) -> DataFrame:
    """Approved assets with their place in their topic, newest first (ties: largest id).

    Places are counted per topic and month and added up over the few months of
    a topic, so a topic with most of the catalogue is sorted in many tasks.
    """
    approved = content.filter(F.col("approval_status") == "Approved").withColumn(
        "_month", F.coalesce(F.trunc("approval_date", "month"), F.lit(dt.date(1900, 1, 1))))
    months = approved.groupBy(F.col("topic_category").alias("_t"), F.col("_month").alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy("_t").orderBy(F.desc("_m")).rowsBetween(Window.unboundedPreceding, -1)
    months = months.withColumn("_before", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
    inside = Window.partitionBy("topic_category", "_month").orderBy(F.desc("approval_date"), F.desc("content_id"))
    return (approved.withColumn("_place", F.row_number().over(inside))
            .join(months, F.col("topic_category").eqNullSafe(F.col("_t")) & (F.col("_month") == F.col("_m")))
            .withColumn("cand_rank", F.col("_before") + F.col("_place")).select(*content.columns, "cand_rank"))


def recommend_content(top: DataFrame, content: DataFrame, shared: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A10: newest Approved asset of each HCP's top topic that was not shared with the HCP.

    One pass over the shares: each becomes a place in the catalogue, and places in
    the HCP's top topic count. Distinct places in order have the row numbers 1, 2, ... up
    to the first gap, so the first free place is one more than the places that equal
    their row number: a sort per HCP that spills, with no set in memory. Each HCP
    joins the catalogue once, by (topic, place), with no HCP x catalogue pairing and
    no job while the plan is built. ``NOT IN`` semantics are kept: an HCP with a share
    whose content_id is NULL gets no recommendation. With ``keep``, those columns of
    ``top`` are carried and HCPs without an answer stay, with NULL content columns.
    """
    ranked = rank_catalogue(content)
    places = ranked.select(F.col("content_id").alias("_c"), F.col("topic_category").alias("_t"), F.col("cand_rank").alias("_r"))
    wanted = top.select("hcp_id", *(keep or []), "top_scientific_topic")
    mine = wanted.select(F.col("hcp_id").alias("_h"), F.col("top_scientific_topic").alias("_top"))
    seen = (shared.select("hcp_id", "content_id").join(places, F.col("content_id") == F.col("_c"), "left")
            .join(mine, F.col("hcp_id") == F.col("_h"))
            .select("_h", F.col("content_id").isNull().alias("_null"), F.when(F.col("_t") == F.col("_top"), F.col("_r")).alias("_r")).distinct())
    order = Window.partitionBy("_h").orderBy(F.col("_r").asc_nulls_last(), "_null")
    free = (seen.withColumn("_k", F.row_number().over(order)).groupBy("_h")
            .agg(F.bool_or("_null").alias("_null"), (F.count(F.when(F.col("_r") == F.col("_k"), 1)) + 1).alias("_free")))
    wanted = wanted.join(free, F.col("hcp_id") == F.col("_h"), "left")
    free = F.coalesce("_free", F.lit(1))
    wanted = wanted.select("hcp_id", *(keep or []), F.col("top_scientific_topic").alias("_topic"),
                           F.when(~F.coalesce("_null", F.lit(False)), free).alias("_rank"))
    hit = (F.col("topic_category") == F.col("_topic")) & (F.col("cand_rank") == F.col("_rank"))
    found = wanted.join(ranked.select(*CONTENT_COLUMNS, "cand_rank"), hit, "left" if keep else "inner")
    return found.select("hcp_id", *(keep or []), *CONTENT_COLUMNS)


def _fmt_int(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def briefing_context(profile: DataFrame, inquiries: DataFrame, s: Settings) -> DataFrame:
    """The structured context text per HCP that a briefing is written from.

    The top topics and the newest note come from the profile's note rollup
    (``topic_list``, ``brief``), so the notes are extracted and aggregated once.
    A missing value is printed as ``None``; it never removes its line.
    """
    text = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("None"))
    days = F.col("days_since_last_msl")
    last = F.when(days == s.never_contacted_days, F.lit("never")).otherwise(
        F.concat(text(_fmt_int(days)), F.lit(" days ago")))
    # at most one entry per topic category per HCP, so the list is bounded
    top4 = F.slice(F.array_sort(F.transform("topic_list", lambda x: F.struct(
        (-x["score_dec"]).alias("o1"), (-x["n"]).alias("o2"), x["topic_category"].alias("o3"),
        F.concat(x["topic_category"], F.lit(" (score "),
                 _fmt_int(F.bround(x["score_dec"].cast("decimal(10,1)"), 0)), F.lit(")")).alias("txt")))),
        1, s.briefing_topics)
    recent = _latest(inquiries, [F.desc("inquiry_date"), F.desc("inquiry_id")], s.recent_limit, "r")
    open_inq = (recent.filter(~F.col("response_status").eqNullSafe("Closed")).groupBy("hcp_id")
                .agg(F.slice(F.array_sort(F.collect_list(F.struct(
                    "r", F.concat(text("inquiry_topic"), F.lit(" ("), text("indication"), F.lit(")"))
                    .alias("txt")))), 1, s.briefing_open_inquiries).alias("oi")))
    j = (profile.withColumn("t4", top4).withColumnRenamed("brief", "n")
         .join(open_inq, "hcp_id", "left"))
    comp = F.col("n.competitor_mentioned")
    note_line = F.when(F.col("n").isNotNull(), F.concat(
        F.lit("Most recent MSL note ("), text(F.date_format("n.interaction_date", "yyyy-MM-dd")), F.lit(", "),
        text("n.channel"), F.lit("): topic '"), text("n.scientific_topic"), F.lit("', need '"),
        text("n.information_need"), F.lit("', sentiment "), text("n.sentiment"), F.lit(", interest "),
        text("n.interest_level"), F.lit(", follow-up requested: "),
        F.when(F.col("n.follow_up_requested"), F.lit("True")).otherwise(F.lit("False")),
        F.lit(", evidence: "), text("n.evidence_type_requested"),
        F.when(comp.isNotNull() & (comp != "None"), F.concat(F.lit(", competitor: "), comp)).otherwise(F.lit("")),
        F.lit(".")))
    lines = [
        F.concat(F.lit("HCP: "), text("hcp_name"), F.lit(", "), text("specialty"), F.lit(", "),
                 text("practice_setting"), F.lit(" setting.")),
        F.concat(F.lit("Institution: "), text("institution"), F.lit(" ("), text("city"), F.lit(", "),
                 text("state"), F.lit(", "), text("territory"), F.lit(").")),
        F.concat(F.lit("Tier: "), text("hcp_tier"), F.lit(". Influence "), text(_fmt_int(F.col("influence_score"))),
                 F.lit(", publications "), text(_fmt_int(F.col("publication_count"))), F.lit(", trials "),
                 text(_fmt_int(F.col("trial_participation"))), F.lit(".")),
        F.concat(F.lit("Engagement: "), text(_fmt_int(F.col("msl_interactions"))), F.lit(" MSL interactions; "),
                 text(_fmt_int(F.col("interactions_90d"))), F.lit(" in last 90 days; last MSL "), last, F.lit(".")),
        F.when(F.size("t4") > 0, F.concat(F.lit("Top scientific interests: "),
                                          F.array_join(F.transform("t4", lambda x: x["txt"]), ", "), F.lit("."))),
        F.when(F.size("emerging_topics") > 0, F.concat(
            F.lit("Emerging interest topics: ['"), F.array_join("emerging_topics", "', '"), F.lit("'].")),
        ),
        note_line,
        F.when(F.size("oi") > 0, F.concat(F.lit("Open medical inquiries: "),
                                          F.array_join(F.transform("oi", lambda x: x["txt"]), "; "), F.lit("."))),
        F.concat(F.lit("Outstanding follow-ups requested: "), text(_fmt_int(F.col("follow_ups_requested"))), F.lit(".")),
    ]
    return j.select("hcp_id", F.concat_ws("\n", *lines).alias("context"))


def briefing_prompt(context: DataFrame) -> DataFrame:
    """Constant instruction followed by the context (input of the batch model step)."""
    return context.select("hcp_id", F.concat(F.lit(C.BRIEFING_INSTRUCTION), F.col("context")).alias("prompt"))


PLAN_COLUMNS = ["suggested_engagement", "trigger", "topic", "top_scientific_topic", "preferred_engagement_channel",
                "recommended_follow_up_window"]


def engagement_plan(next_best_wide: DataFrame, content: DataFrame, shared: DataFrame) -> DataFrame:
    """Plan card per HCP with the application's fallbacks; the top topic comes from the profile itself."""
    j = recommend_content(next_best_wide, content, shared, keep=PLAN_COLUMNS)
    return j.select(
        "hcp_id",
        F.coalesce("suggested_engagement", F.lit("Address outstanding scientific question")).alias("objective"),
        F.coalesce("trigger", F.lit(C.TRIGGER_CADENCE)).alias("trigger"),
        F.coalesce("topic", "top_scientific_topic", F.lit("Scientific exchange")).alias("topic"),
        F.coalesce("content_title", F.lit(C.ASSET_FALLBACK)).alias("supporting_asset"),
        F.coalesce("preferred_engagement_channel", F.lit(C.DEFAULT_CHANNEL)).alias("preferred_channel"),
        F.coalesce("recommended_follow_up_window", F.lit(C.WINDOW_30)).alias("timing"),
        F.lit("MSL confirmation").alias("required_review"),
    )

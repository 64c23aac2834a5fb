"""Oracle SQL per registered key (DuckDB dialect)."""

from __future__ import annotations

from .medallion import CTES
from .sqlgen import AS_OF, as_before, with_ctes

ORACLE: dict[str, str] = {}


def sql(key: str, final: str, deps: list[str]) -> None:
    ORACLE[key] = with_ctes(CTES, final, deps)


def table(key: str, name: str | None = None) -> None:
    sql(key, f"SELECT * FROM {name or key}", [name or key])


for _k in ["silver_hcp", "silver_inquiries", "silver_congress", "silver_digital", "silver_publications",
           "silver_claims", "silver_content", "silver_content_shared", "silver_extracted"]:
    table(_k)

sql("extract_prompt", "SELECT interaction_id, prompt FROM extract_prompt", ["extract_prompt"])

_JSON = """CAST(json_object('therapeutic_area', x_ta, 'scientific_topic', x_topic, 'information_need', x_need,
    'product_or_indication', x_pi, 'sentiment', x_sent, 'interest_level', x_int,
    'follow_up_requested', x_follow, 'competitor_mentioned', x_comp, 'preferred_channel', x_chan,
    'evidence_type_requested', x_ev) AS VARCHAR)"""
sql("extract_fields", f"SELECT interaction_id, {_JSON} AS extracted_raw FROM extract_fields", ["extract_fields"])
sql("extract_clean_json", f"SELECT interaction_id, {_JSON} AS cleaned_json FROM extract_fields",
    ["extract_fields"])
sql("extract_parse", """SELECT interaction_id, x_ta AS therapeutic_area, x_topic AS scientific_topic,
    x_need AS information_need, x_pi AS product_or_indication, x_sent AS sentiment, x_int AS interest_level,
    x_follow AS follow_up_requested, x_comp AS competitor_mentioned, x_chan AS preferred_channel,
    x_ev AS evidence_type_requested FROM extract_fields""", ["extract_fields"])
sql("extract_defaults", """SELECT interaction_id, therapeutic_area, scientific_topic, information_need,
    product_or_indication, sentiment, interest_level, follow_up_requested, competitor_mentioned,
    preferred_channel, evidence_type_requested FROM silver_extracted""", ["silver_extracted"])
sql("extract_followup_date", """SELECT interaction_id, interaction_date, follow_up_requested,
    recommended_follow_up_date FROM silver_extracted""", ["silver_extracted"])
sql("topic_category", "SELECT interaction_id, scientific_topic, topic_category FROM silver_extracted",
    ["silver_extracted"])

for _k in ["gold_inquiries", "interaction_summary", "topic_interest", "congress_engagement", "hcp_360",
           "hcp_priority", "next_best_engagement", "territory_opportunity", "top_topic", "emerging_topics",
           "latest_note", "open_inquiries", "pubs_tracked"]:
    table(_k)
table("gold_publications", "silver_publications")
table("gold_content", "silver_content")
table("gold_content_shared", "silver_content_shared")

sql("channel_engagement", """SELECT hcp_id, hcp_name, territory, specialty, msl_interactions,
    avg_msl_duration_min, emails_sent, emails_opened, CAST(open_rate_dec AS DOUBLE) AS email_open_rate,
    webpage_clicks, webinars_attended, congress_sessions_attended, medical_inquiries, channels_used,
    last_msl_date, last_digital_date, last_congress_date, last_inquiry_date, last_any_engagement
    FROM channel_engagement""", ["channel_engagement"])

# ----------------------------------------------------------------------------- S10
table("extract_incremental", "silver_extracted")

sql("extract_model", """SELECT interaction_id, scientific_topic, information_need, sentiment, interest_level, follow_up_requested,
    topic_category, CAST(NULL AS VARCHAR) AS error FROM silver_extracted""", ["silver_extracted"])

# ----------------------------------------------------------------------------- K2
table("refresh_incremental", "next_best_engagement")
table("silver_hcp_incremental", "silver_hcp")
# Only the table itself is as of another day; the notes are the same.
CTES["topic_interest_earlier"] = (CTES["topic_interest"][0].replace(AS_OF, "DATE '2023-12-02'"), CTES["topic_interest"][1])
table("topic_interest_earlier")

# ----------------------------------------------------------------------------- metric views
from .. import config as _C  # noqa: E402
from ..sources.feeds import FEEDS, feed_columns  # noqa: E402
from .binding import HCP_CURRENT  # noqa: E402
from .sqlgen import q, rhu  # noqa: E402


def _avg10(col: str, unit: int) -> str:
    return f"CAST({rhu(f'SUM(CAST(round({col} * {unit}) AS BIGINT))', f'{unit} * COUNT({col})', 4)} AS DOUBLE)"


_ENG = "CASE WHEN days_since_last_msl <= 90 THEN hcp_id END"
HCP_MEASURES = f"""COUNT(DISTINCT hcp_id) AS total_hcps,
    COUNT(DISTINCT {_ENG}) AS hcps_engaged_90d,
    CAST({rhu(f'COUNT(DISTINCT {_ENG}) * 100', 'COUNT(DISTINCT hcp_id)', 4)} AS DOUBLE) AS hcp_reach_pct,
    COUNT(DISTINCT CASE WHEN under_engaged_priority THEN hcp_id END) AS under_engaged_priority_hcps,
    {_avg10('engagement_score', 10)} AS avg_engagement_score,
    {_avg10('educational_need_score', 10)} AS avg_educational_need_score,
    CAST({rhu('SUM(influence_score)', 'COUNT(influence_score)', 4)} AS DOUBLE) AS avg_influence_score,
    CAST(SUM(msl_interactions) AS BIGINT) AS total_msl_interactions,
    {_avg10('email_open_rate', 1000)} AS avg_email_open_rate,
    CAST(SUM(follow_ups_requested) AS BIGINT) AS open_follow_ups"""
sql("metric_hcp_by_territory", f"SELECT territory, {HCP_MEASURES} FROM hcp_360 GROUP BY territory", ["hcp_360"])
sql("metric_hcp_by_tier", f"SELECT hcp_tier, {HCP_MEASURES} FROM hcp_360 GROUP BY hcp_tier", ["hcp_360"])
sql("metric_hcp_global", f"SELECT {HCP_MEASURES} FROM hcp_360", ["hcp_360"])

for _d, _col in [("specialty", "specialty"), ("practice_setting", "practice_setting"),
                 ("therapeutic_area", "primary_therapeutic_area"), ("top_scientific_topic", "top_scientific_topic"),
                 ("preferred_channel", "preferred_engagement_channel")]:
    sql(f"metric_hcp_by_{_d}", f"SELECT {_col} AS {_d}, {HCP_MEASURES} FROM hcp_360 GROUP BY ALL", ["hcp_360"])
sql("metric_hcp_by_territory_and_tier", f"SELECT territory, hcp_tier, {HCP_MEASURES} FROM hcp_360 GROUP BY ALL", ["hcp_360"])
sql("metric_hcp_influential_by_tier", f"SELECT hcp_tier, {HCP_MEASURES} FROM hcp_360 WHERE influence_score >= 60 GROUP BY ALL",
    ["hcp_360"])

_SLA = rhu("100 * COUNT(CASE WHEN sla_met THEN 1 END)", "COUNT(CASE WHEN response_status = 'Closed' THEN 1 END)", 4)
INQ_MEASURES = f"""COUNT(*) AS total_inquiries,
    COUNT(CASE WHEN response_status = 'Open' THEN 1 END) AS open_inquiries,
    COUNT(CASE WHEN overdue THEN 1 END) AS overdue_inquiries,
    CAST({rhu('SUM(response_time_days)', 'COUNT(response_time_days)', 4)} AS DOUBLE) AS avg_response_days,
    CAST({_SLA} AS DOUBLE) AS sla_met_pct"""
for _d, _col in [("inquiry_topic", "inquiry_topic"), ("evidence_type", "evidence_type_requested"), ("indication", "indication"),
                 ("response_status", "response_status")]:
    sql(f"metric_inquiries_by_{_d}", f"SELECT {_col} AS {_d}, {INQ_MEASURES} FROM gold_inquiries GROUP BY ALL", ["gold_inquiries"])
sql("metric_inquiries_by_product", f"SELECT product, {INQ_MEASURES} FROM gold_inquiries GROUP BY product",
    ["gold_inquiries"])
sql("metric_inquiries_by_month", f"""SELECT CAST(date_trunc('month', inquiry_date) AS DATE) AS inquiry_month,
    {INQ_MEASURES} FROM gold_inquiries GROUP BY 1""", ["gold_inquiries"])
sql("nl_sla_by_product", f"""SELECT product, CAST({_SLA} AS DOUBLE) AS sla_met_pct, COUNT(*) AS total_inquiries
    FROM gold_inquiries GROUP BY product""", ["gold_inquiries"])

# ----------------------------------------------------------------------------- dashboard
sql("kpi_headline", f"""SELECT * FROM (WITH people AS (
    SELECT count(*) AS n, count(*) FILTER (r.priority_tier = 'High') AS high, count(*) FILTER (h.days_since_last_msl <= 90) AS seen,
      count(*) FILTER (h.under_engaged_priority) AS neglected FROM hcp_360 h JOIN hcp_priority r USING (hcp_id)),
  asked AS (
    SELECT count(*) FILTER (overdue) AS late, sum(response_time_days) FILTER (response_status = 'Closed') AS days,
      count(response_time_days) FILTER (response_status = 'Closed') AS closed FROM gold_inquiries)
  SELECT n AS total_hcps, high AS priority_high, CAST({rhu('seen', 'n', 3)} AS DOUBLE) AS reach_90d_pct,
    neglected AS under_engaged, late AS overdue_inquiries, CAST({rhu('days', 'closed', 1)} AS DOUBLE) AS avg_response_days
  FROM people CROSS JOIN asked)""", ["hcp_360", "hcp_priority", "gold_inquiries"])
sql("reach_by_territory", """SELECT territory, total_hcps, reach_rate, under_engaged_priority_hcps,
    territory_opportunity_score AS opportunity_score FROM territory_opportunity ORDER BY reach_rate ASC""",
    ["territory_opportunity"])
_TOTALS = """SELECT topic_category, CAST(SUM(mentions) AS BIGINT) AS mentions, COUNT(DISTINCT hcp_id) AS hcps
    FROM topic_interest GROUP BY topic_category"""
sql("topic_interest_totals", _TOTALS + " ORDER BY mentions DESC", ["topic_interest"])
sql("inquiry_sla_by_product", f"""SELECT * FROM (WITH asked AS (
    SELECT product, [1, overdue::INT, sla_met::INT, (response_status = 'Closed')::INT] AS c FROM gold_inquiries),
  total AS (SELECT product, sum(c[1]) AS n, sum(c[2]) AS late, sum(c[3]) AS met, sum(c[4]) AS closed FROM asked GROUP BY ALL)
  SELECT product, CAST(n AS BIGINT) AS total_inquiries, CAST(coalesce(late, 0) AS BIGINT) AS overdue_inquiries,
    CAST({rhu('coalesce(met, 0)', 'closed', 3)} AS DOUBLE) AS sla_met_pct FROM total) ORDER BY total_inquiries DESC""", ["gold_inquiries"])
sql("priority_distribution", "SELECT priority_tier, COUNT(*) AS hcps FROM hcp_priority GROUP BY priority_tier",
    ["hcp_priority"])
sql("queue_top25", """SELECT hcp_id, hcp_name, territory, priority_tier, msl_priority_score, trigger, topic,
    recommended_date FROM next_best_engagement ORDER BY msl_priority_score DESC, hcp_id LIMIT 25""",
    ["next_best_engagement"])

# ----------------------------------------------------------------------------- NL answers
sql("nl_high_under_engaged", """SELECT p.hcp_id, p.hcp_name, p.territory, p.msl_priority_score,
    p.days_since_last_msl, n.trigger, n.overdue, n.recommended_date
    FROM hcp_priority p JOIN next_best_engagement n USING (hcp_id)
    WHERE p.priority_tier = 'High' AND p.under_engaged_priority AND n.overdue""", ["hcp_priority", "next_best_engagement"])
sql("nl_top_topics", _TOTALS + " ORDER BY mentions DESC, topic_category LIMIT 5", ["topic_interest"])
sql("nl_lowest_reach", """SELECT * FROM (WITH known AS (
    SELECT territory, reach_rate, under_engaged_priority_hcps FROM territory_opportunity
    WHERE territory IS NOT NULL AND reach_rate IS NOT NULL AND under_engaged_priority_hcps IS NOT NULL)
  SELECT k.* FROM known k WHERE (SELECT count(*) FROM known o WHERE o.reach_rate < k.reach_rate) < 5)
  ORDER BY reach_rate, territory""", ["territory_opportunity"])
sql("nl_overdue_avg", f"""SELECT CAST(COUNT_IF(overdue) AS BIGINT) AS overdue_inquiries,
    CAST({rhu('SUM(response_time_days)', 'COUNT(response_time_days)', 1)} AS DOUBLE) AS avg_response_days
    FROM gold_inquiries""", ["gold_inquiries"])
sql("nl_tier1_safety", """SELECT h.hcp_id, h.hcp_name, h.territory, i.inquiry_id, i.inquiry_date,
    i.response_status, i.product
    FROM silver_hcp h JOIN gold_inquiries i USING (hcp_id)
    WHERE h.hcp_tier = 'Tier 1 KOL' AND i.response_status <> 'Closed'
      AND lower(i.inquiry_topic) = lower('Safety / ILD Management')""", ["silver_hcp", "gold_inquiries"])
sql("extraction_distribution", """SELECT topic_category, sentiment, interest_level, COUNT(*) AS notes
    FROM silver_extracted GROUP BY topic_category, sentiment, interest_level""", ["silver_extracted"])

_ROWS = (["bronze_hcp_master", "bronze_msl_interactions", "bronze_medical_inquiries", "bronze_congress_events",
          "bronze_digital_engagement", "bronze_publications_trials", "bronze_patient_claims_summary",
          "bronze_approved_content", "bronze_content_shared"]
         + ["silver_hcp", "silver_inquiries", "silver_congress", "silver_digital", "silver_publications",
            "silver_claims", "silver_content", "silver_content_shared", "silver_extracted",
            "gold_inquiries", "gold_publications", "gold_content", "gold_content_shared", "interaction_summary",
            "topic_interest", "congress_engagement", "channel_engagement", "hcp_360", "hcp_priority",
            "next_best_engagement", "territory_opportunity"])
_ALIAS = {"gold_publications": "silver_publications", "gold_content": "silver_content",
          "gold_content_shared": "silver_content_shared"}


def _layer(n: str) -> str:
    return n.split("_", 1)[0] if n.startswith(("bronze_", "silver_")) else "gold"


sql("row_counts", "\nUNION ALL\n".join(
    f"SELECT {q(_layer(n))} AS layer, {q(n)} AS table_name, COUNT(*) AS row_count FROM {_ALIAS.get(n, n)}"
    for n in _ROWS), [_ALIAS.get(n, n) for n in _ROWS])

# ----------------------------------------------------------------------------- cockpit
sql("app_hcp_list", """SELECT hcp_id, hcp_name, specialty, territory, hcp_tier, msl_priority_score, priority_tier
    FROM hcp_priority ORDER BY msl_priority_score DESC, hcp_name, hcp_id""", ["hcp_priority"])


def _latest(src: str, order: str, n: int, cols: str) -> str:
    return f"""SELECT hcp_id, recency_rank, {cols} FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY hcp_id ORDER BY {order}) AS INTEGER) AS recency_rank
      FROM {src}) WHERE recency_rank <= {n}"""


sql("app_recent_interactions", _latest(
    "silver_extracted", "interaction_date DESC, interaction_id DESC", 5,
    "interaction_id, interaction_date, channel, msl_name, topic_category, scientific_topic, information_need, "
    "sentiment, interest_level, follow_up_requested, competitor_mentioned, evidence_type_requested"),
    ["silver_extracted"])
sql("app_topic_interests", """SELECT hcp_id,
    CAST(row_number() OVER (PARTITION BY hcp_id ORDER BY topic_interest_score DESC, mentions DESC,
                                 topic_category) AS INTEGER) AS interest_rank,
    topic_category, mentions, topic_interest_score, mentions_current_30d, mentions_prior_30d,
    last_mention_date, mentions_current_30d - mentions_prior_30d AS momentum
    FROM topic_interest""", ["topic_interest"])
sql("app_recent_inquiries", _latest(
    "gold_inquiries", "inquiry_date DESC, inquiry_id DESC", 5,
    "inquiry_id, inquiry_date, inquiry_topic, evidence_type_requested, indication, product, response_status, "
    "response_time_days, overdue"), ["gold_inquiries"])
sql("app_publications", _latest(
    "silver_publications", "year DESC, record_id DESC", 8,
    "record_id, record_type, title, journal_or_registry, year, therapeutic_area, trial_id"),
    ["silver_publications"])

CTES_EXTRA = {
    "recommend_content": ("""
  SELECT hcp_id, content_id, content_title, content_type, topic_category, indication, product,
    approval_status, med_review_id, approval_date
  FROM (
    SELECT t.hcp_id, c.*, row_number() OVER (PARTITION BY t.hcp_id
             ORDER BY c.approval_date DESC, c.content_id DESC) AS rn
    FROM top_topic t JOIN silver_content c ON c.topic_category = t.top_scientific_topic
    WHERE c.approval_status = 'Approved'
      AND c.content_id NOT IN (SELECT a.content_id FROM silver_content_shared a WHERE a.hcp_id = t.hcp_id))
  WHERE rn = 1""", ["top_topic", "silver_content", "silver_content_shared"]),
}


def _even0(x: str) -> str:
    """Half-even rounding to an integer of a non-negative 1-decimal score (Python's format rule)."""
    return f"CAST(round_even(CAST({x} AS DECIMAL(10,1)), 0) AS BIGINT)"


def _t(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


CTES_EXTRA["briefing_context"] = (f"""
  WITH t4 AS (
    SELECT hcp_id, string_agg(topic_category || ' (score ' || CAST({_even0('topic_interest_score')} AS VARCHAR)
                              || ')', ', ' ORDER BY rn) AS topics_txt
    FROM (SELECT *, row_number() OVER (PARTITION BY hcp_id
            ORDER BY topic_interest_score DESC, mentions DESC, topic_category) AS rn FROM topic_interest)
    WHERE rn <= 4 GROUP BY hcp_id),
  note AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hcp_id
            ORDER BY interaction_date DESC, interaction_id DESC) AS rn FROM silver_extracted) WHERE rn = 1),
  oi AS (
    SELECT hcp_id, string_agg(inquiry_topic || ' (' || indication || ')', '; ' ORDER BY rn) AS inq_txt
    FROM (SELECT *, row_number() OVER (PARTITION BY hcp_id ORDER BY rn) AS k FROM (
            SELECT *, row_number() OVER (PARTITION BY hcp_id ORDER BY inquiry_date DESC, inquiry_id DESC) AS rn
            FROM gold_inquiries) WHERE rn <= 5 AND response_status IS DISTINCT FROM 'Closed')
    WHERE k <= 3 GROUP BY hcp_id)
  SELECT h.hcp_id, concat_ws(chr(10),
    'HCP: ' || {_t('h.hcp_name')} || ', ' || {_t('h.specialty')} || ', ' || {_t('h.practice_setting')} || ' setting.',
    'Institution: ' || {_t('h.institution')} || ' (' || {_t('h.city')} || ', ' || {_t('h.state')} || ', '
      || {_t('h.territory')} || ').',
    'Tier: ' || {_t('h.hcp_tier')} || '. Influence ' || {_t('h.influence_score')} || ', publications '
      || {_t('h.publication_count')} || ', trials ' || {_t('h.trial_participation')} || '.',
    'Engagement: ' || {_t('h.msl_interactions')} || ' MSL interactions; ' || {_t('h.interactions_90d')}
      || ' in last 90 days; last MSL '
      || CASE WHEN h.days_since_last_msl = 999 THEN 'never' ELSE CAST(h.days_since_last_msl AS VARCHAR) || ' days ago' END
      || '.',
    CASE WHEN t4.topics_txt IS NOT NULL THEN 'Top scientific interests: ' || t4.topics_txt || '.' END,
    CASE WHEN len(h.emerging_topics) > 0
         THEN 'Emerging interest topics: [''' || array_to_string(h.emerging_topics, ''', ''') || '''].' END,
    CASE WHEN note.hcp_id IS NOT NULL THEN 'Most recent MSL note (' || strftime(note.interaction_date, '%Y-%m-%d')
      || ', ' || note.channel || '): topic ''' || note.scientific_topic || ''', need ''' || note.information_need
      || ''', sentiment ' || note.sentiment || ', interest ' || note.interest_level
      || ', follow-up requested: ' || CASE WHEN note.follow_up_requested THEN 'True' ELSE 'False' END
      || ', evidence: ' || note.evidence_type_requested
      || CASE WHEN note.competitor_mentioned IS NOT NULL AND note.competitor_mentioned <> 'None'
              THEN ', competitor: ' || note.competitor_mentioned ELSE '' END || '.' END,
    CASE WHEN oi.inq_txt IS NOT NULL THEN 'Open medical inquiries: ' || oi.inq_txt || '.' END,
    'Outstanding follow-ups requested: ' || {_t('h.follow_ups_requested')} || '.') AS context
  FROM hcp_360 h LEFT JOIN t4 USING (hcp_id) LEFT JOIN note USING (hcp_id) LEFT JOIN oi USING (hcp_id)""",
    ["hcp_360", "topic_interest", "silver_extracted", "gold_inquiries"])

CTES_EXTRA["serving_action_queue"] = ("""
  SELECT hcp_id, hcp_name, specialty, territory, priority_tier, msl_priority_score, engagement_segment,
    trigger, topic, suggested_engagement, recommended_date, overdue FROM next_best_engagement""",
    ["next_best_engagement"])

_SEED = f"""'seed-' || hcp_id AS request, hcp_id, {q(_C.SEED_MSL)} AS msl_name, {q(_C.SEED_DECISION)} AS review_decision"""
CTES_EXTRA["review_seed"] = (f"""
  SELECT row_number() OVER (ORDER BY sha256(request)) AS review_id, sha256(request) AS action_id, * EXCLUDE (request) FROM (
    SELECT {_SEED}, {q(_C.SEED_NOTES)} AS review_notes, {q(_C.SEED_CHANNEL)} AS scheduled_channel,
      DATE '2024-01-31' + 14 AS scheduled_date
    FROM serving_action_queue ORDER BY msl_priority_score DESC, hcp_id LIMIT 2)""", ["serving_action_queue"])
CTES_EXTRA["review_actions"] = (f"""
  SELECT * FROM review_seed
  UNION ALL
  SELECT (SELECT count(*) FROM review_seed) + row_number() OVER (ORDER BY sha256(format('bulk-{{}}-{{}}', k, hcp_id))) AS review_id,
    sha256(format('bulk-{{}}-{{}}', k, hcp_id)) AS action_id, hcp_id, {q(_C.SEED_MSL)} AS msl_name,
    {q(_C.SEED_DECISION)} AS review_decision, suggested_engagement AS review_notes,
    {q(_C.SEED_CHANNEL)} AS scheduled_channel, recommended_date AS scheduled_date
  FROM serving_action_queue, range(7) t(k) WHERE priority_tier = 'High'""", ["review_seed", "serving_action_queue"])

for _name, (_body, _deps) in CTES_EXTRA.items():
    CTES[_name] = (_body, _deps)
    table(_name)

sql("queue_lookup", """SELECT * FROM serving_action_queue WHERE hcp_id IN (
    SELECT hcp_id FROM silver_inquiries WHERE hcp_id IS NOT NULL GROUP BY hcp_id ORDER BY count(*) DESC, hcp_id LIMIT 50)""",
    ["serving_action_queue", "silver_inquiries"])
# The queue before and after newer notes and HCP versions arrived.
_OLDER = {"bronze_hcp_master": f"SELECT * FROM bronze_hcp_master WHERE _ingested_at < {HCP_CURRENT}",
          "bronze_msl_interactions": f"SELECT * FROM bronze_msl_interactions WHERE interaction_date < {AS_OF} - INTERVAL 120 DAY"}
sql("queue_changes", """SELECT CASE WHEN o.hcp_id IS NULL THEN 'insert' WHEN n.hcp_id IS NULL THEN 'delete' ELSE 'update' END AS change,
    coalesce(n.hcp_id, o.hcp_id) AS hcp_id, n.* EXCLUDE (hcp_id)
    FROM serving_action_queue n FULL JOIN serving_action_queue_before o ON n.hcp_id = o.hcp_id
    WHERE n IS DISTINCT FROM o""",
    ["serving_action_queue", as_before(CTES, "serving_action_queue", _OLDER)])

sql("briefing_text", """SELECT hcp_id, array_to_string(list_filter(string_split(context, chr(10)), lambda x:
      starts_with(x, 'HCP: ') OR starts_with(x, 'Engagement: ') OR starts_with(x, 'Open medical inquiries: ')), ' ') AS briefing,
    CAST(NULL AS VARCHAR) AS error FROM briefing_context""", ["briefing_context"])
sql("briefing_prompt", f"SELECT hcp_id, {q(_C.BRIEFING_INSTRUCTION)} || context AS prompt FROM briefing_context",
    ["briefing_context"])
sql("engagement_plan", """SELECT h.hcp_id,
    coalesce(n.suggested_engagement, 'Address outstanding scientific question') AS objective,
    coalesce(n.trigger, 'Scientific engagement cadence') AS trigger,
    coalesce(n.topic, h.top_scientific_topic, 'Scientific exchange') AS topic,
    coalesce(r.content_title, 'MSL to identify approved asset') AS supporting_asset,
    coalesce(h.preferred_engagement_channel, 'In-person') AS preferred_channel,
    coalesce(h.recommended_follow_up_window, 'Within 30 days') AS timing,
    'MSL confirmation' AS required_review
    FROM hcp_360 h LEFT JOIN next_best_engagement n USING (hcp_id) LEFT JOIN recommend_content r USING (hcp_id)""",
    ["hcp_360", "next_best_engagement", "recommend_content"])
_PAD = [bytes(b ^ x for b in _C.DEFAULT.mask_key.encode().ljust(64, b"\0")).hex() for x in (0x36, 0x5C)]
def _hmac(value: str) -> str:
    return f"sha256(from_hex('{_PAD[1]}') || from_hex(sha256(from_hex('{_PAD[0]}') || encode({value}))))"


sql("masked_hcp_360", f"SELECT * REPLACE ({_hmac('npi')} AS npi) FROM hcp_360", ["hcp_360"])
sql("masked_contacts", f"""SELECT hcp_id, {_hmac('npi')} AS licence, {_hmac("concat_ws('/', territory, npi)")} AS route,
    {_hmac('substr(npi, 1, 2)')} AS series, hcp_tier, CAST(length(hcp_name) AS INTEGER) AS name_chars FROM silver_hcp""", ["silver_hcp"])
sql("action_queue_top50", "SELECT * FROM serving_action_queue ORDER BY msl_priority_score DESC, hcp_id LIMIT 50",
    ["serving_action_queue"])
sql("queue_check", """SELECT hcp_id, hcp_name, priority_tier, msl_priority_score, trigger,
    (SELECT COUNT(*) FROM serving_action_queue) AS queue_rows
    FROM serving_action_queue ORDER BY msl_priority_score DESC, hcp_id LIMIT 5""", ["serving_action_queue"])
sql("recent_reviews", """SELECT review_id, action_id, hcp_id, msl_name, review_decision, review_notes, scheduled_channel,
    scheduled_date FROM (SELECT *, row_number() OVER (PARTITION BY hcp_id
      ORDER BY action_id IN (SELECT action_id FROM review_seed), action_id DESC) AS rn
    FROM review_actions) WHERE rn <= 5""", ["review_actions", "review_seed"])

# ----------------------------------------------------------------------------- bronze ingest
def _bronze(feed: str) -> str:
    """The feed's rows as three drops bring them: the second with one column more, the third with one less."""
    key, *_, last = cols = feed_columns(feed)
    drop = f"coalesce(ascii(right({key}, 1)), 0) % 3"
    if feed == "hcp_master":
        drop = f"CASE WHEN _ingested_at >= {HCP_CURRENT} THEN 1 + coalesce(ascii(right({key}, 1)), 0) % 2 ELSE 0 END"
    return f"""SELECT {', '.join(cols[:-1])}, CASE WHEN d < 2 THEN {last} END AS {last},
      CASE WHEN d = 1 AND {key} IS NOT NULL THEN CAST(json_object('system_key', upper({key})) AS VARCHAR) END AS rescued, 'drop-' || d AS source_drop,
      CAST(CASE WHEN d = 0 THEN 0 ELSE 1 END AS INTEGER) AS ingest_batch, true AS ingest_ok
    FROM (SELECT *, {drop} AS d FROM bronze_{feed})"""


for _feed in FEEDS:
    sql(f"bronze_{_feed}", _bronze(_feed), [f"bronze_{_feed}"])

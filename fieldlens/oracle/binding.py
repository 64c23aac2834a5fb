"""The nine bound feeds (bronze shape) as DuckDB SQL over the star-schema views."""

from __future__ import annotations

from .. import config as C
from ..sources import testbind as TB
from .sqlgen import AS_OF, pick, q, rhu

HCP_CURRENT = f"TIMESTAMP {q(TB.HCP_CURRENT_TS)}"
HCP_OLDER = f"TIMESTAMP {q(TB.HCP_OLDER_TS)}"


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _line_id(prefix: str) -> str:
    """order-line-part-supplier-shipday: unique for every lineitem row."""
    return (f"{prefix}{_v('l_orderkey')} || '-' || {_v('l_linenumber')} || '-' || {_v('l_partkey')} || '-' "
            f"|| {_v('l_suppkey')} || '-' || strftime(l_shipdate, '%Y%m%d')")


def _lineage(feed: str) -> str:
    return f"{HCP_CURRENT} AS _ingested_at, {q('bound:' + feed)} AS _source_file"


HCP_COLS = ("hcp_id, hcp_name, specialty, institution, city, state, territory, practice_setting, "
            "hcp_tier, publication_count, trial_participation, influence_score, npi, "
            "primary_therapeutic_area")

BRONZE_HCP = f"""
  WITH c AS (
    SELECT c_custkey AS k, c_name, c_mktsegment, c_nationkey, n_name,
      CASE WHEN c_custkey % 5 = 0 THEN (7 * c_custkey) % 91 ELSE (7 * c_custkey) % 36 END AS pubs,
      CASE WHEN c_custkey % 5 = 0 THEN (3 * c_custkey) % 13 ELSE (3 * c_custkey) % 5 END AS trials
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
  base AS (
    SELECT k, {_v('k')} AS hcp_id,
      CASE WHEN k % 7 = 0 THEN c_name || ' ' ELSE c_name END AS hcp_name,
      c_mktsegment AS specialty,
      n_name || ' Cancer Institute ' || {_v('k % 4')} AS institution,
      n_name || ' City' AS city,
      {pick(TB.STATES, 'c_nationkey % 10')} AS state,
      n_name AS territory,
      {pick(C.PRACTICE_SETTINGS, '(k // 5) % 5')} AS practice_setting,
      CASE WHEN k % 5 = 0 THEN 'Tier 1 KOL' WHEN k % 5 <= 2 THEN 'Tier 2' ELSE 'Tier 3' END AS hcp_tier,
      CAST(pubs AS INTEGER) AS publication_count,
      CAST(trials AS INTEGER) AS trial_participation,
      CAST(LEAST(100, (200 + 6 * pubs + 30 * trials + 10 * (k % 26)) // 10) AS INTEGER) AS influence_score,
      '1' || lpad({_v('k')}, 9, '0') AS npi,
      'Oncology' AS primary_therapeutic_area
    FROM c)
  SELECT {HCP_COLS}, {HCP_CURRENT} AS _ingested_at, 'bound:hcp_master' AS _source_file FROM base
  UNION ALL
  SELECT hcp_id, hcp_name || ' (superseded)', specialty, institution, city, state, territory,
    practice_setting, hcp_tier, publication_count, trial_participation,
    CAST(GREATEST(influence_score - 7, 0) AS INTEGER), npi, primary_therapeutic_area,
    {HCP_OLDER}, 'bound:hcp_master' FROM base WHERE k % 10 = 0
  UNION ALL
  SELECT NULL, hcp_name, specialty, institution, city, state, territory, practice_setting, hcp_tier,
    publication_count, trial_participation, influence_score, npi, primary_therapeutic_area,
    {HCP_CURRENT}, 'bound:hcp_master' FROM base WHERE k % 97 = 0"""


def _note() -> str:
    comp = "CASE WHEN competitor = 'None' THEN '' ELSE ' Also considered: ' || competitor || '.' END"
    fu = "CASE WHEN follow_up THEN ' Call back agreed.' ELSE ' No call back.' END"
    return ("format('Contact ({}). Subject: {}. Product: {} / {} / {}. Mood: {}. Interest: {}. Ask: {}. Evidence: {}.', "
            "lower(channel), topic, product, inn, indication, lower(sentiment), lower(interest), need, lower(evidence)) "
            f"|| {comp} || {fu} || remark")


BRONZE_NOTES = f"""
  WITH j AS (
    SELECT {_line_id('')} AS interaction_id,
      l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, o_custkey,
      CAST(l_shipdate AS DATE) AS ship, l_linenumber
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  f AS (
    SELECT *,
      {pick(C.CHANNELS, 'sk % 5')} AS channel,
      {pick(TB.BOUND_TOPICS, 'pk % 9')} AS topic,
      {pick(TB.PI_PRODUCT, 'ok % 9')} AS product,
      {pick(TB.PI_INN, 'ok % 9')} AS inn,
      {pick(TB.PI_INDICATION, 'ok % 9')} AS indication,
      {pick(C.SENTIMENTS, '(ok // 9) % 5')} AS sentiment,
      {pick(C.INTEREST, '(pk // 9) % 5')} AS interest,
      {pick(C.INFO_NEEDS, '(sk // 5) % 10')} AS need,
      {pick(C.EVIDENCE_TYPES, '(ok // 45) % 8')} AS evidence,
      {pick(C.COMPETITORS, 'o_custkey % 8')} AS competitor,
      (pk % 60) < 9 AS follow_up,
      CASE WHEN pk % 11 = 0 THEN chr(10) || 'Asked: "could I get the chart pack".' ELSE '' END AS remark
    FROM j)
  SELECT interaction_id,
    {_v('o_custkey')} AS hcp_id,
    'MSL-' || {_v('sk % 8 + 1')} AS msl_name,
    {AS_OF} - CAST((date_diff('day', ship, DATE '2001-11-04') + 2500 * (l_linenumber % 2)) % 5000 AS INTEGER) AS interaction_date,
    channel,
    CAST(15 * (1 + pk % 4) AS INTEGER) AS duration_minutes,
    {_note()} AS raw_notes,
    {_lineage('msl_interactions')}
  FROM f"""

BRONZE_INQUIRIES = f"""
  WITH o AS (
    SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus,
      {AS_OF} - CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') % 720 AS INTEGER) AS idate,
      [2, 3, 5][o_orderkey % 3 + 1] AS target,
      o_orderkey % 9 AS pi
    FROM orders),
  s AS (
    SELECT *,
      CASE WHEN o_orderstatus = 'F' OR date_diff('day', idate, {AS_OF}) > 60 THEN 'Closed'
           WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'P' THEN 'In Progress' END AS status
    FROM o),
  r AS (
    SELECT *,
      CASE WHEN status = 'Closed' THEN 1 + ok % 7 ELSE date_diff('day', idate, {AS_OF}) END AS response
    FROM s)
  SELECT 'INQ-' || {_v('ok')} AS inquiry_id, {_v('ck')} AS hcp_id, idate AS inquiry_date,
    {pick(C.INQUIRY_TOPICS, '(ok // 12) % 9')} AS inquiry_topic,
    {pick(C.EVIDENCE_TYPES, 'ck % 8')} AS evidence_type_requested,
    {pick(TB.PI_INDICATION, 'pi')} AS indication,
    status AS response_status,
    CAST(response AS INTEGER) AS response_time_days,
    (status = 'Closed' AND response <= target) AS sla_met,
    CAST(target AS INTEGER) AS sla_target_days,
    {pick(TB.PI_PRODUCT, 'pi')} AS product,
    {_lineage('medical_inquiries')}
  FROM r"""

BRONZE_CONGRESS = f"""
  WITH j AS (
    SELECT {_line_id("'CE-' || ")} AS event_attendance_id,
      l_partkey AS pk, l_suppkey AS sk, o_custkey,
      CASE WHEN l_returnflag = 'A' AND l_partkey % 8 = 0 THEN 'Attended' WHEN l_returnflag IN ('A', 'R') THEN 'Registered'
           WHEN l_returnflag = 'N' THEN 'No-show' END AS status
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT event_attendance_id,
    {_v('o_custkey')} AS hcp_id,
    {pick(C.CONGRESS_EVENTS, 'sk % 7')} AS event_name,
    {AS_OF} - CAST(50 * (sk % 7) AS INTEGER) AS event_date,
    {pick(TB.BOUND_TOPICS, 'pk % 9')} AS session_topic,
    'Oncology' AS therapeutic_area,
    status AS attendance_status,
    (status = 'Attended' AND pk % 5 < 2) AS visited_medical_booth,
    {_lineage('congress_events')}
  FROM j"""

BRONZE_DIGITAL = f"""
  SELECT 'DIG-' || {_v('event_id')} AS engagement_id,
    {_v('user_id * 10 + event_id % 8')} AS hcp_id,
    CAST(ts AS DATE) AS activity_date,
    CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 2 WHEN 'click' THEN 3
              WHEN 'error' THEN 1 END
         AS INTEGER) AS emails_sent,
    CAST(CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 WHEN 'view' THEN 1 WHEN 'click' THEN 2
              WHEN 'error' THEN 0 END
         AS INTEGER) AS emails_opened,
    'Digital asset ' || {_v('event_id % 25')} AS content_title,
    CASE WHEN event_type = 'signup' THEN 'Webinar' WHEN event_type = 'view' THEN 'Web page' ELSE 'Email' END
      AS content_type,
    CAST(CASE WHEN event_type = 'click' THEN 3 + event_id % 3 ELSE 0 END AS INTEGER) AS webpage_clicks,
    (event_type = 'signup' AND event_id % 2 = 0) AS attended_webinar,
    CAST(CAST(floor(value) AS INTEGER) % 46 AS INTEGER) AS content_minutes_viewed,
    {_lineage('digital_engagement')}
  FROM events"""

BRONZE_PUBLICATIONS = f"""
  SELECT 'PUB-' || {_v('p_partkey')} AS record_id,
    {_v('p_partkey % (SELECT greatest(count(*) // 15, 1) FROM customer)')} AS hcp_id,
    CASE WHEN p_size % 5 < 3 THEN 'Publication' ELSE 'Clinical Trial' END AS record_type,
    p_name AS title,
    CASE WHEN p_size % 5 < 3 THEN {pick(TB.JOURNALS, 'p_size % 4')} ELSE 'ClinicalTrials.gov' END
      AS journal_or_registry,
    CAST(2020 + p_size % 7 AS INTEGER) AS year,
    'Oncology' AS therapeutic_area,
    CASE WHEN p_size % 5 < 3 THEN NULL ELSE 'NCT' || lpad({_v('p_partkey')}, 8, '0') END AS trial_id,
    CAST(CASE WHEN p_size % 5 < 3 THEN 4 * p_size ELSE 0 END AS INTEGER) AS citation_count,
    {_lineage('publications_trials')}
  FROM part"""

_DIAG = [TB.PI_INDICATION[i] for i in TB.DIAGNOSIS_INDEX]
BRONZE_CLAIMS = f"""
  WITH s AS (
    SELECT s_suppkey AS sk, s_nationkey, n_name, 40 + (37 * s_suppkey) % 561 AS diagnosed
    FROM supplier JOIN nation ON s_nationkey = n_nationkey),
  t AS (SELECT *, (15 * diagnosed) // 100 + sk % 20 AS treated FROM s)
  SELECT 'CLM-' || {_v('sk')} AS claim_summary_id,
    n_name || ' metro ' || {_v('sk % 3')} AS city,
    {pick(TB.STATES, 's_nationkey % 10')} AS state,
    n_name AS territory,
    {pick(_DIAG, 'sk % 5')} AS diagnosis,
    {pick(C.PRODUCTS, 'sk % 5')} AS primary_therapy,
    CAST(diagnosed AS INTEGER) AS diagnosed_patient_count,
    CAST(treated AS INTEGER) AS treated_patient_count,
    CAST({rhu('treated * 100', 'diagnosed', 2)} AS DOUBLE) AS treatment_penetration_rate,
    {_lineage('patient_claims_summary')}
  FROM t"""


def _content_cols(pk: str) -> str:
    return (f"'CNT-' || {_v(pk)} AS content_id, "
            f"{pick(TB.BOUND_CATEGORIES, pk + ' % 9')} || ': ' || {pick(TB.CONTENT_TYPES, pk + ' % 5')} "
            f"|| ' ' || {_v(pk)} AS content_title, "
            f"{pick(TB.CONTENT_TYPES, pk + ' % 5')} AS content_type, "
            f"{pick(TB.BOUND_CATEGORIES, pk + ' % 9')} AS topic_category")


BRONZE_CONTENT = f"""
  SELECT {_content_cols('p_partkey')},
    {pick(TB.PI_INDICATION, 'p_partkey % 9')} AS indication,
    {pick(TB.PI_PRODUCT, 'p_partkey % 9')} AS product,
    {AS_OF} - CAST((13 * p_partkey) % 630 AS INTEGER) AS approval_date,
    CASE WHEN p_partkey % 17 = 0 THEN 'Expired' ELSE 'Approved' END AS approval_status,
    'MRC-' || {_v('p_partkey')} AS med_review_id,
    {_lineage('approved_content')}
  FROM part"""

BRONZE_SHARED = f"""
  SELECT {_line_id("'SHR-' || ")} AS share_id,
    {_v('o_custkey')} AS hcp_id,
    {_content_cols('l_partkey')},
    {AS_OF} - CAST(l_orderkey % 200 AS INTEGER) AS shared_date,
    'MSL-' || {_v('l_suppkey % 8 + 1')} AS shared_by_msl,
    {pick(TB.SHARE_CHANNELS, 'l_suppkey % 3')} AS share_channel,
    {_lineage('content_shared')}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

BRONZE_SQL = {
    "bronze_hcp_master": BRONZE_HCP,
    "bronze_msl_interactions": BRONZE_NOTES,
    "bronze_medical_inquiries": BRONZE_INQUIRIES,
    "bronze_congress_events": BRONZE_CONGRESS,
    "bronze_digital_engagement": BRONZE_DIGITAL,
    "bronze_publications_trials": BRONZE_PUBLICATIONS,
    "bronze_patient_claims_summary": BRONZE_CLAIMS,
    "bronze_approved_content": BRONZE_CONTENT,
    "bronze_content_shared": BRONZE_SHARED,
}

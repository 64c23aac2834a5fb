"""Hand-computed scores, window boundaries, NULL handling and tie determinism."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldlens.config import DEFAULT
from fieldlens.operators import extract as X
from fieldlens.operators import gold as G
from fieldlens.operators import silver as S

AS_OF = DEFAULT.as_of


def ago(n):
    return AS_OF - dt.timedelta(days=n)


HCP_SCHEMA = ("hcp_id string, hcp_name string, specialty string, institution string, city string, state string, "
              "territory string, practice_setting string, hcp_tier string, primary_therapeutic_area string, "
              "publication_count int, trial_participation int, influence_score int, npi string, "
              "_ingested_at timestamp, _source_file string")
NOTE_SCHEMA = ("interaction_id string, hcp_id string, msl_name string, interaction_date date, channel string, "
               "duration_minutes int, raw_notes string")
INQ_SCHEMA = ("inquiry_id string, hcp_id string, inquiry_date date, inquiry_topic string, "
              "evidence_type_requested string, indication string, response_status string, "
              "response_time_days int, sla_met boolean, sla_target_days int, product string")
CG_SCHEMA = ("event_attendance_id string, hcp_id string, event_name string, event_date date, session_topic string, "
             "therapeutic_area string, attendance_status string, visited_medical_booth boolean")
DIG_SCHEMA = ("engagement_id string, hcp_id string, activity_date date, emails_sent int, emails_opened int, "
              "content_title string, content_type string, webpage_clicks int, attended_webinar boolean, "
              "content_minutes_viewed int")
PUB_SCHEMA = ("record_id string, hcp_id string, record_type string, title string, journal_or_registry string, "
              "year int, therapeutic_area string, trial_id string, citation_count int")


def note(topic, interest="high", follow=False, competitor=None):
    comp = f" Also considered: {competitor}." if competitor else ""
    return (f"Contact (phone). Subject: {topic}. Product: Velomab / velotuzumab / early ductal carcinoma. Mood: positive. "
            f"Interest: {interest}. Ask: share the poster. Evidence: efficacy.{comp} "
            f"{'Call back agreed.' if follow else 'No call back.'}")


def hcp_row(hid, influence, territory="T1", ts="2024-01-30 00:00:00", name=None):
    return (hid, name or f"Dr {hid}", "Oncology", "Inst", "City", "ST", territory, "Academic", "Tier 2",
            "Oncology", 3, 1, influence, "1000000000", dt.datetime.fromisoformat(ts), "f.csv")


@pytest.fixture(scope="module")
def fixture(spark):
    hcps = spark.createDataFrame([
        hcp_row("h1", 80), hcp_row("h2", 60), hcp_row("h3", 59), hcp_row("h4", 70, territory=None),
        hcp_row("h1", 10, ts="2023-01-01 00:00:00", name="old"),  # older version, dropped
        hcp_row(None, 99),                                          # NULL id, dropped
    ], HCP_SCHEMA)
    notes = spark.createDataFrame([
        ("n1", "h1", "m", ago(30), "Phone", 30, note("brain metastases", "high", True)),
        ("n2", "h1", "m", ago(31), "Phone", 45, note("brain metastases", "medium")),
        ("n3", "h1", "m", ago(60), "Phone", 15, note("dose timing", "low", competitor="Hexavir")),
        ("n4", "h1", "m", ago(-5), "Virtual", 20, note("dose timing", "high")),   # future date counts <= 30
        ("n5", "h2", "m", ago(91), "Phone", 30, note("brain metastases", "low")),
        ("n6", "h2", "m", ago(180), "Phone", 30, note("brain metastases", "low")),
        ("n7", "h3", "m", ago(61), "Phone", 30, note("survival outcomes", "high")),
    ], NOTE_SCHEMA)
    inq = spark.createDataFrame([
        ("q1", "h1", ago(10), "t", "e", "i", "Open", 10, False, 3, "Velomab"),       # overdue
        ("q2", "h1", ago(2), "t", "e", "i", "Open", 2, False, 3, "Velomab"),         # not yet
        ("q3", "h2", ago(40), "t", "e", "i", None, 40, False, 2, "Velomab"),         # NULL status -> NULL
        ("q4", "h3", ago(40), "t", "e", "i", "Closed", 2, True, None, "Corvexa"),   # NULL target
    ], INQ_SCHEMA)
    cg = spark.createDataFrame([
        ("c1", "h1", "E1", ago(5), "s", "Oncology", "Attended", True),
        ("c2", "h1", "E1", ago(5), "s2", "Oncology", "No-show", False),
    ], CG_SCHEMA)
    dig = spark.createDataFrame([
        ("d1", "h1", ago(3), 3, 1, "t", "Email", 25, True, 5),
        ("d2", "h2", ago(3), 0, 0, "t", "Email", 0, False, 5),  # 0 emails sent -> open rate 0
    ], DIG_SCHEMA)
    pubs = spark.createDataFrame([("p1", "h1", "Publication", "t", "j", 2021, "Oncology", None, 4)], PUB_SCHEMA)
    hcp = S.silver_hcp(hcps)
    ext = X.silver_extracted(notes)
    inquiries = S.silver_inquiries(inq, DEFAULT)
    profile = G.hcp_profile(hcp, G.note_rollup(ext, DEFAULT), inquiries, cg, dig, pubs, DEFAULT)
    return {"hcp": hcp, "ext": ext, "inq": inquiries, "profile": profile, "cg": cg, "dig": dig}


def by_id(df, key="hcp_id"):
    return {r[key]: r for r in df.collect()}


def test_silver_hcp_keeps_newest_and_drops_null(fixture):
    rows = by_id(fixture["hcp"])
    assert set(rows) == {"h1", "h2", "h3", "h4"}
    assert rows["h1"].influence_score == 80 and rows["h1"].hcp_name == "Dr h1"


def test_overdue_three_valued(fixture):
    rows = by_id(fixture["inq"], "inquiry_id")
    assert rows["q1"].overdue is True
    assert rows["q2"].overdue is False
    assert rows["q3"].overdue is None      # NULL status propagates
    assert rows["q4"].overdue is False     # Closed


def test_interaction_boundaries(fixture):
    s = by_id(G.interaction_summary(G.msl_rollup(G.note_rollup(fixture["ext"], DEFAULT), DEFAULT)))
    h1, h2 = s["h1"], s["h2"]
    assert (h1.total_interactions, h1.interactions_30d, h1.interactions_90d) == (4, 2, 4)
    assert h1.avg_duration_min == 27.5            # (30+45+15+20)/4
    assert h1.days_since_last_interaction == -5   # future note is the latest
    assert h1.follow_ups_requested == 1
    assert (h2.interactions_90d, h2.interactions_180d) == (0, 2)


def test_topic_interest_score(fixture):
    t = {(r.hcp_id, r.topic_category): r for r in G.topic_interest(G.note_rollup(fixture["ext"], DEFAULT), DEFAULT).collect()}
    cns = t[("h1", "CNS / Brain Metastases")]
    # mentions 2, current (<=30 d) 1 [day 30], prior (31-60) 1 [day 31], weights High 3 + Medium 2
    assert (cns.mentions, cns.mentions_current_30d, cns.mentions_prior_30d) == (2, 1, 1)
    assert cns.avg_interest_weight == 2.5
    assert cns.topic_interest_score == 2 * 10 + 1 * 8 + 2.5 * 6   # 43.0
    dose = t[("h1", "Dosing & Administration")]
    assert (dose.mentions_current_30d, dose.mentions_prior_30d) == (1, 1)  # future + day 60
    assert dose.topic_interest_score == 20 + 8 + 2.0 * 6  # weights High 3, Low 1


def test_profile_scores(fixture):
    p = by_id(fixture["profile"])
    h1 = p["h1"]
    assert h1.email_open_rate == 0.333
    # digital = min(100, 0.333*50 + 1*10 + min(25,20)) = 46.65 -> 46.7 (HALF_UP on exact decimals)
    assert h1.digital_engagement_score == 46.7
    # need = min(100, 2 open * 12 + 1 follow-up * 8 + 43.0 * 0.25) = 42.75 -> 42.8
    assert h1.educational_need_score == 42.8
    # engagement = min(100, 4 * 14 + 1 attended * 8 + 0.333 * 20) = 70.66 -> 70.7
    assert h1.engagement_score == 70.7
    assert h1.under_engaged_priority is False
    assert h1.recommended_follow_up_window == "Within 14 days"  # open inquiries
    h2 = p["h2"]
    assert h2.email_open_rate == 0.0 and h2.days_since_last_msl == 91
    assert h2.under_engaged_priority is True  # influence 60 and > 90 days
    h3 = p["h3"]
    assert h3.under_engaged_priority is False  # influence 59
    assert h3.recommended_follow_up_window == "Within 30 days"  # 61 days, no open inquiry
    h4 = p["h4"]
    assert h4.days_since_last_msl == 999 and h4.msl_interactions == 0
    assert h4.preferred_engagement_channel == "In-person"
    assert h4.last_any_engagement == dt.date(2000, 1, 1)


def test_priority_and_next_best(fixture):
    nb = by_id(G.with_next_best(fixture["profile"], DEFAULT))
    h1 = nb["h1"]
    # 0.40*80 + 0.35*42.8 + 0.25*(100-70.7) = 32 + 14.98 + 7.325 = 54.305 -> 54.3
    assert h1.msl_priority_score == 54.3 and h1.priority_tier == "Medium"
    assert h1.trigger == "Open medical inquiry overdue" and h1.overdue is True
    assert h1.recommended_date == AS_OF + dt.timedelta(days=14)
    assert h1.engagement_segment == "Highly Engaged"
    assert nb["h2"].trigger == "High-influence KOL under-engaged"
    h4 = nb["h4"]
    assert h4.topic == "General Scientific Exchange"
    assert h4.suggested_engagement == ("Address outstanding scientific question with approved evidence on "
                                       "the portfolio")
    assert h4.suggested_channel_topic == "In-person · Scientific exchange"
    assert nb["h3"].trigger == "Scientific engagement cadence"


def test_tier_uses_rounded_score(spark):
    # 0.40*100 + 0.35*42.7 + 0.25*(100-100) = 54.945 -> 54.9; and a 64.95 -> 65.0 High case
    rows = [("a", 100, 42.7, 100.0), ("b", 100, 71.3, 100.0)]
    df = spark.createDataFrame(rows, "hcp_id string, influence_score int, educational_need_score double, "
                                     "engagement_score double")
    out = by_id(G.with_priority(df, DEFAULT))
    assert out["a"].msl_priority_score == 54.9 and out["a"].priority_tier == "Medium"
    # 40 + 24.955 + 0 = 64.955 -> 65.0 -> High
    assert out["b"].msl_priority_score == 65.0 and out["b"].priority_tier == "High"


def test_territory_null_kept_and_claims_unmatched(spark, fixture):
    claims = spark.createDataFrame([("c", "x", "y", "T1", "d", "p", 100, 50, 50.0),
                                    ("c2", "x", "y", "T1", "d", "p", 10, 3, 30.01)],
                                   "claim_summary_id string, city string, state string, territory string, "
                                   "diagnosis string, primary_therapy string, diagnosed_patient_count int, "
                                   "treated_patient_count int, treatment_penetration_rate double")
    t = {r.territory: r for r in G.territory_opportunity(fixture["profile"], claims, DEFAULT).collect()}
    assert set(t) == {"T1", None}
    assert t["T1"].total_hcps == 3 and t["T1"].diagnosed_patients == 110
    assert t["T1"].avg_treatment_penetration == 40.01  # (50.00 + 30.01) / 2 = 40.005 -> 40.01
    assert t[None].diagnosed_patients == 0 and t[None].total_hcps == 1


def test_ties_do_not_depend_on_partitioning(spark):
    d = dt.date(2024, 1, 10)
    rows = [(f"n{i}", "h", "m", d, "Phone", 30, note("brain metastases" if i % 2 else "dose timing", "high"))
            for i in range(8)]
    notes = spark.createDataFrame(rows, NOTE_SCHEMA)
    results = set()
    for n in (1, 7):
        ext = X.silver_extracted(notes.repartition(n))
        top = G.top_topic(G.topic_interest(G.note_rollup(ext, DEFAULT), DEFAULT)).collect()[0]
        latest = G.latest_note(G.msl_rollup(G.note_rollup(ext, DEFAULT), DEFAULT)).collect()[0]
        results.add((top.top_scientific_topic, latest.recent_question))
    assert results == {("CNS / Brain Metastases", "share the poster")}


def test_profile_unique_per_hcp(spark):
    from fieldlens.plans.catalog import Lakehouse

    p = Lakehouse(spark, "/root/testdata/sf0.001").table("hcp_profile")
    assert p.count() == p.select("hcp_id").distinct().count()

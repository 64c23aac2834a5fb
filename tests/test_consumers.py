"""Content recommendation vs brute force, lowest-reach ranking, metric identities, masking."""

import datetime as dt

from pyspark.sql import functions as F

from fieldlens.operators import consumers as CS
from fieldlens.operators import governance as GOV
from fieldlens.plans.catalog import Lakehouse
from fieldlens.plans.metrics import HCP_ENGAGEMENT

CONTENT = ("content_id string, content_title string, content_type string, topic_category string, "
           "indication string, product string, approval_date date, approval_status string, med_review_id string")


def brute_force(top, content, shared):
    """Per HCP: newest Approved asset of the top topic whose id is NOT IN the HCP's shared ids."""
    out = {}
    for hcp, topic in top:
        ids = [c for h, c in shared if h == hcp]
        if any(c is None for c in ids):
            continue  # NOT IN over a list holding NULL yields no row
        cands = [c for c in content if c[3] == topic and c[7] == "Approved" and c[0] not in ids]
        if cands:
            out[hcp] = max(cands, key=lambda c: (c[6], c[0]))[0]
    return out


def test_recommend_content_matches_brute_force(spark):
    d = dt.date(2024, 1, 1)
    content = [(f"c{i}", f"t{i}", "Deck", "A" if i < 6 else "B", "x", "p", d - dt.timedelta(days=i % 4),
                "Expired" if i == 1 else "Approved", "m") for i in range(9)]
    top = [("h1", "A"), ("h2", "A"), ("h3", "B"), ("h4", "C"), ("h5", "A")]
    shared = [("h1", "c0"), ("h1", "c4"), ("h1", "c8"), ("h2", "c0"), ("h2", "c4"), ("h2", "c5"), ("h2", "c3"),
              ("h2", "c2"), ("h5", None), ("h5", "c0")]
    got = CS.recommend_content(
        spark.createDataFrame(top, "hcp_id string, top_scientific_topic string"),
        spark.createDataFrame(content, CONTENT),
        spark.createDataFrame(shared, "hcp_id string, content_id string"))
    assert {r.hcp_id: r.content_id for r in got.collect()} == brute_force(top, content, shared)


def test_lowest_reach_keeps_ties(spark):
    rows = [("a", 10.0, 1), ("b", 20.0, 1), ("c", 20.0, 1), ("d", 30.0, 1), ("e", 40.0, 1), ("f", 40.0, 1),
            ("g", 50.0, 1), ("h", None, 1)]
    df = spark.createDataFrame(rows, "territory string, reach_rate double, under_engaged_priority_hcps int")
    assert [r.territory for r in CS.nl_lowest_reach(df).collect()] == ["a", "b", "c", "d", "e", "f"]


def test_metric_view_grains_agree(spark):
    h360 = Lakehouse(spark, "/root/testdata/sf0.001").table("hcp_360").cache()
    g = HCP_ENGAGEMENT.query(h360).collect()[0]
    t = HCP_ENGAGEMENT.query(h360, ["territory"]).agg(
        F.sum("total_hcps").alias("n"), F.sum("hcps_engaged_90d").alias("e"),
        F.sum("total_msl_interactions").alias("m")).collect()[0]
    assert (g.total_hcps, g.hcps_engaged_90d, g.total_msl_interactions) == (t.n, t.e, t.m)
    assert g.total_hcps == h360.count()
    tiers = HCP_ENGAGEMENT.query(h360, ["hcp_tier"], ["total_hcps"]).agg(F.sum("total_hcps")).collect()[0][0]
    assert tiers == g.total_hcps
    h360.unpersist()


def test_masking_hashes_tagged_columns(spark):
    df = spark.createDataFrame([("h1", "1000000001")], "hcp_id string, npi string")
    m = GOV.mask(GOV.classify(df), "key")
    assert GOV.pii_columns(m) == ["npi"]
    r = m.collect()[0]
    assert r.hcp_id == "h1" and len(r.npi) == 64 and r.npi != "1000000001"


def test_any_question_from_the_stored_cube(spark, tmp_dir):
    import itertools

    from fieldlens.plans.catalog import Lakehouse
    from fieldlens.plans.metrics import MEDICAL_INQUIRIES

    lh = Lakehouse(spark, "/root/testdata/sf0.001")
    h360 = lh.table("hcp_360")
    HCP_ENGAGEMENT.cube(h360).write.parquet(f"{tmp_dir}/cells")
    cells = spark.read.parquet(f"{tmp_dir}/cells")
    rows = lambda df: sorted(map(repr, df.collect()))
    for dims in [[], ["territory"], ["specialty", "hcp_tier"], ["preferred_channel", "top_scientific_topic", "practice_setting"]]:
        assert rows(HCP_ENGAGEMENT.query_cube(cells, dims)) == rows(HCP_ENGAGEMENT.query(h360, dims)), dims
    strong = F.col("influence_score") >= 60
    assert rows(HCP_ENGAGEMENT.query_cube(cells, ["hcp_tier"], where=strong)) == rows(HCP_ENGAGEMENT.query(h360, ["hcp_tier"], where=strong))
    plan = HCP_ENGAGEMENT.query_cube(cells, ["territory"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    none = HCP_ENGAGEMENT.query(h360.where("false")).first()
    assert (none["total_hcps"], none["hcp_reach_pct"], none["total_msl_interactions"]) == (0, None, None)
    inquiries = lh.table("gold_inquiries")
    for dims in itertools.combinations(["product", "inquiry_month", "response_status"], 2):
        assert rows(MEDICAL_INQUIRIES.query_cube(MEDICAL_INQUIRIES.cube(inquiries), list(dims))) == rows(MEDICAL_INQUIRIES.query(inquiries, list(dims)))

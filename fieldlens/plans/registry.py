"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import consumers as C
from ..operators import extract as X
from ..operators import gold as G
from ..operators import governance as GOV
from ..operators import model as M
from ..operators import serving as SV
from ..sources.tables import fingerprint, spread
from .catalog import Lakehouse
from .states import NoteStates

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


_GRAPHS: dict[tuple, Lakehouse] = {}


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The table graph for ``sf_dir`` in this application, built once.

    DataFrames are immutable lazy plans, so registered queries over the same
    tables share one graph (binding, extraction, rollups) instead of rebuilding
    it through thousands of driver calls per query. Nothing is cached in
    memory: every action plans and reads the files again. Files that were added, removed or
    rewritten since give a new graph; ``Lakehouse(spark, dir)`` gives a fresh one.
    """
    inputs = fingerprint(spark, sf_dir)
    spread(spark, sf_dir)
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, inputs)
    if key not in _GRAPHS:
        while len(_GRAPHS) >= 8:  # plans only; the oldest graph goes
            _GRAPHS.pop(next(iter(_GRAPHS)))
        _GRAPHS[key] = Lakehouse(spark, sf_dir)
        _GRAPHS[key].inputs = inputs
    return _GRAPHS[key]


def register(key: str):
    def deco(fn: Callable[[Lakehouse], DataFrame]) -> Callable[[Lakehouse], DataFrame]:
        REGISTRY[key] = lambda spark, sf_dir: fn(lakehouse(spark, sf_dir))
        return fn
    return deco


def _table(key: str, name: str | None = None) -> None:
    REGISTRY[key] = lambda spark, sf_dir: lakehouse(spark, sf_dir).table(name or key)


# ----------------------------------------------------------------------------- silver
for _k in ["silver_hcp", "silver_inquiries", "silver_congress", "silver_digital", "silver_publications",
           "silver_claims", "silver_content", "silver_content_shared", "silver_extracted"]:
    _table(_k)


# ----------------------------------------------------------------------------- extraction steps (S9a-g)
@register("extract_prompt")
def _extract_prompt(lh: Lakehouse) -> DataFrame:
    return X.extract_prompt(lh.table("bronze_msl_interactions")).select("interaction_id", "prompt")


@register("extract_fields")
def _extract_fields(lh: Lakehouse) -> DataFrame:
    p = X.extract_prompt(lh.table("bronze_msl_interactions"))
    return X.RegexExtractor().apply(p).select("interaction_id", "extracted_raw")


@register("extract_clean_json")
def _extract_clean(lh: Lakehouse) -> DataFrame:
    raw = _extract_fields(lh)
    fenced = F.concat(F.lit("```json"), F.col("extracted_raw"), F.lit("```"))
    return raw.select("interaction_id", X.clean_json(fenced).alias("cleaned_json"))


@register("extract_parse")
def _extract_parse(lh: Lakehouse) -> DataFrame:
    parsed = _extract_clean(lh).select("interaction_id", X.parse_response(F.col("cleaned_json")).alias("j"))
    return parsed.select("interaction_id", "j.*")


@register("extract_defaults")
def _extract_defaults(lh: Lakehouse) -> DataFrame:
    return lh.table("silver_extracted").select(
        "interaction_id", "therapeutic_area", "scientific_topic", "information_need",
        "product_or_indication", "sentiment", "interest_level", "follow_up_requested",
        "competitor_mentioned", "preferred_channel", "evidence_type_requested")


@register("extract_followup_date")
def _extract_followup(lh: Lakehouse) -> DataFrame:
    return lh.table("silver_extracted").select(
        "interaction_id", "interaction_date", "follow_up_requested", "recommended_follow_up_date")


@register("topic_category")
def _topic_category(lh: Lakehouse) -> DataFrame:
    return lh.table("silver_extracted").select("interaction_id", "scientific_topic", "topic_category")


# ----------------------------------------------------------------------------- gold
for _k in ["gold_inquiries", "gold_publications", "gold_content", "gold_content_shared",
           "interaction_summary", "topic_interest", "congress_engagement", "channel_engagement",
           "hcp_360", "hcp_priority", "next_best_engagement", "territory_opportunity"]:
    _table(_k)


@register("top_topic")
def _top_topic(lh: Lakehouse) -> DataFrame:
    return G.top_topic(lh.table("topic_interest"))


@register("emerging_topics")
def _emerging(lh: Lakehouse) -> DataFrame:
    return G.emerging_topics(lh.table("topic_interest"))


@register("latest_note")
def _latest_note(lh: Lakehouse) -> DataFrame:
    return G.latest_note(G.msl_rollup(lh.table("note_rollup"), lh.settings))


@register("open_inquiries")
def _open_inquiries(lh: Lakehouse) -> DataFrame:
    return G.open_inquiries(G.inquiry_rollup(lh.table("silver_inquiries")))


@register("pubs_tracked")
def _pubs(lh: Lakehouse) -> DataFrame:
    return G.pubs_tracked(lh.table("silver_publications"))


# ----------------------------------------------------------------------------- S10 incremental extraction
@register("extract_incremental")
def _extract_incremental(lh: Lakehouse) -> DataFrame:
    """Two refreshes against a stored hash cache: older notes first, then all notes.

    The second run extracts only notes whose hash is not cached; the result
    equals a full extraction.
    """
    from ..session import work_dir

    spark = lh.spark
    notes = lh.table("bronze_msl_interactions")
    cache_path = work_dir(spark, "extract-cache") + "/cache"
    X.extract_incremental(spark, older_notes(lh), cache_path)
    return X.extract_incremental(spark, notes, cache_path)


# ----------------------------------------------------------------------------- S9b, A15: a model step
def _store(lh: Lakehouse, name: str) -> M.ResponseStore:
    from ..session import work_dir

    return M.ResponseStore(lh.spark, work_dir(lh.spark, name))


@register("extract_model")
def _extract_model(lh: Lakehouse) -> DataFrame:
    """Extraction by calls to a (stand-in) model, each distinct prompt once."""
    calls = M.ModelCalls(M.template_model, "template-1")
    table = M.extract_with_model(lh.table("bronze_msl_interactions"), _store(lh, "extract-model"), calls)
    return table.select("interaction_id", "scientific_topic", "information_need", "sentiment", "interest_level",
                        "follow_up_requested", "topic_category", "error")


@register("briefing_text")
def _briefing_text(lh: Lakehouse) -> DataFrame:
    """A briefing per HCP, generated by a (stand-in) model from its prompt."""
    calls = M.ModelCalls(M.briefing_model, "briefing-1")
    made = M.generate(C.briefing_prompt(_context(lh)), _store(lh, "briefings"), calls)
    return made.select("hcp_id", F.col("response").alias("briefing"), "error")


# ----------------------------------------------------------------------------- K2: incremental refresh
def _two_waves(lh: Lakehouse) -> NoteStates:
    """Older notes first, then the newer ones: each wave extracts and adds up its own notes only."""
    from ..session import work_dir

    store = NoteStates(lh.spark, work_dir(lh.spark, "note-states"))
    notes = lh.table("bronze_msl_interactions")
    day = F.date_sub(F.lit(lh.settings.as_of), 120)
    waves = [F.col("interaction_date") < day, F.coalesce(F.col("interaction_date") >= day, F.lit(True))]
    for batch, wave in enumerate(waves):
        store.update(batch, lambda after, wave=wave: X.silver_extracted(notes.where(wave), lh.extractor))
    return store


@register("refresh_incremental")
def _refresh_incremental(lh: Lakehouse) -> DataFrame:
    """The queue after the second wave, from stored states; the first wave's notes are not read again."""
    store = _two_waves(lh)
    after = Lakehouse(lh.spark, lh.sf_dir, lh.settings)
    after.replace("note_rollup", store.rollup(lh.settings))
    return after.table("next_best_engagement")


@register("silver_hcp_incremental")
def _silver_hcp_incremental(lh: Lakehouse) -> DataFrame:
    """S1 kept up to date: first versions, then the current ones, which rewrite only the buckets they hit."""
    from ..operators import silver as S
    from ..session import work_dir
    from .buckets import NewestByKey

    bronze = lh.table("bronze_hcp_master").select(*S.HCP_COLUMNS, "_ingested_at", "_source_file")
    store = NewestByKey(lh.spark, work_dir(lh.spark, "silver-hcp"), "hcp_id", S.version_order)
    current = F.col("_ingested_at") >= F.lit(bound_current()).cast("timestamp")
    store.update(bronze.where(~current))
    store.update(bronze.where(current))
    return S.cleaned_hcp(store.table(bronze.schema))


EARLIER = dt.date(2023, 12, 2)


@register("topic_interest_earlier")
def _topics_earlier(lh: Lakehouse) -> DataFrame:
    """Topic interest as of another day, from the same states, merged to one a day."""
    store = _two_waves(lh)
    store.compact()
    return G.topic_interest(store.rollup(lh.settings, EARLIER), replace(lh.settings, as_of=EARLIER))


# ----------------------------------------------------------------------------- metric views (M1-M3)
_CUBES: dict[tuple, str] = {}


def _cells(lh: Lakehouse, name: str) -> DataFrame:
    """The stored cube of a metric view over the tables as they are now: built once, read by every question."""
    from ..session import work_dir
    from .metrics import MEDICAL_INQUIRIES, hcp_engagement

    key = (lh.spark.sparkContext.applicationId, lh.sf_dir, lh.inputs, name)
    if key not in _CUBES:
        view, source = (hcp_engagement(lh.settings), "hcp_360") if name == "hcp" else (MEDICAL_INQUIRIES, "gold_inquiries")
        path = work_dir(lh.spark, f"cube-{name}") + "/cells"
        view.cube(lh.table(source)).write.parquet(path)
        _CUBES[key] = path
    return lh.spark.read.parquet(_CUBES[key])


def _metric(key: str, view: str, dims: list[str], measures: list[str] | None = None, where: Callable | None = None):
    from .metrics import MEDICAL_INQUIRIES, hcp_engagement

    def run(lh: Lakehouse) -> DataFrame:
        of = hcp_engagement(lh.settings) if view == "hcp" else MEDICAL_INQUIRIES
        return of.query_cube(_cells(lh, view), dims, measures, where() if where else None)
    register(key)(run)


_metric("metric_hcp_by_territory", "hcp", ["territory"])
_metric("metric_hcp_by_tier", "hcp", ["hcp_tier"])
_metric("metric_hcp_global", "hcp", [])
for _d in ["specialty", "practice_setting", "therapeutic_area", "top_scientific_topic", "preferred_channel"]:
    _metric(f"metric_hcp_by_{_d}", "hcp", [_d])
_metric("metric_hcp_by_territory_and_tier", "hcp", ["territory", "hcp_tier"])
_metric("metric_hcp_influential_by_tier", "hcp", ["hcp_tier"], where=lambda: F.col("influence_score") >= 60)
for _d in ["inquiry_topic", "evidence_type", "indication", "response_status"]:
    _metric(f"metric_inquiries_by_{_d}", "inq", [_d])
_metric("metric_inquiries_by_product", "inq", ["product"])
_metric("metric_inquiries_by_month", "inq", ["inquiry_month"])
_metric("nl_sla_by_product", "inq", ["product"], ["sla_met_pct", "total_inquiries"])


# ----------------------------------------------------------------------------- dashboard, NL, cockpit
def _wide(lh: Lakehouse) -> DataFrame:
    return G.with_next_best(lh.table("hcp_profile"), lh.settings)


@register("kpi_headline")
def _kpi(lh: Lakehouse) -> DataFrame:
    return C.kpi_headline(lh.table("hcp_profile"), lh.table("gold_inquiries"), lh.settings)


register("reach_by_territory")(lambda lh: C.reach_by_territory(lh.table("territory_opportunity")))
register("topic_interest_totals")(lambda lh: C.topic_interest_totals(lh.table("topic_interest")))
register("inquiry_sla_by_product")(lambda lh: C.inquiry_sla_by_product(lh.table("gold_inquiries")))
register("priority_distribution")(lambda lh: C.priority_distribution(lh.table("hcp_priority")))
register("queue_top25")(lambda lh: C.queue_top25(lh.table("next_best_engagement"), lh.settings))
register("nl_high_under_engaged")(lambda lh: C.nl_high_under_engaged(_wide(lh)))
register("nl_top_topics")(lambda lh: C.nl_top_topics(lh.table("topic_interest")))
register("nl_lowest_reach")(lambda lh: C.nl_lowest_reach(lh.table("territory_opportunity")))
register("nl_overdue_avg")(lambda lh: C.nl_overdue_avg(lh.table("gold_inquiries")))
register("nl_tier1_safety")(lambda lh: C.nl_tier1_safety(lh.table("silver_hcp"), lh.table("gold_inquiries")))
register("extraction_distribution")(lambda lh: C.extraction_distribution(lh.table("silver_extracted")))

ROW_COUNT_TABLES = (
    [f"bronze_{f}" for f in ["hcp_master", "msl_interactions", "medical_inquiries", "congress_events",
                             "digital_engagement", "publications_trials", "patient_claims_summary",
                             "approved_content", "content_shared"]]
    + ["silver_hcp", "silver_inquiries", "silver_congress", "silver_digital", "silver_publications",
       "silver_claims", "silver_content", "silver_content_shared", "silver_extracted",
       "gold_inquiries", "gold_publications", "gold_content", "gold_content_shared", "interaction_summary",
       "topic_interest", "congress_engagement", "channel_engagement", "hcp_360", "hcp_priority",
       "next_best_engagement", "territory_opportunity"])


@register("row_counts")
def _row_counts(lh: Lakehouse) -> DataFrame:
    """One refresh writes the tables and counts their rows on the way; its published counts are read, no table is."""
    from ..session import work_dir
    from . import publish as PB

    out = work_dir(lh.spark, "counted-refresh")
    Lakehouse(lh.spark, lh.sf_dir, lh.settings).refresh(out)
    counts = PB.counts(lh.spark, out)
    return C.row_counts(lh.spark, {n: counts[n] for n in ROW_COUNT_TABLES})


register("app_hcp_list")(lambda lh: C.app_hcp_list(G.with_priority(lh.table("hcp_profile"), lh.settings)))
@register("app_recent_interactions")
def _recent_interactions(lh: Lakehouse) -> DataFrame:
    """A3 from raw notes: rank first (partial WindowGroupLimit), then extract only the
    rows shown. Extraction is row-wise, so this equals ranking the extracted table,
    with a fraction of the extraction work (and of the model calls, for a model extractor)."""
    s = lh.settings
    notes = lh.table("bronze_msl_interactions")
    newest = C._latest(notes, [F.desc("interaction_date"), F.desc("interaction_id")], s.recent_limit, "recency_rank")
    return C.shown_interactions(X.silver_extracted(newest, lh.extractor, more=["recency_rank"]))
register("app_topic_interests")(lambda lh: C.app_topic_interests(lh.table("topic_interest")))
register("app_recent_inquiries")(lambda lh: C.app_recent_inquiries(lh.table("gold_inquiries"), lh.settings))
register("app_publications")(lambda lh: C.app_publications(lh.table("gold_publications"), lh.settings))


def _recommend(lh: Lakehouse) -> DataFrame:
    return C.recommend_content(G.top_topic(lh.table("topic_interest")), lh.table("gold_content"),
                               lh.table("gold_content_shared"))


register("recommend_content")(_recommend)


def _context(lh: Lakehouse) -> DataFrame:
    return C.briefing_context(lh.table("hcp_profile"), lh.table("gold_inquiries"), lh.settings)


register("briefing_context")(_context)
register("briefing_prompt")(lambda lh: C.briefing_prompt(_context(lh)))
register("engagement_plan")(lambda lh: C.engagement_plan(
    _wide(lh), lh.table("gold_content"), lh.table("gold_content_shared")))
register("masked_hcp_360")(lambda lh: GOV.publishable(GOV.mask(GOV.classify_derived(lh.table("hcp_360")), lh.settings.mask_key)))


@register("masked_contacts")
def _masked_contacts(lh: Lakehouse) -> DataFrame:
    """A table with columns made from the identifier under other names: all of them are found and masked."""
    contacts = lh.table("silver_hcp").select(
        "hcp_id", F.col("npi").alias("licence"), F.concat_ws("/", "territory", "npi").alias("route"), F.substring("npi", 1, 2).alias("series"),
        "hcp_tier", F.length("hcp_name").alias("name_chars"))
    return GOV.publishable(GOV.mask(GOV.classify_derived(contacts), lh.settings.mask_key))


# ----------------------------------------------------------------------------- serving
_SNAPSHOTS: dict[tuple, str] = {}


def _queue_root(lh: Lakehouse) -> str:
    """Where the queue of the tables as they are now is served: published once for an application and state of the input files."""
    from ..session import work_dir

    key = (lh.spark.sparkContext.applicationId, lh.sf_dir, lh.inputs)
    if key not in _SNAPSHOTS:
        root = work_dir(lh.spark, "serving") + "/msl_action_queue"
        SV.publish_snapshot(SV.action_queue(lh.table("next_best_engagement")), root)
        _SNAPSHOTS[key] = root
    return _SNAPSHOTS[key]


def _queue_snapshot(lh: Lakehouse) -> DataFrame:
    return SV.served_snapshot(lh.spark, _queue_root(lh))


@register("queue_lookup")
def _queue_lookup(lh: Lakehouse) -> DataFrame:
    """Point reads of the served queue: the HCPs with the most inquiries."""
    busiest = (lh.table("silver_inquiries").where(F.col("hcp_id").isNotNull()).groupBy("hcp_id").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), "hcp_id").limit(lh.settings.queue_limit))
    return SV.lookup(lh.spark, _queue_root(lh), [r["hcp_id"] for r in busiest.collect()])


def _before(lh: Lakehouse) -> Lakehouse:
    """The tables as they were when only the older notes and the first versions of HCPs had arrived."""
    older = Lakehouse(lh.spark, lh.sf_dir, lh.settings)
    master = lh.table("bronze_hcp_master")
    older.replace("bronze_hcp_master", master.where(F.col("_ingested_at") < F.lit(bound_current()).cast("timestamp")))
    older.replace("bronze_msl_interactions", older_notes(lh))
    return older


def _two_versions(lh: Lakehouse) -> tuple[Lakehouse, Lakehouse]:
    """:func:`_before` and the tables as they are now, for the queue: what both read is rolled up once and stored.

    Each note is extracted once and added to the rollup of its wave; all notes are the merged rollups of both. The other
    rollups are the same in both versions. Of the notes only what the queue reads is stored; the rest is NULL.
    """
    from concurrent.futures import ThreadPoolExecutor

    from ..session import work_dir

    s, root = lh.settings, work_dir(lh.spark, "queue-rollups")
    notes = X.silver_extracted(lh.table("bronze_msl_interactions").withColumn("older", F.coalesce(_is_older(lh), F.lit(False))),
                               lh.extractor, more=["older"])
    waves = G.note_rollup(notes, s, ["older"])
    unread = ["max_sentiment", "brief"]
    frames = {"notes": waves.drop(*unread), "congress_rollup": lh.table("congress_rollup").drop("session_topics"),
              **{name: lh.table(name) for name in ("digital_rollup", "inquiry_rollup", "pubs_rollup")}}
    with ThreadPoolExecutor(len(frames)) as pool:
        for job in [pool.submit(f.write.parquet, f"{root}/{name}") for name, f in frames.items()]:
            job.result()
    stored = {name: lh.spark.read.parquet(f"{root}/{name}") for name in frames}
    parts = stored.pop("notes").select("*", *[F.lit(None).cast(waves.schema[c].dataType).alias(c) for c in unread])
    before, now = _before(lh), Lakehouse(lh.spark, lh.sf_dir, s)
    before.replace("note_rollup", parts.where("older").drop("older"))
    now.replace("note_rollup", G.merged_rollup(parts.drop("older")))
    for version in (before, now):
        for name, rows in stored.items():
            version.replace(name, rows)
    return before, now


def _is_older(lh: Lakehouse) -> Column:
    return F.col("interaction_date") < F.date_sub(F.lit(lh.settings.as_of), 120)


def older_notes(lh: Lakehouse) -> DataFrame:
    return lh.table("bronze_msl_interactions").filter(_is_older(lh))


@register("queue_changes")
def _queue_changes(lh: Lakehouse) -> DataFrame:
    """K3: two published versions of the queue, before and after newer notes and HCP versions, and what changed between them."""
    from ..session import work_dir

    root = work_dir(lh.spark, "serving-feed") + "/msl_action_queue"
    for version in _two_versions(lh):
        SV.publish_snapshot(SV.action_queue(version.table("next_best_engagement")), root)
    return SV.changes(SV.snapshot_at(lh.spark, root, 1), SV.snapshot_at(lh.spark, root, 2))


register("serving_action_queue")(_queue_snapshot)
register("action_queue_top50")(lambda lh: SV.top_of_queue(_queue_snapshot(lh), lh.settings.queue_limit))
register("queue_check")(lambda lh: SV.queue_check(_queue_snapshot(lh)))

REVIEW_OUT = ["hcp_id", "msl_name", "review_decision", "review_notes", "scheduled_channel", "scheduled_date"]


def _review_log(lh: Lakehouse, with_bulk: bool) -> str:
    from .. import config as CF
    from ..session import work_dir

    spark = lh.spark
    queue = _queue_snapshot(lh)
    log = work_dir(spark, "reviews") + "/msl_review_actions"
    _at_once(lambda: SV.seed_reviews(spark, queue, log, lh.settings))  # one of two seeders records it
    if with_bulk:
        turns = F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k")  # seven requests each, so the newest-five limit bites
        approvals = queue.filter(F.col("priority_tier") == "High").select("*", turns).select(
            F.concat(F.lit("bulk-"), F.col("k").cast("string"), F.lit("-"), "hcp_id").alias("request_id"), "hcp_id", F.lit(CF.SEED_MSL).alias("msl_name"), F.lit(CF.SEED_DECISION).alias("review_decision"),
            F.col("suggested_engagement").alias("review_notes"),
            F.lit(CF.SEED_CHANNEL).alias("scheduled_channel"), F.col("recommended_date").alias("scheduled_date"))
        _at_once(lambda: SV.append_reviews(spark, approvals, log))  # two appenders of the same requests
    return log


def _at_once(job: Callable, writers: int = 2) -> None:
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(writers) as pool:
        for done in [pool.submit(job) for _ in range(writers)]:
            done.result()


register("review_seed")(lambda lh: SV.read_log(lh.spark, _review_log(lh, False)).select("review_id", "action_id", *REVIEW_OUT))
register("review_actions")(lambda lh: SV.read_log(lh.spark, _review_log(lh, True)).select("review_id", "action_id", *REVIEW_OUT))
register("recent_reviews")(lambda lh: SV.recent_reviews(SV.read_log(lh.spark, _review_log(lh, True)),
                                                        lh.settings.recent_limit).select("review_id", "action_id", *REVIEW_OUT))


# ----------------------------------------------------------------------------- bronze ingest
def _drops(bound: DataFrame, feed: str) -> list[DataFrame]:
    """A feed's rows in three drops of different headers.

    The first has the feed's own header; the second has its columns in reverse order and one that the feed doesn't
    know; the third writes the names in capitals and lacks the last column. HCP versions that were superseded are in
    the first.
    """
    from ..sources.feeds import feed_columns

    columns = feed_columns(feed)
    last = F.ascii(F.substring(F.col(columns[0]), -1, 1))
    drop = last % 3
    if feed == "hcp_master":
        current = F.col("_ingested_at") >= F.lit(bound_current()).cast("timestamp")
        drop = F.when(current, 1 + F.coalesce(last, F.lit(0)) % 2).otherwise(0)
    rows = bound.withColumn("_drop", F.coalesce(drop, F.lit(0)))
    return [rows.where("_drop = 0").select(*columns),
            rows.where("_drop = 1").select(*reversed(columns), F.upper(F.col(columns[0])).alias("system_key")),
            rows.where("_drop = 2").select(*[F.col(c).alias(c.upper()) for c in columns[:-1]])]


def _bronze(feed: str):
    def run(lh: Lakehouse) -> DataFrame:
        from ..session import work_dir
        from ..sources.feeds import MULTILINE_FEEDS
        from ..sources.testbind import bind_feed
        from ..streaming import bronze as B

        spark, gzip = lh.spark, feed in MULTILINE_FEEDS
        root = work_dir(spark, f"bronze-{feed}")
        table, ckpt = f"{root}/table", f"{root}/_checkpoint"
        drops = _drops(bind_feed(lh.star, feed, lh.settings), feed)
        B.drop_files(drops[0], f"{root}/landing/drop-0", gzip=gzip)
        B.ingest(spark, feed, f"{root}/landing/*", table, ckpt)
        B.drop_files(drops[1], f"{root}/landing/drop-1", gzip=gzip)
        B.drop_files(drops[2], f"{root}/landing/drop-2", gzip=gzip)
        B.ingest(spark, feed, f"{root}/landing/*", table, ckpt)  # one batch with two headers
        B.ingest(spark, feed, f"{root}/landing/*", table, ckpt)  # no new files: stores nothing
        return B.bronze_view(spark, feed, table)
    return run


def bound_current() -> str:
    from ..sources.testbind import HCP_CURRENT_TS

    return HCP_CURRENT_TS


for _feed in ["hcp_master", "msl_interactions", "medical_inquiries", "congress_events", "digital_engagement",
              "publications_trials", "patient_claims_summary", "approved_content", "content_shared"]:
    register(f"bronze_{_feed}")(_bronze(_feed))

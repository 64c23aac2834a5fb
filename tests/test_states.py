"""Incremental refresh from mergeable states, observed row counts, doubled caches."""

import datetime as dt
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import functions as F

from fieldlens.config import DEFAULT
from fieldlens.operators import extract as X
from fieldlens.operators import gold as G
from fieldlens.plans import publish as PB
from fieldlens.plans.catalog import Lakehouse
from fieldlens.plans.registry import ROW_COUNT_TABLES
from fieldlens.plans.states import NoteStates, day_states, rollup

SF = "/root/testdata/sf0.001"
SCHEMA = ("hcp_id string, topic_category string, interaction_date date, interaction_id string, interest_level string, duration_minutes int, "
          "follow_up_requested boolean, sentiment string, information_need string, evidence_type_requested string, competitor_mentioned string, "
          "preferred_channel string, channel string, scientific_topic string")


def notes(spark, n=400, seed=1):
    rng = random.Random(seed)
    day = lambda: rng.choice([None] + [DEFAULT.as_of + dt.timedelta(days=rng.randint(-200, 5)) for _ in range(8)])
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["t1", "t2", None]), day(), f"i{i:04d}", rng.choice(["High", "Medium", "Low", None]),
             rng.choice([None, 5, 30]), rng.choice([True, False, None]), rng.choice(["Positive", "Neutral", None]), f"need {i}", "e",
             rng.choice(["None", "x"]), "Email", "Phone", "topic") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


def test_states_give_the_rollup_of_any_day(spark):
    rows = notes(spark)
    for as_of in (DEFAULT.as_of, DEFAULT.as_of - dt.timedelta(days=45), DEFAULT.as_of + dt.timedelta(days=400)):
        s = replace(DEFAULT, as_of=as_of)
        same(rollup(day_states(rows), s), G.note_rollup(rows, s))


def test_rollups_of_waves_merge_to_the_rollup_of_all_notes(spark):
    rows = notes(spark).withColumn("wave", F.expr("crc32(interaction_id) % 3"))
    parts = G.note_rollup(rows, DEFAULT, ["wave"])
    same(G.merged_rollup(parts.drop("wave")), G.note_rollup(rows, DEFAULT))
    same(parts.where("wave = 1").drop("wave"), G.note_rollup(rows.where("wave = 1"), DEFAULT))


def test_both_queue_versions_read_stored_rollups(spark):
    """Notes, congress rows, inquiries and digital touches are rolled up once for the two versions that are compared."""
    from fieldlens.plans import registry as R

    lh = R.lakehouse(spark, "/root/testdata/sf0.001")
    for stored, whole in zip(R._two_versions(lh), (R._before(lh), lh)):
        queue = stored.table("next_best_engagement")
        assert not [f for f in queue.inputFiles() if any(t in f for t in ("lineitem", "orders", "events"))]
        same(queue, whole.table("next_best_engagement"))


def test_waves_merge_and_are_stored_once(spark, tmp_dir):
    rows = notes(spark)
    store, asked = NoteStates(spark, f"{tmp_dir}/s"), []

    def wave(k):
        def extracted(after):
            asked.append((after, k))
            return rows.where(f"crc32(interaction_id) % 3 > {after} AND crc32(interaction_id) % 3 <= {k}")
        return extracted

    assert store.through() == -1
    store.update(0, wave(0))
    store.update(0, wave(0))   # nothing new: not extracted
    store.update(2, wave(2))
    assert asked == [(-1, 0), (0, 2)] and store.through() == 2
    same(store.rollup(DEFAULT), G.note_rollup(rows, DEFAULT))
    same(store.extracted(), rows)
    before = store.states().count()
    store.compact()
    keys = store.states().select("hcp_id", "topic_category", "day")
    assert keys.count() == keys.distinct().count() < before and store.compact() is None
    same(store.rollup(DEFAULT), G.note_rollup(rows, DEFAULT))


def test_compaction_copies_days_of_one_commit(spark, tmp_dir, monkeypatch):
    from fieldlens.plans import states as ST

    rows = notes(spark)
    day = DEFAULT.as_of - dt.timedelta(days=100)
    store = NoteStates(spark, f"{tmp_dir}/s")
    older = rows.where((rows.interaction_date < str(day)) | (rows.interaction_id == "i0001"))
    store.update(0, lambda after: older)
    store.update(1, lambda after: rows.join(older.select("interaction_id"), "interaction_id", "left_anti"))
    first, second = [{r[0] for r in spark.read.parquet(f).select("day").distinct().collect()} for f in store.folders("states")]
    seen, make = [], ST.merged

    def watched(states, keys, more=None):
        seen.append({r[0] for r in states.select("day").distinct().collect()})
        return make(states, keys, more)

    monkeypatch.setattr(ST, "merged", watched)
    store.compact()
    assert seen == [first & second] and len(first & second) < len(first | second)
    monkeypatch.undo()
    keys = store.states().select("hcp_id", "topic_category", "day")
    assert keys.count() == keys.distinct().count()
    same(store.rollup(DEFAULT), G.note_rollup(rows, DEFAULT))


def test_states_of_the_former_form_are_read(spark, tmp_dir):
    rows = notes(spark)
    store = NoteStates(spark, f"{tmp_dir}/s")
    made = day_states(rows.where("crc32(interaction_id) % 2 = 0"))
    former = made.selectExpr(
        "hcp_id", "topic_category", "day", "n", "w_sum", "dur_sum", "dur_n", "follow_ups", "max_sentiment",
        "struct(newest.preferred_channel) AS latest", "struct(newest.interaction_date, newest.channel, newest.scientific_topic, "
        "newest.information_need, newest.sentiment, newest.interest_level, newest.follow_up_requested, newest.evidence_type_requested, "
        "newest.competitor_mentioned) AS brief", "struct(newest.interaction_date, newest.interaction_id) AS latest_key")
    folder = store.log.folder_for_data("states")
    former.write.parquet(folder)
    store.log.append(lambda entries: {"extracted": [], "states": [folder], "through": 0, "replaces": True})
    store.update(1, lambda after: rows.where("crc32(interaction_id) % 2 = 1"))
    same(store.rollup(DEFAULT), G.note_rollup(rows, DEFAULT))
    store.compact()
    same(store.rollup(DEFAULT), G.note_rollup(rows, DEFAULT))


def test_two_refreshes_at_once_store_each_batch_once(spark, tmp_dir):
    rows = notes(spark, 60)
    store = NoteStates(spark, f"{tmp_dir}/s")
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda _: store.update(0, lambda after: rows), range(2)))
    assert sum(d is not None for d in done) == 1
    same(store.rollup(DEFAULT), G.note_rollup(rows, DEFAULT))


def test_refresh_makes_each_rollup_once(spark, tmp_dir):
    """Tables that share a rollup read the stored one, not the rows behind it."""
    lh = Lakehouse(spark, "/root/testdata/sf0.001")
    lh.refresh(f"{tmp_dir}/out")
    for name, (needs, build) in lh.builders.items():
        if name in ("interaction_summary", "congress_engagement", "channel_engagement", "hcp_profile"):
            read = {f.split("/")[-2] for f in build().inputFiles()}
            assert read == set(needs), name
            assert not read & {"note_rollup", "silver_congress", "silver_digital", "silver_inquiries", "silver_publications"}


def test_refresh_keeps_the_counts_it_observed(spark, tmp_dir):
    lh = Lakehouse(spark, SF)
    written = lh.refresh(f"{tmp_dir}/out")
    counts = PB.counts(spark, f"{tmp_dir}/out")
    assert set(ROW_COUNT_TABLES) <= set(counts)
    for name, path in written.items():
        if not name.endswith("_masked"):
            assert counts[name] == spark.read.parquet(path).count(), name
    fresh = Lakehouse(spark, SF)
    for name in ("bronze_hcp_master", "bronze_medical_inquiries", "bronze_approved_content"):
        assert counts[name] == fresh.table(name).count(), name


def test_a_doubled_cache_doubles_no_note(spark):
    lh = Lakehouse(spark, SF)
    rows = lh.table("bronze_msl_interactions").limit(50)
    cache = X.new_responses(rows, None)
    doubled = cache.unionByName(cache).unionByName(cache.selectExpr("note_hash", "'{}' AS extracted_raw"))
    assert X.table_from_cache(rows, doubled).count() == 50
    same(X.table_from_cache(rows, cache.unionByName(cache)), X.table_from_cache(rows, cache))


def shuffle_files(spark):
    """Names of the session's shuffle files as they are now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_after(spark, job):
    """Shuffle files that ``job`` made and left."""
    import time

    before = shuffle_files(spark)
    job()
    for _ in range(50):   # removal isn't awaited
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_an_update_leaves_no_shuffle_files(spark, tmp_dir):
    from fieldlens.session import FREE_SHUFFLES

    rows = notes(spark).repartition(4)
    store, setting = NoteStates(spark, f"{tmp_dir}/s"), spark.conf.get(FREE_SHUFFLES)
    assert left_after(spark, lambda: rows.write.parquet(f"{tmp_dir}/plain"))   # as every write does by itself
    for wave in (0, 1):
        assert not left_after(spark, lambda: store.update(wave, lambda after: rows.where(f"crc32(interaction_id) % 2 = {wave}")))
    assert not left_after(spark, store.compact)
    assert spark.conf.get(FREE_SHUFFLES) == setting
    same(store.rollup(DEFAULT), G.note_rollup(rows, DEFAULT))


def test_states_of_an_hcp_and_topic_lie_together(spark, tmp_dir):
    """So a rollup reduces them before it shuffles."""
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    store = NoteStates(spark, f"{tmp_dir}/s")
    try:
        spark.conf.set(merge, "false")
        store.update(0, lambda after: notes(spark))
    finally:
        spark.conf.set(merge, before)
    places = (store.states().groupBy("hcp_id", "topic_category")
              .agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"), F.count(F.lit(1)).alias("days")).collect())
    assert {r.files for r in places} == {1} and max(r.days for r in places) > 10
    same(store.rollup(DEFAULT), G.note_rollup(notes(spark), DEFAULT))


def test_hot_keys_are_added_up_before_they_are_shuffled(spark, monkeypatch):
    from fieldlens.functions import common

    rows = notes(spark)
    monkeypatch.setattr(common, "HOT_BUCKET_ROWS", 40)
    monkeypatch.setattr(common, "HOT_BUCKET_SHARE", 0)
    parts = []

    def states(some):
        parts.append({(r.hcp_id, r.topic_category) for r in some.select("hcp_id", "topic_category").distinct().collect()})
        return day_states(some)

    got = common.aggregate_by(rows, ["hcp_id", "topic_category"], states)
    few, hot = parts
    assert few and hot and not few & hot and ("a", "t1") in hot
    same(got, day_states(rows))


def test_a_refresh_leaves_no_shuffle_files_and_shuffles_stored_rows_once(spark, tmp_dir):
    lh, fresh = Lakehouse(spark, SF), Lakehouse(spark, SF)
    assert not left_after(spark, lambda: lh.refresh(f"{tmp_dir}/out"))
    for name in ("note_rollup", "congress_rollup"):
        rollup = lh.builders[name][1]()
        plan = rollup._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(hcp_id") == plan.count("Exchange ") == 1, name
        same(rollup, fresh.table(name))
    stored = [f for f in lh.table("gold_content_shared").inputFiles()]
    assert stored and all(f.endswith(".zstd.parquet") for f in stored)

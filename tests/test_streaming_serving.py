"""Bronze ingest (exactly-once across restarts, rescue column), serving log idempotency."""

import datetime as dt
import json
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from fieldlens.config import DEFAULT
from fieldlens.operators import serving as SV
from fieldlens.plans import publish as PB
from fieldlens.plans.commitlog import CommitConflict, CommitLog
from fieldlens.streaming import bronze as B

HEADER = "inquiry_id,hcp_id,inquiry_date,inquiry_topic,evidence_type_requested,indication,response_status," \
         "response_time_days,sla_met,sla_target_days,product\n"


def _drop(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + body)


def test_each_file_ingested_once_across_restarts(spark, tmp_dir):
    land, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _drop(f"{land}/d1", "a.csv", "Q1,h1,2024-01-02,Dosing guidance,Safety,x,Open,3,False,2,Velomab\n")
    B.ingest(spark, "medical_inquiries", f"{land}/*", table, ckpt)
    B.ingest(spark, "medical_inquiries", f"{land}/*", table, ckpt)  # restart, nothing new
    assert spark.read.parquet(table).count() == 1
    _drop(f"{land}/d2", "b.csv",
          "Q2,h2,2024-01-03,\"Safety / ILD management\",Safety,x,Closed,1,True,2,Corvexa\n"
          "Q3,h3,2024-01-04,Dosing,Safety,x,Open,not-a-number,False,2,Velomab\n")
    B.ingest(spark, "medical_inquiries", f"{land}/*", table, ckpt)
    t = spark.read.parquet(table)
    rows = {r.inquiry_id: r for r in t.collect()}
    assert set(rows) == {"Q1", "Q2", "Q3"}
    assert rows["Q2"].sla_met is True and rows["Q2"].inquiry_date == dt.date(2024, 1, 3)
    assert rows["Q3"].response_time_days is None and rows["Q3"]._rescued is not None  # malformed INT
    assert rows["Q1"]._rescued is None and rows["Q1"]._source_file.endswith("a.csv")
    assert t.filter(F.col("_ingested_at").isNull()).count() == 0


def test_multiline_quoted_notes_round_trip(spark, tmp_dir):
    notes = spark.createDataFrame(
        [("i1", "h1", "m", dt.date(2024, 1, 2), "Phone", 30, 'line one\nHCP said "send it", thanks ')],
        "interaction_id string, hcp_id string, msl_name string, interaction_date date, channel string, "
        "duration_minutes int, raw_notes string")
    B.drop_files(notes, f"{tmp_dir}/landing/d1", files=1)
    B.ingest(spark, "msl_interactions", f"{tmp_dir}/landing/*", f"{tmp_dir}/t", f"{tmp_dir}/c")
    got = B.bronze_view(spark, "msl_interactions", f"{tmp_dir}/t").collect()
    assert len(got) == 1 and got[0].raw_notes == 'line one\nHCP said "send it", thanks ' and got[0].ingest_ok


def _write(folder, name, text, **how):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="", **how) as f:
        f.write(text)


def test_headers_are_mapped_by_name_in_one_batch(spark, tmp_dir):
    land = f"{tmp_dir}/landing/d1"
    _write(land, "own.csv", HEADER + "Q1,h1,2024-01-02,t,e,ind,Open,3,False,2,p\n")
    _write(land, "turned.csv", "product,response_status,INDICATION , inquiry_id,hcp_id\np,Open,ind,Q2,h2\n")
    _write(land, "more.csv", HEADER.strip() + ',region,,region\nQ3,h3,2024-01-03,t,e,ind,Closed,1,True,2,p,"No ""1""",x,\n')
    _write(land, "bom.csv", "inquiry_id,hcp_id,hcp_id\r\nQ4,h4,again\r\n", encoding="utf-8-sig")
    _write(land, "quoted.csv", '"inquiry_id","hcp_id","response_time_days"\nQ5,h5,many\n')
    _write(land, "short.csv", "inquiry_id,hcp_id\nQ6\nQ7,h7,too,much\n")
    _write(land, "none.csv", "")
    _write(land, "header.csv", "hcp_id,inquiry_id\n")
    _write(land, "unknown.csv", "a,b\n1,2\n")
    B.ingest(spark, "medical_inquiries", f"{tmp_dir}/landing/*", f"{tmp_dir}/t", f"{tmp_dir}/c")
    rows = {(r.inquiry_id, r.hcp_id): r for r in B.read_bronze(spark, "medical_inquiries", f"{tmp_dir}/t").collect()}
    by_id = {k[0]: r for k, r in rows.items()}
    assert set(by_id) == {"Q1", "Q2", "Q3", "Q4", "Q5", "Q6", "Q7", None}
    assert {r._batch for r in rows.values()} == {0}
    q = by_id["Q2"]
    assert (q.hcp_id, q.indication, q.response_status, q.product, q.inquiry_date, q._rescued) == ("h2", "ind", "Open", "p", None, None)
    assert json.loads(by_id["Q3"]._rescued) == {"region": 'No "1"', "column_13": "x"} and by_id["Q3"].sla_met is True
    assert json.loads(by_id["Q4"]._rescued) == {"hcp_id_3": "again"} and by_id["Q4"].hcp_id == "h4"
    assert by_id["Q5"].response_time_days is None and "many" in json.loads(by_id["Q5"]._rescued)["_record"]
    assert by_id["Q6"].hcp_id is None and by_id["Q7"]._rescued is not None
    assert json.loads(by_id[None]._rescued) == {"a": "1", "b": "2"}
    assert by_id["Q4"]._source_file.endswith("bom.csv") and by_id["Q1"]._rescued is None


def test_batches_are_bounded_and_a_repeated_batch_replaces_itself(spark, tmp_dir):
    for i in range(5):
        _write(f"{tmp_dir}/landing/d", f"{i}.csv", "inquiry_id,hcp_id\n" + f"Q{i},h\n")
    where = (f"{tmp_dir}/landing/*", f"{tmp_dir}/t", f"{tmp_dir}/c")
    B.ingest(spark, "medical_inquiries", *where, max_files=2)
    t = B.read_bronze(spark, "medical_inquiries", where[1])
    assert sorted((r._batch, r["count"]) for r in t.groupBy("_batch").count().collect()) == [(0, 2), (1, 2), (2, 1)]
    os.remove(f"{where[2]}/commits/2")   # as after a driver that was lost between storing and committing the batch
    for f in os.listdir(f"{where[2]}/commits"):
        if f.startswith(".2."):
            os.remove(f"{where[2]}/commits/{f}")
    B.ingest(spark, "medical_inquiries", *where, max_files=2)
    t = B.read_bronze(spark, "medical_inquiries", where[1])
    assert sorted(r.inquiry_id for r in t.collect()) == [f"Q{i}" for i in range(5)]


def test_headers_of_a_feed_with_line_breaks(spark, tmp_dir):
    _write(f"{tmp_dir}/landing/d", "a.csv", 'raw_notes,hcp_id,interaction_id\n"one\ntwo ""x"", three",h1,i1\n')
    B.ingest(spark, "msl_interactions", f"{tmp_dir}/landing/*", f"{tmp_dir}/t", f"{tmp_dir}/c")
    (r,) = B.read_bronze(spark, "msl_interactions", f"{tmp_dir}/t").collect()
    assert (r.raw_notes, r.hcp_id, r.interaction_id, r._rescued) == ('one\ntwo "x", three', "h1", "i1", None)


def _write_gz(folder, name, text):
    import gzip

    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt", newline="") as f:
        f.write(text)


def test_compressed_files_are_ingested_like_plain_ones(spark, tmp_dir):
    land = f"{tmp_dir}/landing/d"
    text = 'raw_notes,hcp_id,interaction_id\n"one\ntwo ""x"", three",h1,%s\n'
    _write(land, "plain.csv", text % "i1")
    _write_gz(land, "packed.csv.gz", text % "i2")
    _write_gz(land, "turned.csv.gz", "INTERACTION_ID,duration_minutes,region\r\ni3,30,north\r\ni4,long,\r\n")
    _write_gz(land, "header.csv.gz", "hcp_id,interaction_id\n")
    _write_gz(land, "none.csv.gz", "")
    _write(land, "nothing.csv.gz", "")   # no byte: not even a compressed file
    _write_gz(land, "other.txt.gz", text % "i5")
    B.ingest(spark, "msl_interactions", f"{tmp_dir}/landing/*", f"{tmp_dir}/t", f"{tmp_dir}/c")
    rows = {r.interaction_id: r for r in B.bronze_view(spark, "msl_interactions", f"{tmp_dir}/t").collect()}
    assert set(rows) == {"i1", "i2", "i3", "i4"} and all(r.ingest_ok and r.source_drop == "d" for r in rows.values())
    assert [rows[i].raw_notes for i in ("i1", "i2")] == ['one\ntwo "x", three'] * 2 and rows["i2"].hcp_id == "h1"
    assert rows["i3"].duration_minutes == 30 and json.loads(rows["i3"].rescued) == {"region": "north"}
    assert rows["i4"].duration_minutes is None and rows["i4"].rescued is not None


def test_note_drops_are_compressed_and_leave_no_shuffles(spark, tmp_dir, monkeypatch):
    from test_states import left_after

    from fieldlens import session
    from fieldlens.plans.registry import REGISTRY

    monkeypatch.setattr(session, "checkpoint_root", lambda _: tmp_dir)
    left = left_after(spark, lambda: REGISTRY["bronze_msl_interactions"](spark, "/root/testdata/sf0.001"))
    (root,) = [f for f in os.listdir(tmp_dir) if f.startswith("bronze-")]
    files = {where: [f for at, _, names in os.walk(f"{tmp_dir}/{root}/{where}") for f in names if f.startswith("part-")]
             for where in ("landing", "table")}
    assert files["landing"] and all(f.endswith(".csv.gz") for f in files["landing"])
    assert files["table"] and all(f.endswith(".zstd.parquet") for f in files["table"])
    assert len({f.split("_")[1] for f in left}) <= 2   # of the lists of the files that came, one a batch


DECISION = ("request_id string, hcp_id string, msl_name string, review_decision string, review_notes string, "
            "scheduled_channel string, scheduled_date date")


def test_review_log_keeps_every_request_once(spark, tmp_dir):
    queue = spark.createDataFrame(
        [("h1", 70.0), ("h2", 90.0), ("h3", 80.0)], "hcp_id string, msl_priority_score double")
    log = f"{tmp_dir}/log"
    SV.seed_reviews(spark, queue, log, DEFAULT)
    SV.seed_reviews(spark, queue, log, DEFAULT)
    seeded = SV.read_log(spark, log)
    assert sorted(r.hcp_id for r in seeded.collect()) == ["h2", "h3"]
    day = dt.date(2024, 2, 1)
    same = [("r1", "h1", "MSL", "Approved", None, "Phone", day), ("r2", "h1", "MSL", "Approved", None, "Phone", day),
            ("r3", "h1", "MSL", "Approved", "", "Phone", day)]  # equal content, three requests
    new = spark.createDataFrame(same, DECISION)
    SV.append_reviews(spark, new, log)
    SV.append_reviews(spark, new, log)  # a retry
    assert SV.read_log(spark, log).count() == 5
    assert SV.recent_reviews(SV.read_log(spark, log), 2).filter("hcp_id = 'h1'").count() == 2


def test_failed_check_leaves_the_former_snapshot(spark, tmp_dir):
    schema = "hcp_id string, msl_priority_score double"
    root = f"{tmp_dir}/q"
    SV.publish_snapshot(spark.createDataFrame([("h1", 1.0)], schema), root)
    try:
        SV.publish_snapshot(spark.createDataFrame([("h1", 1.0), ("h1", 2.0)], schema), root)
    except ValueError:
        assert SV.served_snapshot(spark, root).count() == 1
        SV.publish_snapshot(spark.createDataFrame([("h1", 1.0), ("h2", 2.0)], schema), root)
        assert SV.served_snapshot(spark, root).count() == 2
        return
    raise AssertionError("duplicate key not detected")


def test_appenders_at_once_write_each_request_once_with_dense_ids(spark, tmp_dir):
    log, day = f"{tmp_dir}/log", dt.date(2024, 2, 1)
    batches = [[(f"r{i}", f"h{i % 3}", "MSL", "Approved", f"note {i}", "Phone", day) for i in range(8 * k, 8 * k + 16)] for k in range(4)]
    frames = [spark.createDataFrame(b + b[:3], DECISION) for b in batches]   # neighbours share half of their requests
    with ThreadPoolExecutor(4) as pool:
        commits = [c for c in pool.map(lambda f: SV.append_reviews(spark, f, log), frames) if c]
    rows = SV.read_log(spark, log).collect()
    assert len(rows) == len({r.action_id for r in rows}) == 40
    assert sorted(r.review_id for r in rows) == list(range(1, 41))
    assert sorted(c["version"] for c in commits) == list(range(1, len(commits) + 1))
    by_commit = {r.review_id: r.action_id for r in rows}
    SV.compact_log(spark, log)
    assert {r.review_id: r.action_id for r in SV.read_log(spark, log).collect()} == by_commit
    assert len(CommitLog(spark, log).entries()) == 1
    more = SV.append_reviews(spark, spark.createDataFrame([("new", "h1", "MSL", "Approved", None, "Phone", day)], DECISION), log)
    assert more["next_id"] == 42 and SV.read_log(spark, log).count() == 41


def test_one_of_many_seeders_seeds(spark, tmp_dir):
    queue = spark.createDataFrame([("h1", 70.0), ("h2", 90.0)], "hcp_id string, msl_priority_score double")
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda _: SV.seed_reviews(spark, queue, f"{tmp_dir}/log", DEFAULT), range(3)))
    assert sum(d is not None for d in done) == 1 and SV.read_log(spark, f"{tmp_dir}/log").count() == 2


def test_a_version_is_committed_once(spark, tmp_dir):
    log = CommitLog(spark, f"{tmp_dir}/x")

    def race(i):
        try:
            log.create(1, {"run": str(i)})
            return i
        except CommitConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(race, range(8)) if i is not None]
    assert len(won) == 1 and log.entry()["run"] == str(won[0]) and log.last() == 1
    PB.publish(spark, f"{tmp_dir}/x", "second", after=1)
    try:
        PB.publish(spark, f"{tmp_dir}/x", "late", after=1)   # started before the second was there
    except CommitConflict:
        assert PB.current(spark, f"{tmp_dir}/x") == (2, "second")
        return
    raise AssertionError("a stale publisher replaced a newer version")


def test_change_feed_brings_the_old_version_up_to_date(spark):
    schema = "hcp_id string, score double, topic string"
    old = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, None), ("c", 3.0, "z"), ("d", None, "")], schema)
    new = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, ""), ("d", None, None), ("e", 5.0, None)], schema)
    feed = SV.changes(old, new)
    assert sorted((r.hcp_id, r.change) for r in feed.collect()) == [("b", "update"), ("c", "delete"), ("d", "update"), ("e", "insert")]
    assert sorted(map(tuple, SV.apply_changes(old, feed).collect()), key=repr) == sorted(map(tuple, new.collect()), key=repr)
    assert SV.changes(new, new).count() == 0


def test_point_reads_open_only_files_that_can_hold_the_key(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(20_000).selectExpr("concat('h', lpad(cast(id * 7 % 20000 as string), 6, '0')) AS hcp_id", "cast(id AS double) AS msl_priority_score")
    SV.publish_snapshot(rows, f"{tmp_dir}/q", rows_per_file=1000)
    total = len(SV.served_snapshot(spark, f"{tmp_dir}/q").inputFiles())
    assert total >= 15
    found = SV.lookup(spark, f"{tmp_dir}/q", ["h000007", "h000008", "h019999", "h0000075", "none"])
    assert sorted(r.hcp_id for r in found.collect()) == ["h000007", "h000008", "h019999"]
    assert len(found.inputFiles()) == 2 and "PushedFilters: [In(hcp_id" in found._jdf.queryExecution().toString()
    assert SV.lookup(spark, f"{tmp_dir}/q", ["a", "z"]).count() == 0
    run = PB.current(spark, f"{tmp_dir}/q")[1]
    for f in glob.glob(f"{run}/*.parquet"):
        keys = pq.read_table(f, columns=["hcp_id"]).column(0).to_pylist()
        assert keys == sorted(keys)


def test_snapshot_follows_the_input_files(spark, tmp_dir):
    import shutil

    from fieldlens.sources.tables import fingerprint

    folder = f"{tmp_dir}/sf"
    os.makedirs(folder)
    for name in os.listdir("/root/testdata/sf0.001"):
        shutil.copyfile(f"/root/testdata/sf0.001/{name}", f"{folder}/{name}")
    before = fingerprint(spark, folder)
    assert before == fingerprint(spark, folder)
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(10).write.parquet(f"{folder}/more")
    os.unlink(f"{folder}/orders.parquet")
    os.rename(f"{folder}/more", f"{folder}/orders.parquet")
    assert before != fingerprint(spark, folder)


def test_keyed_hash_is_hmac(spark):
    import hashlib
    import hmac

    from fieldlens.operators.governance import keyed_hash

    df = spark.createDataFrame([("1000000001",), (None,), ("é",)], "v string")
    got = {r.v: r.h for r in df.select("v", keyed_hash(F.col("v"), "secret").alias("h")).collect()}
    assert got == {v: v and hmac.new(b"secret", v.encode(), hashlib.sha256).hexdigest() for v in got}

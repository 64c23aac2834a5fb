"""Model calls: bounded, repeated, failing; the versioned response store."""

import datetime as dt
import threading
import time

from pyspark.sql import functions as F

from fieldlens.operators import model as M

NOTES = "interaction_id string, hcp_id string, msl_name string, interaction_date date, channel string, duration_minutes int, raw_notes string"


def prompts(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "prompt string")


def test_calls_in_flight_are_bounded():
    lock, now, most = threading.Lock(), [0], [0]

    def slow(p):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return p

    calls = M.ModelCalls(slow, "v", M.CallPolicy(in_flight=3))
    import pandas as pd

    class Frame:
        def select(self, *_):
            return self

        def mapInPandas(self, run, _):
            return pd.concat(run(iter([pd.DataFrame({"prompt_hash": range(40), "prompt": [str(i) for i in range(40)]})])))

    out = calls.ask(Frame())
    assert out["response"].tolist() == [str(i) for i in range(40)] and 1 < most[0] <= 3


def test_failed_calls_become_errors_and_are_sent_again(spark, tmp_dir):
    def call(p):
        if p.startswith("bad"):
            raise TimeoutError("no answer")
        return p.upper()

    store, quick = M.ResponseStore(spark, f"{tmp_dir}/s"), M.CallPolicy(attempts=2, first_wait=0.01)
    asked = prompts(spark, ["a", "b", "a", "bad 1", None])
    first = store.update(asked, M.ModelCalls(call, "m/1", quick))
    assert (first["asked"], first["failed"]) == (3, 1)
    got = {r.prompt: (r.response, r.error) for r in store.answered(asked, "m/1").collect()}
    assert got == {"a": ("A", None), "b": ("B", None), "bad 1": (None, "TimeoutError: no answer"), None: (None, None)}
    assert {r.attempts for r in store.all_responses("m/1").collect()} == {1, 2}
    second = store.update(asked, M.ModelCalls(str.upper, "m/1", quick))   # the service is back: only the failed one is sent
    assert (second["asked"], second["failed"]) == (1, 0)
    assert store.answered(asked, "m/1").where("prompt = 'bad 1'").first().response == "BAD 1"
    assert store.update(asked, M.ModelCalls(str.upper, "m/1", quick)) is None
    assert store.answers("m/2").count() == 0
    assert store.update(asked, M.ModelCalls(str.lower, "m/2", quick))["asked"] == 3   # another version starts anew


def test_a_note_without_a_response_gets_the_defaults(spark, tmp_dir):
    def call(p):
        if "broken" in p:
            raise ValueError("broken")
        return M.template_model(p)

    day = dt.date(2024, 1, 2)
    notes = spark.createDataFrame([("i1", "h", "m", day, "Phone", 5, "Subject: dosing. Mood: negative. Call back agreed."),
                                   ("i2", "h", "m", day, "Phone", 5, "Subject: broken."), (None, "h", "m", day, "Phone", 5, None),
                                   (None, "h", "m", day, "Email", 5, "Subject: dosing. Mood: negative. Call back agreed.")], NOTES)
    calls = M.ModelCalls(call, "v", M.CallPolicy(attempts=1))
    rows = M.extract_with_model(notes, M.ResponseStore(spark, f"{tmp_dir}/s"), calls).collect()
    assert len(rows) == 4
    one, two = (next(r for r in rows if r.interaction_id == i) for i in ("i1", "i2"))
    assert (one.scientific_topic, one.sentiment, one.follow_up_requested, one.error) == ("dosing", "Negative", True, None)
    assert two.scientific_topic == "General scientific exchange" and two.error == "ValueError: broken"
    assert sum(r.interaction_id is None for r in rows) == 2


def test_an_empty_set_of_prompts(spark, tmp_dir):
    store = M.ResponseStore(spark, f"{tmp_dir}/s")
    none = prompts(spark, ["x"]).where(F.lit(False))
    assert store.update(none, M.ModelCalls(str.upper, "v")) is None and store.answered(none, "v").count() == 0

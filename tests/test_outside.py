"""A store outside Spark: pushes that go on where they broke off, fetches in bulk, and updates made of both."""

import json
import os

import pytest
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.plans.jobs import update_outside
from docloom.schemas import ACTIONS
from docloom.sinks.push import push_resumable
from docloom.sources.outside import call_counters, fetch_documents, with_existing


class Recorder:
    """Writes every call to a file; goes wrong once at a given key, by an error or by the end of its process."""

    def __init__(self, folder, wrong_at=None, dies=False):
        self.folder, self.wrong_at, self.dies = folder, wrong_at, dies

    def note(self, *what):
        with open(f"{self.folder}/calls-{os.getpid()}", "a") as f:
            f.write(json.dumps(what) + "\n")

    def store(self, op, key, value, expiry):
        if key == self.wrong_at and not os.path.exists(f"{self.folder}/went-wrong"):
            open(f"{self.folder}/went-wrong", "w").close()
            if self.dies:
                self.note(key, value)
                os._exit(1)  # the store has taken it, but nobody will know
            raise RuntimeError("gone wrong")
        self.note(key, value)
        return "Success"

    def get_many(self, keys):
        self.note("get", len(keys))
        if keys and keys[0] == self.wrong_at and not os.path.exists(f"{self.folder}/went-wrong"):
            open(f"{self.folder}/went-wrong", "w").close()
            raise TimeoutError
        return {k: f"old {k}" for k in keys if not k.endswith("3")}

    def close(self):
        pass


def calls(folder):
    return [tuple(json.loads(line)) for name in os.listdir(folder) if name.startswith("calls") for line in open(f"{folder}/{name}")]


def appends(spark, n, keys):
    rows = [(f"k{i % keys}", i, "APPEND", f"v{i}", 0) for i in range(n)]
    # One partition: Spark kills the other tasks of a failed job, and those get no chance to write their log.
    return spark.createDataFrame(rows, ACTIONS).coalesce(1)


def folders(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path / "calls"), str(tmp_path / "push")


@pytest.mark.parametrize("ordered", [False, True])
def test_a_push_that_fails_goes_on_and_sends_nothing_twice(spark, tmp_path, ordered):
    noted, root = folders(tmp_path)
    feed = appends(spark, 300, 20)

    def client():
        return Recorder(noted, "k7")

    with pytest.raises(Exception, match="gone wrong"):
        push_resumable(feed, client, root, ordered=ordered)
    before = len(calls(noted))
    assert 0 < before < 300
    # What the second call is given does not matter: the first one stored its actions.
    log = push_resumable(feed.limit(0), client, root, ordered=ordered).collect()
    assert sorted(calls(noted)) == sorted((f"k{i % 20}", f"v{i}") for i in range(300))
    assert sorted((r.doc_id, r.seq, r.op, r.try_no, r.status) for r in log) == sorted(
        (f"k{i % 20}", i, "APPEND", 0, "Success") for i in range(300)
    )
    assert push_resumable(feed, client, root).count() == 300 and len(calls(noted)) == 300


def test_a_worker_that_dies_repeats_the_action_in_flight_only(spark, tmp_path):
    noted, root = folders(tmp_path)
    feed = appends(spark, 120, 6)

    def client():
        return Recorder(noted, "k4", dies=True)

    with pytest.raises(Exception):
        push_resumable(feed, client, root, ordered=True, log_every=1)
    log = push_resumable(feed, client, root, ordered=True, log_every=1)
    assert log.count() == 120
    sent = calls(noted)
    assert len(sent) == 121 and len(set(sent)) == 120
    assert [c for c in set(sent) if sent.count(c) == 2] == [("k4", "v4")]


def test_log_files_hold_so_many_actions(spark, tmp_path):
    noted, root = folders(tmp_path)
    log = push_resumable(appends(spark, 50, 1), lambda: Recorder(noted), root, ordered=True, log_every=20)
    assert log.count() == 50 and len(log.inputFiles()) == 3
    assert push_resumable(appends(spark, 0, 1), lambda: Recorder(noted), str(tmp_path / "none")).count() == 0


def test_fetches_in_bulk(spark, tmp_path):
    noted, _ = folders(tmp_path)
    rows = spark.createDataFrame([(f"k{i % 100}", i) for i in range(400)] + [(None, 1), ("", 2)], "doc_id string, n long")
    fetched = fetch_documents(rows, lambda: Recorder(noted), str(tmp_path / "fetched"), batch_size=7)
    got = {r.doc_id: r.existing for r in fetched.collect()}
    assert got == {f"k{i}": None if i % 10 == 3 else f"old k{i}" for i in range(100)}
    # Every task makes as many calls as its keys need, and each key is asked for once.
    lanes = fetched.groupBy("lane").agg(F.count("*").alias("n"), (F.max("call_no") + 1).alias("calls")).collect()
    assert all(r.calls == -(-r.n // 7) for r in lanes) and sum(r.n for r in lanes) == 100
    counters = {r.counter: r.value for r in call_counters(fetched).collect()}
    made = [n for what, n in calls(noted)]
    assert counters == {"BULKS_COUNT": len(made), "BULK_SIZES_SUM": 100} and sum(made) == 100 and max(made) == 7
    joined = with_existing(rows, fetched)
    assert joined.count() == 402 and joined.where("existing IS NULL").count() == 42


def test_a_call_that_times_out_is_repeated(spark, tmp_path):
    noted, _ = folders(tmp_path)
    rows = spark.createDataFrame([("a",)], "doc_id string")
    waits = []
    fetched = fetch_documents(rows, lambda: Recorder(noted, "a"), str(tmp_path / "fetched"), sleep=waits.append).collect()
    assert [(r.existing, r.tries) for r in fetched] == [("old a", 2)]
    assert fetch_documents(rows.limit(0), lambda: Recorder(noted), str(tmp_path / "none")).count() == 0


def test_update_outside_resumes(spark, tmp_path):
    noted, root = folders(tmp_path)
    source = spark.createDataFrame([(f"k{i}", i) for i in range(60)] + [(None, 60)], "user string, n long")

    def merge(payload, existing):
        text = F.concat(F.lit("n"), payload["n"])
        return F.when(existing.isNull(), A.add(text)).otherwise(A.replace(F.concat(existing, F.lit("+"), text)))

    def run():
        return update_outside(
            source, lambda: Recorder(noted), lambda: Recorder(noted, "k30"), merge, root, seq="n", batch_size=10, ordered=True, log_every=1,
            transform=lambda df: df.withColumnRenamed("user", "doc_id"),
        )

    with pytest.raises(Exception, match="gone wrong"):
        run()
    report = run()
    sent = [c for c in calls(noted) if c[0] != "get"]
    assert sorted(sent) == sorted((f"k{i}", f"n{i}" if i % 10 == 3 else f"old k{i}+n{i}") for i in range(60))
    assert sum(n for what, n in calls(noted) if what == "get") == 60
    counters = {r.counter: r.value for r in report.counters.collect()}
    assert counters["BULK_SIZES_SUM"] == 60 and counters["FAILED_STORE_OPERATIONS"] == 0
    assert report.attempts.count() == 60

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, AS_OF_TIME
from docloom.operators import skew
from docloom.operators.apply import apply_actions, apply_to, live_documents
from docloom.operators.uniform import apply_operation
from docloom.schemas import ACTIONS, STORE
from replay import replay

OPS = ["SET", "ADD", "REPLACE", "APPEND", "PREPEND", "DELETE", "TOUCH", "EXISTS", "NONE", "BOGUS"]


def random_case(seed, n_actions=400, n_keys=25, hot_share=0.4):
    rng = random.Random(seed)
    store = {}
    for k in range(0, n_keys, 2):
        expires = rng.choice([None, AS_OF_TIME + dt.timedelta(hours=1), AS_OF_TIME - dt.timedelta(hours=1)])
        store[f"k{k}"] = (rng.choice(["base", "", "x"]), expires)
    actions = []
    for seq in rng.sample(range(10 * n_actions), n_actions):
        key = "k4" if rng.random() < hot_share else rng.choice([f"k{rng.randrange(n_keys)}", "", None])
        op = rng.choice(OPS)
        value = None if op in ("DELETE", "TOUCH", "EXISTS", "NONE") else f"v{seq};"
        actions.append((key, seq, op, value, rng.choice([0, 0, 60])))
    return store, actions


def frames(spark, store, actions):
    return (
        spark.createDataFrame([(k, v, e) for k, (v, e) in store.items()], STORE),
        spark.createDataFrame(actions, ACTIONS).repartition(3),
    )


def stored(df):
    rows = df.select("doc_id", "value", F.unix_seconds("expires_at").alias("e")).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return {r["doc_id"]: (r["value"], r["e"]) for r in rows}


def expected_store(store):
    return {k: (v, int(e.timestamp()) if e else None) for k, (v, e) in store.items()}


def by_seq(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(
    "options",
    [{}, {"broadcast_bytes": 0}, {"max_group_rows": 20}, {"max_group_rows": 20, "broadcast_bytes": 0}],
    ids=["broadcast", "shuffle", "segments-broadcast", "segments-shuffle"],
)
def test_mixed_actions_equal_replay(spark, seed, options):
    store, actions = random_case(seed)
    s, a = frames(spark, store, actions)
    result = apply_actions(s, a, AS_OF, **options)
    new_store, outcomes = replay(store, actions, AS_OF_TIME)
    assert by_seq(result.outcomes.collect()) == by_seq(outcomes)
    assert stored(result.store) == expected_store(new_store)


@pytest.mark.parametrize("op", OPS[:-1])
@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 0], ids=["broadcast", "shuffle"])
def test_one_operation_equals_replay(spark, op, broadcast_bytes):
    store, actions = random_case(7, n_actions=150)
    actions = [(k, seq, op, f"v{seq};", 60) for k, seq, _, _, _ in actions]
    s, a = frames(spark, store, actions)
    result = apply_operation(s, a, op, AS_OF, expiry=60, broadcast_bytes=broadcast_bytes)
    new_store, outcomes = replay(store, actions, AS_OF_TIME)
    assert by_seq(result.outcomes.collect()) == by_seq(outcomes)
    assert stored(result.store) == expected_store(new_store)


def test_action_triple(spark):
    s = spark.createDataFrame([("key::3", "old", None)], STORE)
    a = spark.createDataFrame(
        [("key::1", 1, "SET", "value_1", 0), ("key::2", 2, "ADD", "value_2", 0), ("key::3", 3, "DELETE", None, 0)],
        ACTIONS,
    )
    assert stored(a.transform(apply_to(s, AS_OF))) == {"key::1": ("value_1", None), "key::2": ("value_2", None)}


@pytest.mark.parametrize("max_group_rows", [2_000_000, 5])
def test_equal_seq_in_one_key_is_an_error(spark, max_group_rows):
    s = spark.createDataFrame([], STORE)
    a = spark.createDataFrame([("k", i // 2, "SET", "v", 0) for i in range(40)], ACTIONS)
    with pytest.raises(Exception, match="same seq"):
        apply_actions(s, a, AS_OF, max_group_rows=max_group_rows).outcomes.collect()


def test_negative_expiry_is_an_error(spark):
    s = spark.createDataFrame([], STORE)
    a = spark.createDataFrame([("k", 1, "SET", "v", -1)], ACTIONS)
    with pytest.raises(Exception, match="negative expiry"):
        apply_actions(s, a, AS_OF).store.collect()


def test_live_documents(spark):
    moment = AS_OF_TIME
    s = spark.createDataFrame(
        [("a", "1", None), ("b", "2", moment), ("c", "3", moment + dt.timedelta(seconds=1))], STORE
    )
    assert {r["doc_id"] for r in live_documents(s, AS_OF).collect()} == {"a", "c"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_above_scan_of(plan, column):
    """Exchanges on the path from the scan that reads ``column`` up to the root of a plan text."""
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and column in line.split("Batched")[0])
    found, depth = [], lines[scan].index("FileScan")
    for line in reversed(lines[:scan]):
        start = len(line) - len(line.lstrip(" :+-"))
        if start < depth:
            depth = start
            found += [line.strip()] if "Exchange" in line else []
    return found


def test_small_feed_does_not_shuffle_the_documents(spark, tmp_path):
    path = str(tmp_path / "store")
    spark.createDataFrame([(f"k{i}", "v" * 50, None) for i in range(100)], STORE).write.parquet(path)
    s = spark.read.schema(STORE).parquet(path)
    a = spark.createDataFrame([("k1", 1, "SET", "n", 0)], ACTIONS)
    for result in (apply_actions(s, a, AS_OF), apply_operation(s, a, "SET", AS_OF)):
        assert exchanges_above_scan_of(plan_of(result.store), "value#") == []
    big = plan_of(apply_operation(s, a, "SET", AS_OF, broadcast_bytes=0).store)
    assert len(exchanges_above_scan_of(big, "value#")) == 1


def test_bucketed_store_is_not_shuffled(spark):
    from docloom.sources.tables import save_bucketed_store

    s = spark.createDataFrame([(f"k{i}", "v", None) for i in range(100)], STORE)
    save_bucketed_store(s, "bucketed_store", 4, mode="overwrite")
    a = spark.createDataFrame([(f"k{i}", i, "SET", "n", 0) for i in range(50, 150)], ACTIONS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        result = apply_operation(spark.table("bucketed_store"), a, "SET", AS_OF, broadcast_bytes=0)
        plan = plan_of(result.store)
        assert len(stored(result.store)) == 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize("op", ["SET", "ADD", "APPEND", "DELETE", None])
def test_ties_and_missing_seq_are_errors(spark, op):
    store = spark.createDataFrame([("a", "x", None)], STORE)
    for seqs in ((3, 3), (None, 4)):
        rows = [("a", s, op or "SET", "v", 0) for s in seqs]
        actions = spark.createDataFrame(rows, ACTIONS)
        for read in ("store", "outcomes"):
            with pytest.raises(Exception, match="seq"):
                done = apply_operation(store, actions, op, AS_OF) if op else apply_actions(store, actions, AS_OF)
                getattr(done, read).collect()


@pytest.mark.parametrize("limit", [0, 1, 1 << 20], ids=["shuffle", "split", "broadcast"])
def test_changes_lead_from_the_old_store_to_the_new(spark, limit):
    for seed in (1, 2):
        old, actions = frames(spark, *random_case(seed))
        results = [apply_actions(old, actions, AS_OF, broadcast_bytes=limit)]
        per_key = actions.where("op = 'SET' AND doc_id != ''").dropDuplicates(["doc_id"])
        results += [apply_operation(old, per_key, op, AS_OF, broadcast_bytes=limit) for op in ("SET", "ADD", "APPEND", "DELETE", "TOUCH")]
        for result in results:
            after = stored(old)
            for r in result.changes.select("doc_id", "value", F.unix_seconds("expires_at").alias("e"), "deleted").collect():
                after.pop(r["doc_id"], None)
                if not r["deleted"]:
                    after[r["doc_id"]] = (r["value"], r["e"])
            assert after == stored(result.store)


def test_documents_that_no_action_names_are_not_shuffled(spark):
    store = spark.range(500).selectExpr("concat('k', id) AS doc_id", "'v' AS value", "cast(null AS timestamp) AS expires_at")
    actions = spark.createDataFrame([(f"k{i}", i, "SET", "w", 0) for i in range(20)], ACTIONS)
    plan = apply_actions(store, actions, AS_OF, broadcast_bytes=1).store._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_a_large_feed_is_spread_by_rows(spark, monkeypatch):
    """Whatever the bytes of a shuffle, no task meets more than about PARTITION_ROWS rows of feed and store."""
    monkeypatch.setattr(skew, "PARTITION_ROWS", 20)
    store = spark.range(300).selectExpr("concat('k', id) AS doc_id", "'x' AS value", "cast(null AS timestamp) AS expires_at")
    feed = spark.range(900).selectExpr(
        "concat('k', id % 450) AS doc_id", "id AS seq", "if(id < 450, 'APPEND', 'ADD') AS op", "concat(id, ';') AS value", "0 AS expiry"
    )
    result = apply_actions(store, feed, AS_OF, broadcast_bytes=0)
    met = result.outcomes.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert met <= 60
    want = {f"k{i}": f"x{i};" if i < 300 else f"{i + 450};" for i in range(450)}
    assert {r["doc_id"]: r["value"] for r in result.store.collect()} == want

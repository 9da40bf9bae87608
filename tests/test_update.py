import random

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, AS_OF_TIME
from docloom.functions import actions as A
from docloom.operators.apply import apply_actions
from docloom.operators.existence import existence_counts, existing_keys, key_existence, missing_keys
from docloom.operators.merging import update_in_order
from docloom.operators.metrics import update_counters
from docloom.operators.update import lookup_documents, merge_actions, update_documents
from docloom.schemas import STORE
from replay import apply_one

STORED = {"a": ("base", None), "b": ("", None), "dead": ("old", AS_OF_TIME)}


def store_of(spark, docs=STORED):
    return spark.createDataFrame([(k, v, e) for k, (v, e) in docs.items()], STORE)


def contents(df):
    rows = df.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return {r["doc_id"]: r["value"] for r in rows}


def upsert(payload, existing):
    return F.when(existing.isNull(), A.add(payload["text"])).otherwise(
        A.replace(F.concat(existing, F.lit("+"), payload["text"]))
    )


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 0])
def test_hit_and_miss(spark, broadcast_bytes):
    source = spark.createDataFrame([("a", "1"), ("new", "2"), ("dead", "3"), (None, "4"), ("", "5")], "doc_id string, text string")
    result = update_documents(store_of(spark), source, upsert, AS_OF, broadcast_bytes=broadcast_bytes)
    assert contents(result.store) == {"a": "base+1", "b": "", "dead": "3", "new": "2"}
    assert result.summary.agg(F.sum("stored")).first()[0] == 3


def test_a_key_found_twice_needs_a_rule(spark):
    source = spark.createDataFrame([("a", "1"), ("a", "2")], "doc_id string, text string")
    with pytest.raises(Exception, match="several source rows for key a"):
        update_documents(store_of(spark), source, upsert, AS_OF).store.collect()
    reduced = update_documents(store_of(spark), source, upsert, AS_OF, reduce=[F.max("text").alias("text")])
    assert contents(reduced.store)["a"] == "base+2"


def test_transform_skips_rows_without_key(spark):
    source = spark.createDataFrame([("a", 1), ("b", -1)], "k string, n int")
    result = update_documents(
        store_of(spark),
        source,
        upsert,
        AS_OF,
        transform=lambda df: df.select(F.expr("if(n > 0, k, null) AS doc_id"), F.expr("cast(n AS string) AS text")),
    )
    assert contents(result.store) == {"a": "base+1", "b": "", "dead": "old"}


@pytest.mark.parametrize("max_folded_rows,broadcast_bytes", [(200_000, 32 << 20), (200_000, 0), (15, 0)], ids=["broadcast", "shuffle", "rounds"])
def test_in_order_each_row_sees_the_one_before(spark, max_folded_rows, broadcast_bytes):
    rng = random.Random(11)
    rows = [("a" if rng.random() < 0.5 else rng.choice(["b", "dead", "n1", "n2", "n3"]), i, rng.choice("sadtprn")) for i in range(160)]

    def merge(payload, existing):
        text = F.concat(F.lit("v"), payload["i"])
        kind = payload["kind"]
        return (
            F.when(F.length(existing) > 12, A.replace(text))
            .when(kind == "s", A.set_(text, 60))
            .when(kind == "a", A.add(text))
            .when(kind == "d", A.delete())
            .when(kind == "t", A.touch(9))
            .when(kind == "p", A.append(text))
            .when(kind == "r", A.prepend(text))
            .otherwise(A.none())
        )

    source = spark.createDataFrame(rows, "doc_id string, i int, kind string").repartition(3)
    result = update_documents(
        store_of(spark), source, merge, AS_OF, order_by="i", max_folded_rows=max_folded_rows, broadcast_bytes=broadcast_bytes
    )
    state = {k: v for k, v in STORED.items() if k != "dead"}
    ops = {"s": "SET", "a": "ADD", "d": "DELETE", "t": "TOUCH", "p": "APPEND", "r": "PREPEND", "n": "NONE"}
    outcomes = []
    for key, i, kind in rows:
        value = state.get(key, (None, None))[0]
        op, expiry = ("REPLACE", 0) if value is not None and len(value) > 12 else (ops[kind], {"s": 60, "t": 9}.get(kind, 0))
        outcomes.append((key, op, apply_one(state, key, op, f"v{i}", expiry, AS_OF_TIME)))
    assert contents(result.store) == {k: v for k, (v, _) in state.items()}
    expiries = {r["doc_id"]: r["e"] for r in result.store.select("doc_id", F.unix_seconds("expires_at").alias("e")).collect()}
    assert expiries == {k: int(e.timestamp()) if e else None for k, (_, e) in state.items()}
    counters = {r["counter"]: r["value"] for r in update_counters(result.summary).collect()}
    failed = [o for o in outcomes if o[2] in ("exists", "missing")]
    assert counters == {
        "FAILED_STORE_OPERATIONS": len(failed),
        "EXISTENT_KEYS": sum(o[2] == "exists" for o in failed),
        "NON_EXISTENT_TOUCHED_KEYS": sum(o[1] == "TOUCH" for o in failed),
    }
    assert {r["doc_id"] for r in result.summary.collect()} == {k for k, _, _ in rows}


def test_row_by_row_merge_may_use_pandas(spark):
    @F.pandas_udf("string")
    def shout(text, existing):
        return text.str.upper() + existing.fillna("-")

    source = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("new", 3, "z")], "doc_id string, seq int, text string")
    actions = merge_actions(source, store_of(spark), lambda p, old: A.set_(shout(p["text"], old)), AS_OF)
    assert {(r["doc_id"], r["seq"], r["value"]) for r in actions.collect()} == {("a", 1, "Xbase"), ("a", 2, "Ybase"), ("new", 3, "Z-")}
    assert contents(apply_actions(store_of(spark), actions, AS_OF).store)["a"] == "Ybase"


@pytest.mark.parametrize(
    "options",
    [{}, {"max_group_rows": 10}, {"max_group_rows": 10, "broadcast_bytes": 0}],
    ids=["join", "hot-broadcast", "hot-salted"],
)
def test_lookup_keeps_copies(spark, options):
    keys = ["a"] * 40 + ["zz"] * 30 + [None] * 20 + ["dead", "b", "q"]
    rows = spark.createDataFrame([(k, i // 2) for i, k in enumerate(keys)], "doc_id string, n int")
    found = lookup_documents(rows, store_of(spark), AS_OF, **options).collect()
    values = {"a": "base", "b": ""}
    assert sorted(map(str, found)) == sorted(
        f"Row(doc_id={k!r}, n={i // 2}, existing={values.get(k)!r})" for i, k in enumerate(keys)
    )


def test_existence(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("x",), ("dead",), (None,)], "doc_id string")
    split = key_existence(keys, store_of(spark), AS_OF)
    assert {tuple(r) for r in split.collect()} == {("a", 2, True), ("x", 1, False), ("dead", 1, False)}
    assert {tuple(r) for r in existence_counts(split).collect()} == {(True, 1, 2), (False, 2, 2)}
    assert existing_keys(keys, store_of(spark), AS_OF).count() == 2
    assert {r["doc_id"] for r in missing_keys(keys, store_of(spark), AS_OF).collect()} == {"x", "dead", None}


def choose(payload, existing):
    """An action that depends on the payload and on what is there, as a Python function."""
    kind = payload["n"] % 9
    text = f"{payload['n']}:{len(existing or '')};"
    return None if kind == 8 else (A.OPERATIONS[kind % len(A.OPERATIONS)], text, payload["n"] % 3)


@pytest.mark.parametrize("keys", [0, 64 << 20], ids=["shuffle", "broadcast"])
def test_python_merge_streams_in_order(spark, monkeypatch, keys):
    monkeypatch.setattr("docloom.operators.merging.KEY_BROADCAST_BYTES", keys)
    monkeypatch.setattr("docloom.operators.merging._BATCH_ROWS", 3)
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", "dead", "", None, "n1", "n2", "n3", "n4"]), n) for n in range(300)]
    store = store_of(spark, STORED | {"untouched": ("same", None)})
    source = spark.createDataFrame(rows, "doc_id string, n long").repartition(4)
    result = update_in_order(store, source, choose, AS_OF, order_by="n")
    want, counted = {k: v for k, (v, e) in STORED.items() if e is None}, 0
    for key, n in rows:
        if key:
            counted += 1
            op, text, _ = choose({"n": n}, want.get(key)) or (A.NONE, None, 0)
            old = want.get(key)
            if op == A.SET or op == A.ADD and old is None or op == A.REPLACE and old is not None:
                want[key] = text
            elif old is not None and op in (A.APPEND, A.PREPEND):
                want[key] = old + text if op == A.APPEND else text + old
            elif op == A.DELETE:
                want.pop(key, None)
    assert contents(result.store) == want | {"untouched": "same"}
    totals = result.summary.select("stored", "already_exists", "missing", "ignored").groupBy().sum().first()
    assert sum(totals) == counted
    assert {r["doc_id"] for r in result.summary.collect()} == {k for k, _ in rows if k}


def test_python_merge_refuses_a_negative_expiry(spark):
    source = spark.createDataFrame([("a", 1)], "doc_id string, n long")
    with pytest.raises(Exception, match="negative expiry"):
        update_in_order(store_of(spark), source, lambda p, old: (A.SET, "x", -1), AS_OF, order_by="n").store.collect()

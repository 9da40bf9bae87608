"""Merges composed at once against the same merges one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from docloom.functions import actions as A
from docloom.operators import composing, skew
from docloom.operators.composing import update_composed
from docloom.operators.update import update_documents
from test_apply import frames, random_case, stored


def merge(payload, existing):
    """Every kind of answer, by the row: fixed, kept, removed, turned round, failing and none."""
    text = F.concat(F.lit("v"), payload["n"], F.lit(";"))
    kind = payload["n"] % 11
    return (
        F.when(kind == 0, A.delete())
        .when(kind == 1, F.when(existing.isNull(), A.add(text, 60)).otherwise(A.delete()))  # turned round
        .when(kind == 2, F.when(existing.isNull(), A.none()).otherwise(A.replace(F.concat(text, existing, F.lit("<"), text), 60)))
        .when(kind == 3, A.append(text))
        .when(kind == 4, F.when(existing.isNull(), A.add(text)).otherwise(A.set_(F.concat(existing, text))))
        .when(kind == 5, A.touch(30))
        .when(kind == 6, A.add(text))
        .when(kind == 7, A.prepend(text))
        .when(kind == 8, F.when(existing.isNull(), A.set_(text, 5)).otherwise(A.none()))
        .when(kind == 9, F.when(existing.isNull(), A.add(text)).otherwise(A.delete()))
        .otherwise(A.replace(text))
    )


def cases(spark, seed, n, keys):
    rng = random.Random(seed)
    state, _ = random_case(seed)
    store, _ = frames(spark, state, [("k", 1, "SET", "v", 0)])
    rows = [("k4" if rng.random() < 0.5 else f"k{rng.randrange(keys)}", i) for i in rng.sample(range(10 * n), n)] + [(None, -1), ("", -2)]
    return store, spark.createDataFrame(rows, "doc_id string, n long").repartition(3)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_group_rows", [2_000_000, 20, 7])
def test_composed_equals_in_order(spark, seed, max_group_rows):
    store, rows = cases(spark, seed, 300, 30)
    want = update_documents(store, rows, merge, AS_OF, order_by="n")
    got = update_composed(store, rows, merge, AS_OF, order_by="n", max_group_rows=max_group_rows)
    assert stored(got.store) == stored(want.store)
    assert sorted(map(tuple, got.summary.collect())) == sorted(map(tuple, want.summary.collect()))


def test_the_number_of_jobs_does_not_grow_with_a_key(spark):
    store = frames(spark, {"k": ("x", None)}, [("k", 1, "SET", "v", 0)])[0]

    def jobs(n):
        rows = spark.range(n).selectExpr("'k' AS doc_id", "id AS n")
        spark.sparkContext.setJobGroup(f"composed-{n}", "")
        update_composed(store, rows, merge, AS_OF, order_by="n", max_group_rows=50).store.collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"composed-{n}"))

    few, many = jobs(400), jobs(4000)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert many <= few + 3


def test_merges_that_cannot_be_composed_are_refused(spark):
    store, rows = cases(spark, 1, 30, 30)
    for wrong in (
        lambda p, old: F.when(old.isNull(), A.none()).otherwise(A.replace(F.concat(old, old))),
        lambda p, old: F.when(old.isNull(), A.none()).otherwise(A.append(old)),
    ):
        with pytest.raises(Exception, match="cannot be composed"):
            update_composed(store, rows, wrong, AS_OF, order_by="n").store.collect()
    bare = frames(spark, {"k4": (None, None)}, [("k", 1, "SET", "v", 0)])[0]
    with pytest.raises(Exception, match="null text"):
        update_composed(bare, rows, merge, AS_OF, order_by="n").store.collect()


def test_no_rows(spark):
    store, rows = cases(spark, 1, 30, 30)
    got = update_composed(store, rows.limit(0), merge, AS_OF, order_by="n")
    assert stored(got.store) == stored(store) and got.summary.count() == 0


def test_many_small_keys_over_the_limit_stay_off_the_driver(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 40)
    monkeypatch.setattr(skew, "local_table", lambda *a: pytest.fail("a table of keys was collected"))
    store = frames(spark, {"k1": ("x", None)}, [("k", 1, "SET", "v", 0)])[0]
    rows = spark.range(1000).selectExpr("concat('k', id % 200) AS doc_id", "id AS n")

    def alternating(payload, existing):
        return F.when(existing.isNull(), A.add(payload["n"].cast("string"))).otherwise(A.delete())

    got = update_composed(store, rows, alternating, AS_OF, order_by="n", max_group_rows=2)
    assert got.summary.where("stored = 5 AND already_exists + missing + ignored = 0").count() == 200
    assert stored(got.store) == {f"k{i}": (str(i + 800), None) for i in range(200) if i != 1}


def test_the_summary_takes_one_shuffle_of_the_rows_and_applies_nothing(spark, monkeypatch):
    store, rows = cases(spark, 2, 300, 30)
    want = update_documents(store, rows, merge, AS_OF, order_by="n").summary
    written, write = {}, composing.materialize

    def noting(df, name, **options):
        written[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, **options)

    monkeypatch.setattr(composing, "materialize", noting)
    monkeypatch.setattr(composing, "apply_actions", lambda *a, **k: pytest.fail("a summary needs no store"))
    got = update_composed(store, rows, merge, AS_OF, order_by="n")
    assert sorted(map(tuple, got.summary.collect())) == sorted(map(tuple, want.collect()))
    assert list(written) == ["composed-actions"]  # not the rows before, too
    plan = written["composed-actions"]
    # Of the rows and of the documents.
    assert plan.count("Exchange hashpartitioning(doc_id") == 2 and plan.count("Sort [") == 2, plan


def test_only_oversized_keys_are_cut(spark, monkeypatch):
    store, rows = cases(spark, 1, 300, 30)
    written, write = {}, composing.materialize
    monkeypatch.setattr(composing, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    got = update_composed(store, rows, merge, AS_OF, order_by="n", max_group_rows=60)
    assert got.summary.count() == rows.where("doc_id != ''").select("doc_id").distinct().count()
    assert {r["doc_id"] for r in written["composed-rows"].select("doc_id").distinct().collect()} == {"k4"}
    assert written["composed-rows"].agg(F.max("_segment")).first()[0] == (rows.where("doc_id = 'k4'").count() - 1) // 60


def test_a_store_larger_than_the_feed_is_asked_only_for_named_documents(spark):
    state = {f"k{i}": (f"t{i}", None) for i in range(40)} | {"bare": (None, None)}
    store = frames(spark, state, [("k", 1, "SET", "v", 0)])[0]
    rows = spark.createDataFrame([("k1", 3), ("k1", 0), ("new", 6), ("new", 9)], "doc_id string, n long")
    want = update_documents(store, rows, merge, AS_OF, order_by="n")
    got = update_composed(store, rows, merge, AS_OF, order_by="n")
    assert stored(got.store) == stored(want.store)
    assert sorted(map(tuple, got.summary.collect())) == sorted(map(tuple, want.summary.collect()))

"""Stores in buckets against a replay of their feeds, and views that follow them against views made anew."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, AS_OF_TIME
from docloom.functions import actions as A
from docloom.operators.apply import apply_actions
from docloom.operators.keys import plan_keys
from docloom.operators.view_changes import changed_by, index_changes
from docloom.operators.views import define_view, scan_view
from docloom.plans.jobs import export_lines, import_view, update_job
from docloom.schemas import ACTIONS, STORE
from docloom.sinks.store import current_store, save_actions
from docloom.sinks.text import read_kv_text
from docloom.sources import buckets as B
from docloom.sources import versions as V
from docloom.sources import view_store as S
from docloom.sources.tables import write_snapshot
from replay import replay
from test_apply import expected_store, frames, random_case, stored


def files_of(df):
    return set(df.inputFiles())


def scanned_rows(df):
    """Rows that the file scans of a plan have put out."""
    df.collect()
    found, rest = 0, [df._jdf.queryExecution().executedPlan()]
    while rest:
        node = rest.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            rest.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            rest.append(node.plan())
        if "Scan parquet" in node.nodeName():
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        rest += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("seed", range(3))
def test_feeds_equal_replay_and_old_versions_stay(spark, tmp_path, seed):
    root = str(tmp_path)
    state, _ = random_case(seed)
    store, _ = frames(spark, state, [("k", 1, "SET", "v", 0)])
    assert B.create_buckets(store, root, 7, files=1 + seed) == 1
    states = [state]
    for step in range(3):
        _, actions = random_case(10 * seed + step, n_actions=60, n_keys=40)
        saved = save_actions(spark.createDataFrame(actions, ACTIONS), root, AS_OF)
        state, outcomes = replay(state, actions, AS_OF_TIME)
        states.append(state)
        assert saved.version == step + 2
        assert sorted(map(tuple, saved.outcomes.collect()), key=repr) == sorted(outcomes, key=repr)
    for version, state in enumerate(states, 1):
        assert stored(B.read_buckets(spark, root, version)) == expected_store(state)
    assert stored(current_store(spark, root)) == expected_store(states[-1])


def numbered(spark, n):
    return spark.range(n).selectExpr("concat('d', id) AS doc_id", "concat('text ', id) AS value", "cast(null AS timestamp) AS expires_at")


def deletes(spark, ids):
    return spark.createDataFrame([(i, n, "DELETE", None, 0) for n, i in enumerate(ids)], ACTIONS)


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    root = str(tmp_path)
    B.create_buckets(numbered(spark, 1000), root, 50)
    before = V.read_version(spark, root)[1]["writes"]
    feed = deletes(spark, ["d5", "d6", "absent", "", None])
    touched = B.touched_buckets(spark, root, feed)
    assert 1 <= len(touched) <= 3
    seen = []

    def compute(store):
        seen.append(files_of(store))
        return apply_actions(store, feed, AS_OF)

    B.change_buckets(spark, root, feed, compute)
    after = V.read_version(spark, root)[1]["writes"]
    assert {b for b in after if after[b] != before[b]} == {str(b) for b in touched}
    # What was read, and what was read for that of the plan, lies in the folders of touched buckets.
    assert {f.rsplit("bucket=", 1)[1].split("/")[0] for f in seen[0]} == {str(b) for b in touched}
    assert B.read_buckets(spark, root).count() == 998 and B.read_buckets(spark, root, 1).count() == 1000
    shared = files_of(B.read_buckets(spark, root, 1)) & files_of(B.read_buckets(spark, root, 2))
    assert len(shared) == 50 - len(touched)


def test_a_broken_write_leaves_the_store_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    B.create_buckets(numbered(spark, 100), root, 5)
    feed = deletes(spark, ["d5"])

    def broken(store):
        return SimpleNamespace(store=store.withColumn("value", F.expr("cast(raise_error('gone wrong') AS string)")))

    with pytest.raises(Exception, match="gone wrong"):
        B.change_buckets(spark, root, feed, broken)
    assert V.versions(spark, root) == [1] and B.read_buckets(spark, root).count() == 100
    assert save_actions(feed, root, AS_OF).version == 2
    B._write(numbered(spark, 10), root, V.read_version(spark, root)[1])  # written, and broken off before it was published
    assert len(B.remove_unused(spark, root, 2)) == 1
    assert B.read_buckets(spark, root, 1).count() == 100
    assert len(B.remove_unused(spark, root, 1)) == 0  # other buckets of the first write are still in use
    assert V.versions(spark, root) == [2] and B.read_buckets(spark, root).count() == 99


def test_the_second_of_two_writers_fails(spark, tmp_path):
    root = str(tmp_path)
    B.create_buckets(numbered(spark, 100), root, 5)
    feed = deletes(spark, ["d5"])

    def late(store):
        save_actions(deletes(spark, ["d6"]), root, AS_OF)
        return apply_actions(store, feed, AS_OF)

    with pytest.raises(V.VersionExists):
        B.change_buckets(spark, root, feed, late)
    left = {r.doc_id for r in B.read_buckets(spark, root).collect()}
    assert "d5" in left and "d6" not in left
    save_actions(feed, root, AS_OF)
    assert "d5" not in {r.doc_id for r in B.read_buckets(spark, root).collect()}


def test_buckets_may_become_empty_and_full_again(spark, tmp_path):
    root = str(tmp_path)
    B.create_buckets(spark.createDataFrame([], STORE), root, 3)
    assert B.read_buckets(spark, root).collect() == []
    save_actions(spark.createDataFrame([("a", 1, "SET", "x", 0), ("b", 1, "ADD", "y", 0)], ACTIONS), root, AS_OF)
    assert B.read_buckets(spark, root).count() == 2
    save_actions(deletes(spark, ["a", "b"]), root, AS_OF)
    assert B.read_buckets(spark, root).collect() == [] and V.read_version(spark, root)[1]["writes"] == {}
    save_actions(spark.createDataFrame([], ACTIONS), root, AS_OF)
    assert B.read_buckets(spark, root, 2).count() == 2


def test_a_lookup_reads_a_small_share_of_the_rows(spark, tmp_path):
    root = str(tmp_path)
    store = numbered(spark, 400_000).withColumn("value", F.sha2("doc_id", 512))
    B.create_buckets(store, root, 16)
    ids = spark.createDataFrame([(f"d{4001 * i}",) for i in range(90)] + [("absent",), (None,), ("d0",)], "doc_id string")
    found = B.documents_by_id(spark, root, ids)
    assert {r.doc_id for r in found.collect()} == {f"d{4001 * i}" for i in range(90)}
    assert scanned_rows(found) < 400_000 / 2
    one = B.documents_by_id(spark, root, ids.where("doc_id = 'd4001'"))
    assert [r.doc_id for r in one.collect()] == ["d4001"]
    assert scanned_rows(one) <= 400_000 / 16 / 2
    assert B.documents_by_id(spark, root, ids.where("doc_id = 'absent'")).collect() == []


def test_many_ids_are_joined(spark, tmp_path):
    root = str(tmp_path)
    B.create_buckets(numbered(spark, 5000), root, 4)
    ids = spark.range(0, 9000, 3).selectExpr("concat('d', id) AS doc_id")
    assert B.documents_by_id(spark, root, ids).count() == 1667


def test_import_from_a_store_in_buckets(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    B.create_buckets(numbered(spark, 50), root, 4)
    view = define_view(numbered(spark, 60), [F.length("doc_id")], json_only=False)
    report = import_view(view, "[2];[9]", out, root)
    assert {(r.doc_id, r.value) for r in read_kv_text(spark, out).collect()} == {(f"d{i}", f"text {i}") for i in range(10)}
    assert report.counters.first()["value"] == 0


# --- views that follow their store ---------------------------------------------------------------------


def by_length(docs):
    return define_view(docs, [F.length("value") % 5, F.substring("value", 1, 1)], json_only=False, emitted=F.col("value"))


def with_docs(docs):
    return define_view(docs, "value", where=F.length("value") > 3, json_only=False, include_docs=True)


def view_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("define", [by_length, with_docs])
def test_view_after_feeds_equals_the_view_made_anew(spark, tmp_path, define):
    root, view = str(tmp_path / "store"), str(tmp_path / "view")
    state, _ = random_case(1)
    B.create_buckets(frames(spark, state, [("k", 1, "SET", "v", 0)])[0], root, 6)
    S.create_view(spark, view, root, define)
    for step in range(4):
        _, actions = random_case(20 + step, n_actions=30 + 60 * (step % 2), n_keys=30)
        save_actions(spark.createDataFrame(actions, ACTIONS), root, AS_OF, views={view: define})
        want = define(B.read_buckets(spark, root))
        made = S.read_followed(spark, view)
        assert made.columns == want.columns
        assert view_rows(made) == view_rows(want)
    S.fold(spark, view)
    assert V.read_version(spark, view)[1]["layers"] == []
    assert view_rows(S.read_followed(spark, view)) == view_rows(want)


def test_a_view_left_behind_catches_up_in_one_layer(spark, tmp_path):
    root, view = str(tmp_path / "store"), str(tmp_path / "view")
    B.create_buckets(numbered(spark, 2000), root, 40)
    S.create_view(spark, view, root, by_length)
    for ids in (["d1", "d2"], ["d3"], ["nothing"]):
        save_actions(deletes(spark, ids), root, AS_OF)
    save_actions(spark.createDataFrame([("d1", 1, "ADD", "text 1", 0), ("d9", 1, "TOUCH", None, 60)], ACTIONS), root, AS_OF)
    S.follow(spark, view, root, by_length)
    contents = V.read_version(spark, view)[1]
    assert [x["rows"] for x in contents["layers"]] == [2]  # d2 and d3; d1 came back as it was, d9 only expires later
    assert view_rows(S.read_followed(spark, view)) == view_rows(by_length(B.read_buckets(spark, root)))
    assert S.follow(spark, view, root, by_length) == 2  # nothing new
    # Only buckets that differ between the versions were looked at.
    changed = B.changed_documents(spark, root, 1)
    assert len(files_of(changed)) <= 2 * 5
    # The literal filters of a scan reach the folders of base and layer.
    keys = plan_keys(spark, '[1,"t"];[7,"x"]').select("view_key", "key_ord")
    scan = scan_view(S.read_followed(spark, view), keys)
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert scan.count() == by_length(B.read_buckets(spark, root)).where('view_key = \'[1,"t"]\'').count()
    assert plan.count("In(") + plan.count(" IN ") + plan.count("(k0") >= 2


def test_layers_are_folded(spark, tmp_path, monkeypatch):
    root, view = str(tmp_path / "store"), str(tmp_path / "view")
    monkeypatch.setattr(S, "MAX_LAYERS", 2)
    B.create_buckets(numbered(spark, 300), root, 10)
    S.create_view(spark, view, root, by_length)
    layers = []
    for i in range(4):
        save_actions(deletes(spark, [f"d{i}"]), root, AS_OF, views={view: by_length})
        layers.append(len(V.read_version(spark, view)[1]["layers"]))
    assert layers == [1, 2, 0, 1]
    assert view_rows(S.read_followed(spark, view)) == view_rows(by_length(B.read_buckets(spark, root)))
    # An older version of the view reads as it did.
    assert S.read_followed(spark, view, 2).count() == 299


def test_jobs_keep_views_up_to_date(spark, tmp_path):
    root, view, lines = (str(tmp_path / n) for n in ("store", "view", "lines"))
    B.create_buckets(numbered(spark, 60), root, 8)
    S.create_view(spark, view, root, by_length)
    spark.createDataFrame([("d1\tlonger text than before",), ("d70\tnew",)], "value string").write.text(lines)
    export_lines(spark, lines, root, AS_OF, op="SET", views={view: by_length})
    assert view_rows(S.read_followed(spark, view)) == view_rows(by_length(B.read_buckets(spark, root)))
    source = spark.createDataFrame([("d2", 1), ("d80", 2)], "doc_id string, n int")
    update_job(source, root, lambda p, old: A.set_(F.concat(F.lit("n"), p["n"])), AS_OF, views={view: by_length})
    want = by_length(B.read_buckets(spark, root))
    assert view_rows(S.read_followed(spark, view)) == view_rows(want) and want.where("doc_id = 'd80'").count() == 1
    plain = str(tmp_path / "plain")
    write_snapshot(numbered(spark, 5), plain)
    with pytest.raises(ValueError, match="in buckets"):
        save_actions(deletes(spark, ["d1"]), plain, AS_OF, views={view: by_length})


def test_a_view_of_nothing(spark, tmp_path):
    root, view = str(tmp_path / "store"), str(tmp_path / "view")
    B.create_buckets(spark.createDataFrame([], STORE), root, 2)
    S.create_view(spark, view, root, by_length)
    assert S.read_followed(spark, view).collect() == []
    save_actions(spark.createDataFrame([("a", 1, "SET", "abc", 0)], ACTIONS), root, AS_OF, views={view: by_length})
    assert [r.view_key for r in S.read_followed(spark, view).collect()] == ['[3,"a"]']


def test_changes_of_an_apply_give_the_same_index_rows(spark):
    for seed in range(3):
        state, actions = random_case(seed)
        store, feed = frames(spark, state, actions)
        result = apply_actions(store, feed, AS_OF)
        changes = view_rows(index_changes(by_length, changed_by(result, store)))
        old, new = set(view_rows(by_length(store))), set(view_rows(by_length(result.store)))
        keys_of_new = {(r[0], r[3]) for r in new}
        want = [(r[0], r[3], r[1], r[2], r[4], True) for r in new - old]
        want += [(r[0], r[3], r[1], r[2], r[4], False) for r in old - new if (r[0], r[3]) not in keys_of_new]
        assert changes == sorted(want, key=repr)



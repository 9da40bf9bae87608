from __future__ import annotations

import math
import random

import numpy as np
from odd import odd_documents, rng  # noqa: F401

from docloom.llm import neighbours

FORM = "vec_id long, embedding array<float>, label int"


def by_hand(rows, every=100, k=10):
    usable = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8:
            usable[i] = np.array(v, np.float32).astype(float)
    out = []
    for q in sorted(i for i in usable if i % every == 0):
        ranked = sorted((float(np.sqrt(((usable[q] - v) ** 2).sum())), i) for i, v in usable.items() if i != q)[:k]
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(ranked)]
    return out


def result(df):
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in df.orderBy("query_id", "rank").collect()]


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def vectors(n, seed=1, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    return [(i, [float(x) for x in (centres[i % 6] + 0.4 * rng.normal(size=width)).astype(np.float32)], 0) for i in range(n)]


def test_exact_when_all_leaves_are_opened(spark):
    rows = vectors(700)
    copy = rows[100][1]
    rows += [(1000 + i, copy, 1) for i in range(300)]  # one vector many times, two queries among them
    rows += [(1, None, 0), (5000, [], 0), (5100, [0.0] * 8, 0), (5200, [float("nan")] * 8, 0), (5300, [None] * 8, 0)]
    rows += [(5400, [float("inf")] + [1.0] * 7, 0), (5500, [1.0, 2.0], 0), (None, copy, 0), (7, rows[7][1], 0)]
    want = by_hand([r for r in rows if r[0] != 1 or r[1]])
    for sizes in ({}, {"slice_rows": 2}):
        same(result(neighbours.nearest(spark.createDataFrame(rows, FORM), share=99, leaf_rows=16, block_rows=20, **sizes)), want)


def test_cells_are_bounded_in_questions_and_entries(spark, monkeypatch):
    """Ten thousand questions to a thousand vectors: no cell holds more than a block and about a slice."""
    rows = [(i * 100, v, 0) for i, v, _ in vectors(10_000)] + [(i * 100 + 1, v, 0) for i, v, _ in vectors(1000, seed=2)]
    table = spark.createDataFrame(rows, FORM)
    found = neighbours.nearest(table, share=0.02, slice_rows=500, trees=2, k=2)
    assert found.groupBy("query_id").count().where("count = 2").count() == 10_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "leaf" in plan and "slice" in plan


def test_clustered_vectors_open_few_entries(spark, monkeypatch):
    needed = []
    measure = neighbours._entries_for
    monkeypatch.setattr(neighbours, "_entries_for", lambda *a: needed.append(measure(*a)) or needed[-1])
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(100, 16))
    rows = [(i, [float(x) for x in centres[i % 100] + 0.05 * rng.normal(size=16)], 0) for i in range(6000)]
    got = result(neighbours.nearest(spark.createDataFrame([(i, [float(x) for x in np.float32(v)], l) for i, v, l in rows], FORM)))
    assert 0 < needed[0] < 0.3 * 6000
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    hit = 0
    for q in range(0, 6000, 100):
        d = ((v - v[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hit += len(set(np.argsort(d, kind="stable")[:10].tolist()) & {g[2] for g in got if g[0] == q})
    assert hit / 600 >= 0.9


def test_few_rows(spark):
    same(result(neighbours.nearest(spark.createDataFrame(vectors(4), FORM))), by_hand(vectors(4)))
    assert neighbours.nearest(spark.createDataFrame([], FORM)).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(0, None, 1)], FORM)).count() == 0
    one = spark.createDataFrame([(0, [1.0] * 8, 1), (0, [1.0] * 8, 1)], FORM)
    assert neighbours.nearest(one).count() == 0


def test_recall_on_a_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = [tuple(r) for r in df.collect()]
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = result(neighbours.nearest(df))
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((v - v[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = set(ids[np.lexsort((ids, d))][:10])
        mine = [g for g in got if g[0] == q]
        assert [g[1] for g in mine] == list(range(1, 11))
        assert [g[3] for g in mine] == sorted(g[3] for g in mine)
        hit, total = hit + len(want & {g[2] for g in mine}), total + 10
    assert hit / total >= 0.9


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as p

    docs = p.table(spark, sf_dir, "documents")
    whole = {r.doc_id: r for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        before = docs
        docs = p.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == before.columns
        for r in docs.collect():
            assert r == whole[r.doc_id]
        if name != "mixing":
            assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
    last = p.sharding_stage(spark, docs, sf_dir).collect()
    assert len(last) == docs.count()
    assert {r["shard"] for r in last} == set(range(p.SHARDS))
    again = p.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r["shard"]) for r in again) == sorted((r.doc_id, r["shard"]) for r in last)


def test_pipeline_of_odd_rows(spark, odd_documents, tmp_path):
    import corpus_pipeline as p

    folder = str(tmp_path)
    random.seed(1)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind is in here at all")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    for docs in (odd_documents, odd_documents.limit(0)):
        extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        for name, stage in p.STAGES:
            before = docs
            docs = p.stored(stage(spark, docs, folder), "odd")
            rows = docs.collect()
            if name != "sharding":
                assert docs.dtypes == before.dtypes
            else:
                assert set(docs.columns) == set(before.columns) | {"shard", "slot"}
            # What an operator calls its own columns is left alone where the documents have a column of that name.
            kept = [c for c in extra if name != "sharding" or c not in ("shard", "slot")]
            assert all(r[c] == "mine" for r in rows for c in kept)
        assert bool(rows) == (before.count() > 0)

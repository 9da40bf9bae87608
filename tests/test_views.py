import os
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions.expiry import epoch_yyyymmdd, second_of_minute
from docloom.operators import skew
from docloom.operators.keys import plan_keys
from docloom.operators.metrics import import_profile
from docloom.operators.paging import assign_batches, page_rows
from docloom.operators.skew import number_rows, profile_groups, running_total
from docloom.operators.views import (
    define_view,
    documents_of,
    missing_documents,
    sample_view,
    scan_view,
    to_cells,
)
from docloom.plans.jobs import import_view, import_view_paged, import_view_to_cells
from docloom.schemas import STORE
from docloom.sinks.cells import read_cells
from docloom.sinks.text import read_kv_text
from docloom.sources.tables import read_view, write_view

CLICK = r"\Aclick::(\w+)::(\d+)\z"


def click_view(docs, **options):
    seconds = F.regexp_extract("doc_id", CLICK, 2).cast("bigint")
    key = [epoch_yyyymmdd(seconds), second_of_minute(seconds) % 2]
    return define_view(docs, key, where=F.col("doc_id").rlike(CLICK), **options)


def test_click_document(spark):
    body = '{"target":"menu","depth":3}'
    docs = spark.createDataFrame(
        [("click::ada::1583020801", body), ("click::j::1583020801", "no json"), ("x", body)],
        "doc_id string, value string",
    )
    rows = click_view(docs).collect()
    assert [(r["view_key"], r["k0"], r["k1"], r["doc_id"]) for r in rows] == [
        ('["20200301",1]', "20200301", "1", "click::ada::1583020801")
    ]


@pytest.fixture(scope="module")
def store(spark):
    rng = random.Random(5)
    langs = ["en"] * 6 + ["de", "fr"]
    rows = [(f"d{i:04d}", f"text\t{i}\nend\\", None, rng.choice(langs), i % 3) for i in range(600)]
    schema = "doc_id string, value string, expires_at timestamp, lang string, part int"
    return spark.createDataFrame(rows, schema)


def lang_view(store, **options):
    return define_view(store, [F.col("lang"), F.col("part")], json_only=False, **options)


SPEC = '["en",((0-2))];["de",1];["de",1];["no",0]'


def test_listed_twice_is_read_twice_and_order_of_keys_kept(spark, store):
    keys = plan_keys(spark, SPEC)
    for broadcast_bytes in (64 << 20, 0):
        rows = scan_view(lang_view(store), keys.select("view_key", "key_ord"), store, broadcast_bytes=broadcast_bytes)
        found = sorted((r["key_ord"], r["doc_id"]) for r in rows.collect())
        wanted = []
        for r in store.collect():
            if r["lang"] == "en":
                wanted.append((r["part"], r["doc_id"]))
            if r["lang"] == "de" and r["part"] == 1:
                wanted += [(3, r["doc_id"]), (4, r["doc_id"])]
        assert found == sorted(wanted)


def test_missing_document_is_null_dropped_and_counted(spark):
    docs = spark.createDataFrame([("a", "1"), ("b", "2")], "doc_id string, value string")
    view = define_view(docs, [F.lit("k")])
    store = spark.createDataFrame([("a", "1", None)], STORE)
    rows = scan_view(view, plan_keys(spark, '["k"]').select("view_key"), store)
    assert {(r["doc_id"], r["value"]) for r in rows.collect()} == {("a", "1"), ("b", None)}
    assert documents_of(rows).count() == 1
    assert missing_documents(rows).first()["value"] == 1
    assert to_cells(rows, "f", "q").count() == 1


def test_stored_view_keeps_leading_zeros_and_is_pruned(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{i}", "1", f"{i % 5:03d}") for i in range(50)], "doc_id string, value string, p string")
    path = str(tmp_path / "view")
    write_view(define_view(docs, [F.col("p"), F.lit(None).cast("string")]), path)
    keys = plan_keys(spark, '["001",null]').select("view_key")
    rows = scan_view(read_view(spark, path), keys)
    assert rows.count() == 10
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [CASE WHEN NOT (k0#" in plan and "BroadcastHashJoin" in plan
    files = {r[0] for r in rows.select(F.input_file_name()).collect()}
    assert len(files) == 1 and "k0=v001" in files.pop()


def test_last_put_stays(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "w", 2), ("b", "z", 1)], "doc_id string, value string, o int")
    cells = {bytes(r["row_key"]): bytes(r["value"]) for r in to_cells(rows, "f", "q", order="o").collect()}
    assert cells == {b"a": b"y", b"b": b"z"}
    with pytest.raises(ValueError):
        to_cells(rows, "", "q")


@pytest.mark.parametrize("max_group_rows", [2_000_000, 30], ids=["window", "segments"])
def test_row_numbers(spark, max_group_rows):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(20)}", f"{i:05d}") for i in rng.sample(range(99999), 1500)]
    df = spark.createDataFrame(rows, "g string, o string").repartition(5)
    hot = profile_groups(df, "g", "o", max_group_rows=max_group_rows).hot
    assert ("hot" in hot) == (max_group_rows == 30)
    found = {(r["g"], r["o"]): r["row_no"] for r in number_rows(df, "g", "o", max_group_rows=max_group_rows).collect()}
    assert len(found) == 1500
    for g in {g for g, _ in rows}:
        assert [found[(g, o)] for o in sorted(o for h, o in rows if h == g)] == list(range(sum(h == g for h, _ in rows)))


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(0, 1000, 3)], "o bigint, v bigint").repartition(4)
    total, expected = {r["o"]: r["t"] for r in running_total(df, "o", "v", name="t", block=64).collect()}, 0
    for i in range(0, 1000, 3):
        assert total[i] == expected
        expected += i % 7


@pytest.mark.parametrize("max_group_rows", [2_000_000, 40])
def test_pages(spark, store, max_group_rows):
    keys = plan_keys(spark, SPEC).select("view_key", "key_ord")
    rows = scan_view(lang_view(store), keys)
    pages = page_rows(rows, 16, max_group_rows=max_group_rows).collect()
    assert sorted((r["key_ord"], r["doc_id"]) for r in pages) == sorted((r["key_ord"], r["doc_id"]) for r in rows.collect())
    expected, page_no = {}, 0
    for key in range(6):
        ids = sorted(r["doc_id"] for r in pages if r["key_ord"] == key)
        for start in range(0, len(ids), 16):
            for doc in ids[start : start + 16]:
                expected[(key, doc)] = (start // 16, page_no)
            page_no += 1
    assert {(r["key_ord"], r["doc_id"]): (r["page_in_key"], r["page_no"]) for r in pages} == expected


def test_batches(spark, store):
    sizes = assign_batches(store, "lang", "doc_id", 50, max_group_rows=60).groupBy("lang", "batch_id").count().collect()
    per_lang = {}
    for r in sizes:
        per_lang.setdefault(r["lang"], {})[r["batch_id"]] = r["count"]
    for batches in per_lang.values():
        assert sorted(batches) == list(range(len(batches)))
        assert all(batches[b] == 50 for b in range(len(batches) - 1)) and 0 < batches[len(batches) - 1] <= 50


def test_import_profile_keeps_empty_chunks(spark, store):
    keys = plan_keys(spark, SPEC, num_chunks=3)
    rows = scan_view(lang_view(store), keys.select("view_key", "chunk_id"))
    profile = {r["chunk_id"]: (r["n_keys"], r["n_rows"]) for r in import_profile(rows, keys).collect()}
    assert set(profile) == {0, 1, 2} and sum(n for n, _ in profile.values()) == 6
    empty = plan_keys(spark, '["none",1]')
    profile = import_profile(scan_view(lang_view(store), empty.select("view_key", "chunk_id")), empty)
    assert [tuple(r) for r in profile.collect()] == [(0, 1, 0)]


def test_import_to_text(spark, store, tmp_path):
    path = str(tmp_path / "out")
    report = import_view(lang_view(store), SPEC, path, store, num_chunks=2)
    found = read_kv_text(spark, path)
    wanted = documents_of(report.rows)
    assert found.count() == wanted.count() > 0
    assert found.exceptAll(wanted).count() == 0
    assert report.counters.first()["value"] == 0


def test_import_to_text_without_escape_gives_bare_bytes(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x\ny", "k")], "doc_id string, value string, k string")
    view = define_view(docs, [F.col("k")], json_only=False, include_docs=True)
    path = str(tmp_path / "out")
    import_view(view, '["k"]', path, separator="|", escape=False)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part"))
    assert text == "a|x\ny\n"


def test_import_to_cells(spark, store, tmp_path):
    path = str(tmp_path / "cells")
    import_view_to_cells(lang_view(store), SPEC, path, "fam", "qual", store)
    cells = read_cells(spark, path)
    n = store.where("lang = 'en' OR (lang = 'de' AND part = 1)").count()
    assert cells.count() == n
    row = cells.where(F.col("row_key") == F.encode(F.lit("d0001"), "UTF-8"))
    assert row.count() <= 1 and {(r["family"], r["qualifier"]) for r in cells.take(3)} == {("fam", "qual")}


@pytest.mark.parametrize("include_docs", [False, True])
def test_import_to_pages(spark, store, tmp_path, include_docs):
    path = str(tmp_path / "pages")
    view = lang_view(store, include_docs=include_docs)
    report = import_view_paged(view, SPEC, path, None if include_docs else store, page_size=16)
    n_pages = report.rows.agg(F.max("page_no")).first()[0] + 1
    folders = sorted(f for f in os.listdir(path) if f.startswith("page="))
    assert folders == [f"page=part-{i:05d}" for i in range(n_pages)]
    for folder in folders:
        files = [f for f in os.listdir(os.path.join(path, folder)) if not f.startswith(".")]
        assert len(files) == 1
        lines = open(os.path.join(path, folder, files[0])).read().splitlines()
        assert len(lines) <= 16 and lines == sorted(lines)
    assert read_kv_text(spark, path).count() == report.rows.count()


def test_stored_view_keeps_odd_parts(spark, tmp_path):
    parts = ["", None, "null", "a/b", "k0=x", 'q"t', "v", "n", " ", "%20"]
    docs = spark.createDataFrame([(f"d{i}", "1", p) for i, p in enumerate(parts)], "doc_id string, value string, p string")
    view = define_view(docs, [F.col("p"), F.lit(1)])
    write_view(view, str(tmp_path / "v"))
    stored = read_view(spark, str(tmp_path / "v"))
    columns = ["view_key", "k0", "k1", "doc_id"]
    assert sorted(map(tuple, stored.select(columns).collect())) == sorted(map(tuple, view.select(columns).collect()))
    keys = view.select("view_key")
    for found in (scan_view(stored, keys), scan_view(stored, keys, broadcast_bytes=0)):
        assert sorted(r["doc_id"] for r in found.collect()) == sorted(f"d{i}" for i in range(len(parts)))
    null_part = view.withColumn("k0", F.lit(None).cast("string"))
    write_view(null_part, str(tmp_path / "n"))
    assert {r["k0"] for r in read_view(spark, str(tmp_path / "n")).collect()} == {None}


def test_sample_leaves_out_what_is_no_number(spark):
    view = spark.createDataFrame([("a", "1"), ("b", None), ("c", "null"), ("d", "7")], "doc_id string, k1 string")
    assert [r["doc_id"] for r in sample_view(view, "k1", 3).collect()] == ["a"]


def test_a_lookup_of_few_ids_moves_their_documents_only(spark):
    store = spark.range(1000).selectExpr("cast(id AS string) AS doc_id", "repeat('x', 50) AS value")
    view = spark.createDataFrame([("k", "5"), ("k", "6"), ("k", "none")], "view_key string, doc_id string")
    keys = spark.createDataFrame([("k",)], "view_key string")
    found = scan_view(view, keys, store)
    assert {r["doc_id"]: r["value"] is not None for r in found.collect()} == {"5": True, "6": True, "none": False}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    assert sorted(map(tuple, scan_view(view, keys, store, broadcast_bytes=0).collect())) == sorted(map(tuple, found.collect()))


def test_a_null_group_is_cut_too(spark):
    rows = spark.range(900).selectExpr("if(id % 9 < 8, null, id) AS g", "id")
    numbered = number_rows(rows, "g", "id", max_group_rows=50).where("g IS NULL").orderBy("id").collect()
    assert [r["row_no"] for r in numbered] == list(range(800))


def test_segments_of_many_small_groups_stay_few(spark, monkeypatch):
    """A low limit calls every group oversized; the driver's table must not grow with them."""
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 40)
    rows = spark.range(4000).selectExpr("if(id % 2 = 0, -1, id % 401) AS g", "id AS o")
    profile = profile_groups(rows, "g", "o", max_group_rows=4, streamed=True)
    assert set(profile.hot) == {-1} and profile.group_limit == 400
    bounds = skew.segment_bounds(rows, "g", "o", profile).collect()
    assert 4 < sum(len(r["_fine"]) + 1 for r in bounds) <= 40
    assert len(profile_groups(rows, "g", "o", max_group_rows=4).hot) == 402
    found = number_rows(rows, "g", "o", max_group_rows=4)
    assert found.groupBy("g").agg(F.expr("min_by(row_no, o) = 0 AND max(row_no) = count(*) - 1 AND count(DISTINCT row_no) = count(*) AS ok")).where("ok").count() == 402


def test_numbering_many_small_groups_collects_none(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 40)
    monkeypatch.setattr(skew, "local_table", lambda *a: pytest.fail("a table of groups was collected"))
    rows = spark.range(4000).selectExpr("id % 401 AS g", "id AS o")
    assert number_rows(rows, "g", "o", max_group_rows=4).where("row_no = o div 401").count() == 4000

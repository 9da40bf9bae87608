"""Ranges of key specs as filters on key parts: they hold for every key of the range, and prune."""

import json

import pytest
from pyspark.sql import functions as F

from docloom.operators.keys import key_intervals, plan_keys
from docloom.operators.views import define_view, key_parts, scan_view, within
from docloom.plans.jobs import import_view, scan_keys
from docloom.sinks.text import read_kv_text
from docloom.sources.tables import read_view, write_view
from test_buckets import scanned_rows

SPECS = [
    '["a((007-120))z",1];["b",((0-12))]',
    '["a((7-120))z",1]',
    '["((0-3))","x"];[5,"x"]',
    '[1((5-15)),true];[-((1-9)),null]',
    '["a((5-1))",0];["q\\"((1-2))",0]',
    '["((1-2))-((08-11))",0]',
    "[007,0]",
    '["é((1-3))",1.5]',
]


def parts_of(key):
    """Text of the parts as a view keeps them."""
    return [v if isinstance(v, str) else json.dumps(v) for v in json.loads(key)]


@pytest.mark.parametrize("spec", SPECS)
def test_every_key_of_a_spec_passes_its_filter(spark, spec):
    intervals = key_intervals(spark, spec, 2)
    keys = [r.view_key for r in plan_keys(spark, spec).collect()]
    if intervals is None:
        assert any(not k.startswith("[") or "007" in k for k in keys)
        return
    rows = [(*parts_of(k), k) for k in keys]
    view = spark.createDataFrame(rows + [("other", "9", "no"), ("a0007z", "1", "no")], "k0 string, k1 string, view_key string")
    passed = {r.view_key for r in within(view, intervals).collect()}
    assert set(keys) <= passed


def test_filters_leave_out_what_no_range_holds(spark):
    view = spark.createDataFrame([("a006z", "1"), ("a121z", "1"), ("a050y", "1"), ("a050z", "2"), ("a050z", "1")], "k0 string, k1 string")
    view = view.withColumn("view_key", F.lit(""))
    assert [tuple(r)[:2] for r in within(view, key_intervals(spark, '["a((007-120))z",1]', 2)).collect()] == [("a050z", "1")]
    view = spark.createDataFrame([("6",), ("121",), ("99",), ("x",), (None,)], "k0 string").withColumn("view_key", F.lit(""))
    assert [r.k0 for r in within(view, key_intervals(spark, "[((7-120))]", 1)).collect()] == ["99"]


def test_specs_that_are_no_arrays_prune_nothing(spark):
    assert key_intervals(spark, "a;b", 1) is None
    assert key_intervals(spark, '["a",1]', 1) is None
    assert key_intervals(spark, "", 1) == []


def test_a_long_range_reads_only_its_folders(spark, tmp_path):
    docs = spark.range(3000).selectExpr(
        "concat('d', id) AS doc_id", "concat('v', id) AS value", "lpad(cast(id % 100 * 2000 AS string), 6, '0') AS day"
    )
    view = define_view(docs, [F.col("day")], json_only=False, include_docs=True)
    path = str(tmp_path / "view")
    write_view(view, path)
    stored = read_view(spark, path)
    spec = '["((000000-099999))"]'
    pruned = within(stored, key_intervals(spark, spec, 1))
    assert key_parts(stored) == ["k0"]
    assert pruned.count() == 1500 and scanned_rows(pruned) == 1500
    rows = scan_keys(stored, spec)
    assert rows.count() == 1500 and scanned_rows(rows) == 1500
    want = scan_view(stored, plan_keys(spark, spec).select("view_key", "key_ord"))
    assert sorted(r.doc_id for r in rows.collect()) == sorted(r.doc_id for r in want.collect())


def test_an_import_has_one_file_for_each_chunk(spark, tmp_path):
    docs = spark.range(200).selectExpr("concat('d', id) AS doc_id", "concat('v', id) AS value", "cast(id % 8 AS int) AS part")
    view = define_view(docs, [F.col("part")], json_only=False, include_docs=True)
    out = str(tmp_path / "out")
    import_view(view, "[((0-7))]", out, num_chunks=4, by_chunk=True)
    lines = spark.read.text(out).select("value", F.input_file_name().alias("file")).collect()
    assert len({r.file for r in lines}) == 4
    assert len({(r.file, int(r.value.split("\t")[0][1:]) % 8 // 2) for r in lines}) == 4
    assert read_kv_text(spark, out).count() == 200
    with pytest.raises(ValueError, match="num_chunks"):
        import_view(view, "[0]", str(tmp_path / "none"), by_chunk=True)

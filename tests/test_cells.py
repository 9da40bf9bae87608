"""Cell tables in ranges of row keys: loads merge, last put wins, only met ranges are rewritten, reads prune."""

import pytest
from pyspark.sql import functions as F

from docloom.schemas import CELLS
from docloom.sinks.cells import load_cells, read_loaded_cells
from docloom.sources.versions import read_version


def cells(spark, rows):
    return spark.createDataFrame([(k, "d", q, v) for k, q, v in rows], CELLS)


def rows_of(df):
    return {(bytes(r.row_key), r.qualifier): bytes(r.value) for r in df.collect()}


def numbered(spark, ids, value):
    made = spark.createDataFrame([(i,) for i in ids], "i int").select(
        F.encode(F.format_string("r%05d", "i"), "UTF-8").alias("row_key"), F.lit("d").alias("family"), F.lit("q").alias("qualifier"),
        F.encode(F.lit(value), "UTF-8").alias("value"),
    )
    return made


def test_two_loads_equal_one_of_both(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    first = [(b"a", "x", b"1"), (b"a", "y", b"2"), (b"b\xff", "x", b"3"), (b"", "x", b"4"), (b"z", "x", None)]
    second = [(b"a", "x", b"9"), (b"c", "x", b"8"), (b"z", "x", b"7")]
    load_cells(cells(spark, first), two, ranges=3)
    assert load_cells(cells(spark, second), two) == 2
    last = {(k, q): v for k, q, v in first + second}
    load_cells(cells(spark, [(k, q, v) for (k, q), v in last.items()]), one, ranges=3)
    assert rows_of(read_loaded_cells(spark, two)) == rows_of(read_loaded_cells(spark, one)) == last
    before = {(bytes(r.row_key), r.qualifier): r.value for r in read_loaded_cells(spark, two, version=1).collect()}
    assert len(before) == 5 and before[b"z", "x"] is None


def test_a_load_rewrites_only_the_ranges_it_meets(spark, tmp_path):
    root = str(tmp_path)
    load_cells(numbered(spark, range(0, 3000), "old"), root, ranges=30)
    before = read_version(spark, root)[1]["writes"]
    assert len(before) == 30
    load_cells(numbered(spark, [5, 7, 2995, 9999], "new"), root)
    after = read_version(spark, root)[1]["writes"]
    assert {n for n in after if after[n] != before.get(n)} == {"0", "29"}
    found = rows_of(read_loaded_cells(spark, root))
    assert len(found) == 3001 and sum(v == b"new" for v in found.values()) == 4


def test_a_range_read_opens_only_its_files(spark, tmp_path):
    root = str(tmp_path)
    load_cells(numbered(spark, range(0, 3000), "v"), root, ranges=30)
    part = read_loaded_cells(spark, root, b"r01000", b"r01150")
    assert sorted(rows_of(part)) == [(b"r%05d" % i, "q") for i in range(1000, 1150)]
    assert len(part.inputFiles()) <= 3
    assert len(rows_of(read_loaded_cells(spark, root, low=b"r02990"))) == 10
    assert len(rows_of(read_loaded_cells(spark, root, high=b"r00010"))) == 10
    assert rows_of(read_loaded_cells(spark, root, b"x", b"y")) == {}


def test_row_keys_are_sorted_within_a_file(spark, tmp_path):
    root = str(tmp_path)
    load_cells(numbered(spark, range(500), "v").repartition(7), root, ranges=4)
    for file in read_loaded_cells(spark, root).inputFiles():
        keys = [bytes(r.row_key) for r in spark.read.parquet(file).select("row_key").collect()]
        assert keys == sorted(keys)


def test_several_puts_in_one_load_and_no_puts(spark, tmp_path):
    root = str(tmp_path)
    load_cells(cells(spark, []), root, ranges=4)
    assert read_loaded_cells(spark, root).collect() == []
    with pytest.raises(Exception, match="several puts"):
        load_cells(cells(spark, [(b"a", "x", b"1"), (b"a", "x", b"2")]), root)
    assert load_cells(cells(spark, [(b"a", "x", b"1")]), root) == 2

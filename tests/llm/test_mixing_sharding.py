from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from odd import empty, odd_documents, rng  # noqa: F401
from pyspark.sql import functions as F

from docloom.llm import mixing, sharding


def by_hand(sizes: dict, weights: list[float], most: int) -> dict:
    """Targets by sharing out again and again what full sources leave."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = [s for s in names if s not in full]
        target = {s: most * sizes[s] for s in full} | {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("counts", [[5, 1, 1, 40], [1, 1, 200, 3, 50, 2, 2], [10], [1, 100, 1, 1, 1]])
def test_mix_meets_targets(spark, rng, counts):
    rows = [
        (i * 1000 + j, "w " * rng.randrange(1, 60), f"s{i}" if i else None) for i, n in enumerate(counts) for j in range(n * 8)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", mixing.words(F.col("text")))
    got = mixing.mix(docs, [5, 2, 1]).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    want = by_hand(dict(sizes), [5, 2, 1], 3)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 3
        assert r.target == pytest.approx(want[r.source])
        assert r.source_size == sizes[r.source]
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * largest[s]
    again = {(r.doc_id, r.copies) for r in mixing.mix(docs.repartition(7), [5, 2, 1]).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}


def test_mix_repeats_rows(spark):
    docs = spark.createDataFrame([(i, f"s{i % 2}", 10) for i in range(40)], "doc_id long, source string, size long")
    mixed = mixing.mix(docs, [5, 1])
    copies = {r.doc_id: r.copies for r in mixed.collect()}
    out = mixing.repeated(mixed, ["doc_id", "source"]).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in out} == {k: n for k, n in copies.items() if n}


def test_words_follow_ascii_white_space(spark):
    texts = [("a b\tc\r\nd\x0b\x0ce",), ("",), (None,), (" x y",), ("  ",)]
    got = spark.createDataFrame(texts, "t string").select(mixing.words(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [5, 0, 0, 2, 0]


def test_shards_are_equal_contiguous_and_whole(spark, rng):
    rows = [(i, rng.choice(["same", "other " * 3, "x" * rng.randrange(300)])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", sharding.text_key(F.col("text")).alias("text_key"), sharding.byte_size(F.col("text")).alias("size")
    )
    got = sharding.shard(docs, 4).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(rows)
    total = sum(len(t) + 1 for _, t in rows)
    for s in range(4):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 4) <= 2 * 301 + 0.02 * total / 4
    where = {(r["shard"], r.slot): (r.text_key, r.doc_id) for r in got}
    assert [where[k] for k in sorted(where)] == sorted(where.values())


def test_small_groups_are_not_parted(spark):
    rows = [(i, f"text {i // 3} " * 4) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", sharding.text_key(F.col("text")).alias("text_key"), sharding.byte_size(F.col("text")).alias("size")
    )
    got = sharding.shard(docs, 7, whole=0.05)
    assert got.groupBy("text_key").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    assert got.select("shard").distinct().count() == 7


def test_a_huge_group_is_cut(spark):
    rows = [(i, "copy") for i in range(500)] + [(1000 + i, f"t{i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", sharding.text_key(F.col("text")).alias("text_key"), sharding.byte_size(F.col("text")).alias("size")
    )
    counts = {r["shard"]: r["count"] for r in sharding.shard(docs, 8).groupBy("shard").count().collect()}
    assert len(counts) == 8
    assert max(counts.values()) <= 1.3 * min(counts.values())


def test_odd_rows(spark, odd_documents):
    sized = odd_documents.drop("size", "key").select(
        "*", mixing.words(F.col("text")).alias("size"), sharding.text_key(F.col("text")).alias("text_key")
    )
    mixed = mixing.mix(sized, [2, 1])
    assert mixed.count() == odd_documents.count()
    assert all(r["size"] == 0 or 0 <= r.copies <= 3 for r in mixed.collect())
    cut = sharding.shard(sized, 3).collect()
    assert sorted(c for r in cut for c in [r["shard"]]) == sorted(r["shard"] for r in cut)
    assert len(cut) == odd_documents.count()
    assert {r.row for r in cut} == {"mine"}
    none = empty(spark).select("*", F.lit(1).alias("size"), F.lit("k").alias("text_key"))
    assert mixing.mix(none, [1]).count() == 0
    assert sharding.shard(none, 3).count() == 0


def test_query_rows(spark, sf_dir):
    from docloom.llm.queries import op6_shard

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op6_shard(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")


def test_words_taken_miss_a_target_by_less_than_the_longest_document(spark, rng):  # noqa: F811
    """In order of size, the copies of a stretch are off by less than one, so the words are by less than the largest size."""
    rows = [(i, f"s{i % 7}", rng.choice([0, 1, 3, 20, 400, 5000])) for i in range(600)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long"), [5.0, 2.0, 1.0]).collect()
    taken, longest, target = defaultdict(int), defaultdict(int), {}
    for r in mixed:
        taken[r.source] += r.copies * r["size"]
        longest[r.source] = max(longest[r.source], r["size"])
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= longest[s] + 1

"""Mixing sources to target weights: systematic sampling along prefix sums of expected copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import in_order, with_columns, with_row_number

#: Expected copies are counted in these parts of a copy, so prefix sums are exact integers.
_PART_BITS = 20
_PARTS = 1 << _PART_BITS


def words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], most: int) -> DataFrame:
    """
    ``source, source_size, weight, target`` from ``source, source_size``.

    Weights repeat along the sources in code-point order, null last. All sizes together are shared out by weight; no
    target exceeds ``most`` times its source's size. In order of that limit per weight, let the sources before one be full;
    what they leave over the weights that remain is a level, which rises until the next source would not fill up and
    falls after that: the highest is the one to use. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rated = sizes.select("*", weight.alias("weight")).withColumn("limit", F.col("source_size") * most)
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = rated.withColumn("level", left / open_weight)
    level = F.max("level").over(everything)
    target = F.least(F.col("limit").cast("double"), F.col("weight") * level)
    return levels.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(
    sized: DataFrame,
    weights: list[float],
    most: int = 3,
    source: str = "source",
    size: str = "size",
    doc_id: str = "doc_id",
    seed: str = "mix",
) -> DataFrame:
    """
    Every row with ``copies`` (how often the mix holds it), ``source_size`` and ``target``; ``size`` names its words.

    A source's documents all expect target / size copies. In each source they stand in order of size (then id), and a
    document gets a copy for each whole number that its stretch of the prefix sum, moved by one random offset per
    source, passes. By size, neighbours are alike, so the words taken come near the target. The offset depends on
    ``seed`` and the source only: reruns agree.

    A null size is 0; a null source is a source of its own and comes last. Documents without words take copies
    like others of their source, none if their source has no words at all. Repeated rows are rows; between rows equal in
    id and size it is not said which gets the copy. An empty table stays empty. Input columns named like the new ones
    give way to them; others are kept.

    A source of any size is spread over partitions of equal rows; a row's place in its source is its place in the whole
    order less that of the source's first row.
    """
    rows = sized.select(
        F.struct("*").alias("row"),
        F.col(source).alias("source"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"),
        F.col(doc_id).alias("id"),
    )
    placed = in_order(rows, ["source", "size", "id"], "mix")
    numbered = with_row_number(placed, "place")
    of_source = numbered.groupBy("source").agg(F.min("place").alias("first_place"), F.sum("size").alias("source_size"))
    targets = source_targets(of_source.select("source", "source_size"), weights, most)
    starts = of_source.select(F.col("source").alias("s"), "first_place")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * _PARTS)).otherwise(0)
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))), 1, 5), 16, 10)
    plan = targets.join(starts, F.col("source").eqNullSafe(F.col("s"))).select(
        "s", "source_size", "target", "first_place", rate.cast("long").alias("rate"), drawn.cast("long").alias("offset")
    )
    joined = numbered.join(plan, F.col("source").eqNullSafe(F.col("s")))
    passed = lambda n: F.shiftright(F.col("offset") + F.col("rate") * n, _PART_BITS)
    number = F.col("place") - F.col("first_place")
    return with_columns(
        "row",
        joined.withColumn("number", number).withColumn("taken", passed(F.col("number") + 1) - passed(F.col("number"))),
        source_size=F.col("source_size"),
        target=F.col("target"),
        copies=F.col("taken"),
    )


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says."""
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.select(*columns, times.alias("copy_no")).select(*columns)

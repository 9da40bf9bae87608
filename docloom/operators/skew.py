"""Groups too large for one task: find them, cut them into ordered segments, number their rows.

A window over a group puts the group into one task. That is right for ordinary groups. A group that may
hold a large share of all rows is cut at fixed boundaries of its order column, so that every segment is
one task's work and only one summary row per segment has to be combined afterwards. All rows are kept;
sampling is used only to detect such groups and to choose the boundaries.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_GROUP_ROWS = 2_000_000  # rows of one group that one task may sort
PARTITION_ROWS = 500_000  # rows that one task of a large shuffle gets
MAX_BROADCAST_ROWS = 10_000  # rows of a driver-side table that is broadcast; a longer one is joined by shuffle
_SAMPLES_PER_SEGMENT = 16
_FINE = 64


@dataclass(frozen=True)
class GroupProfile:
    """Row count of a table and its oversized groups with estimated row counts."""

    rows: int
    group_limit: int
    hot: dict[Any, int] = field(default_factory=dict)


def row_bytes(df: DataFrame) -> str:
    """SQL for the size of a row: text and binary by length, nested values by their JSON text, plus 16
    per column and row."""
    lengths = [f"{16 * (1 + len(df.columns))}L"]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            lengths.append(f"coalesce(octet_length(`{f.name}`), 0)")
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            lengths.append(f"coalesce(octet_length(to_json(`{f.name}`)), 0)")
    return " + ".join(lengths)


def fits_broadcast(df: DataFrame, limit: int, rows: int | None = None) -> bool:
    """Whether the data of ``df`` measures at most ``limit`` bytes; a limit of 0 asks nothing.

    With a known row count, the bytes are summed only if so many rows could fit at all.
    """
    if limit <= 0 or (rows is not None and rows * 16 * (1 + len(df.columns)) > limit):
        return False
    return (df.agg(F.expr(f"sum({row_bytes(df)}) AS b")).first()["b"] or 0) <= limit


def profile_groups(
    df: DataFrame,
    group: str,
    order: str | None = None,
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
    streamed: bool = False,
) -> GroupProfile:
    """Measure a table before choosing how to process it (runs one or two narrow aggregations).

    A group is oversized beyond ``max_group_rows`` rows, whatever the size of the table, so what one task gets
    does not grow with it. There are at most ``2 * rows / max_group_rows`` such groups. Detection counts a sample: a fixed one by hash where ``order``
    tells the rows of a group apart, else a random one, since copies of one row share their hash. A table
    with no more rows than the limit needs no second pass.

    The groups and their segments are tables on the driver. Where tasks only stream and sort the rows of a group
    (``streamed``), the limit is therefore never below ``4 * rows / MAX_BROADCAST_ROWS``: groups and segments are then at
    most ``MAX_BROADCAST_ROWS``, however many small groups a low ``max_group_rows`` calls oversized.
    """
    rows = df.count()
    limit = max(max_group_rows, 4 * rows // MAX_BROADCAST_ROWS) if streamed else max_group_rows
    if rows <= limit:
        return GroupProfile(rows, limit)
    every = max(1, limit // 1000)
    if order is None:
        sample = df.select(group).sample(fraction=1 / every, seed=1)
    else:
        sample = df.where(_in_sample(F.lit(every), group, order))
    counted = sample.groupBy(group).count()
    found = counted.where(F.col("count") * every > limit // 2).collect()
    return GroupProfile(rows, limit, {r[group]: r["count"] * every for r in found})


def _in_sample(every: Column, *names: str) -> Column:
    return F.pmod(F.xxhash64(*names), every.cast("bigint")) == 0


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A table of driver-side rows, one per oversized group or segment; broadcast if they are few."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= MAX_BROADCAST_ROWS else table


def hot_table(df: DataFrame, group: str, profile: GroupProfile) -> DataFrame:
    """The oversized groups of a profile as a broadcast table of one column."""
    schema = T.StructType().add(group, df.schema[group].dataType)
    return local_table(df.sparkSession, [(key,) for key in profile.hot], schema)


def segment_bounds(df: DataFrame, group: str, order: str, profile: GroupProfile) -> DataFrame:
    """Boundaries ``(group, _coarse, _fine)`` of every oversized group, as a small broadcast table.

    The boundaries are quantiles of a hash sample of the order column, collected once (about one for
    ``group_limit / 2`` rows of an oversized group), so every later pass cuts at the same places.
    """
    spark = df.sparkSession
    group_type, order_type = df.schema[group].dataType, df.schema[order].dataType
    plan = []
    for key, estimate in profile.hot.items():
        segments = -(-2 * estimate // profile.group_limit)
        plan.append((key, segments, max(1, estimate // (segments * _SAMPLES_PER_SEGMENT))))
    schema = (
        T.StructType().add(group, group_type).add("_segments", T.IntegerType()).add("_every", T.LongType())
    )
    sample = (
        df.select(group, order)
        .join(_named(local_table(spark, plan, schema), group), _same(group))
        .drop("_of_group")
        .where(_in_sample(F.col("_every"), group, order))
        .groupBy(group)
        .agg(F.sort_array(F.collect_list(order)).alias("_s"), F.first("_segments").alias("_segments"))
    )
    cut = F.transform(
        F.when(F.col("_segments") > 1, F.sequence(F.lit(1), F.col("_segments") - 1)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.element_at(
            "_s", F.greatest((F.size("_s") * i / F.col("_segments")).cast("int"), F.lit(1))
        ),
    )
    rows = []
    for r in sample.select(group, F.array_sort(F.array_distinct(cut)).alias("b")).collect():
        bounds = r["b"]
        rows.append((r[group], bounds[_FINE - 1 :: _FINE], bounds))
    out = (
        T.StructType()
        .add(group, group_type)
        .add("_coarse", T.ArrayType(order_type))
        .add("_fine", T.ArrayType(order_type))
    )
    return local_table(spark, rows, out)


def _named(table: DataFrame, group: str) -> DataFrame:
    return table.withColumnRenamed(group, "_of_group")


def _same(group: str) -> Column:
    """Equality of groups under which null is a group too."""
    return F.col(group).eqNullSafe(F.col("_of_group"))


def segment_number(order: str) -> Column:
    """Segment of a row joined with :func:`segment_bounds`: how many boundaries lie below it.

    Two short scans (every 64th boundary, then the 64 after it) replace one long one.
    """
    value = F.col(order)
    coarse = F.size(F.filter("_coarse", lambda b: b < value))
    near = F.slice("_fine", coarse * _FINE + 1, F.lit(_FINE))
    return F.coalesce(coarse * _FINE + F.size(F.filter(near, lambda b: b < value)), F.lit(0))


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Shuffle ``df`` by ``keys`` into tasks of about ``PARTITION_ROWS`` rows, given the rows that meet there.

    Narrow rows compress well, and shuffles that Spark cuts by bytes then put millions of them into one task. Tables that
    give no more than ``PARTITION_ROWS`` to each core are left to Spark.
    """
    tasks = -(-rows // PARTITION_ROWS)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def number_rows(
    df: DataFrame,
    group: str,
    order: str,
    *,
    name: str = "row_no",
    max_group_rows: int = MAX_GROUP_ROWS,
    profile: GroupProfile | None = None,
) -> DataFrame:
    """Add the 0-based row number within ``group`` by ascending ``order`` (unique within the group).

    Ordinary groups use a window. If the profile finds oversized groups, rows are numbered within
    ``(group, segment)`` and shifted by the counts of the earlier segments. A known ``profile`` is not taken again.
    """
    if profile is None:
        profile = profile_groups(df.select(group, order), group, order, max_group_rows=max_group_rows, streamed=True)
    if not profile.hot:
        in_group = Window.partitionBy(group).orderBy(order)
        return df.withColumn(name, (F.row_number().over(in_group) - 1).cast("bigint"))

    spark = df.sparkSession
    bounds = _named(segment_bounds(df, group, order, profile), group)
    earlier = Window.partitionBy(group).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    # One row per segment of an oversized group: bounded by the number of boundaries.
    starts = (
        df.select(group, order)
        .join(bounds, _same(group))
        .groupBy(group, segment_number(order).alias("_segment"))
        .count()
        .select(group, "_segment", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    )
    schema = (
        T.StructType()
        .add(group, df.schema[group].dataType)
        .add("_segment", T.IntegerType())
        .add("_start", T.LongType())
    )
    starts = _named(local_table(spark, [tuple(r) for r in starts.collect()], schema), group)
    starts = starts.withColumnRenamed("_segment", "_of_segment")
    in_segment = Window.partitionBy(group, "_segment").orderBy(order)
    return (
        df.join(bounds, _same(group), "left")
        .withColumn("_segment", F.when(F.col("_fine").isNull(), 0).otherwise(segment_number(order)))
        .drop("_coarse", "_fine", "_of_group")
        .withColumn(name, (F.row_number().over(in_segment) - 1).cast("bigint"))
        .join(starts, _same(group) & (F.col("_segment") == F.col("_of_segment")), "left")
        .withColumn(name, F.col(name) + F.coalesce("_start", F.lit(0).cast("bigint")))
        .drop("_segment", "_start", "_of_group", "_of_segment")
    )


def running_total(df: DataFrame, order: str, value: str, *, name: str, block: int = 4096) -> DataFrame:
    """Add the sum of ``value`` over all smaller ``order`` (a non-negative integer, unique).

    Blocks of consecutive order values are summed first, so no task sees more than one block of rows or
    the list of block sums.
    """
    blocks = df.withColumn("_block", F.floor(F.col(order) / block))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        blocks.groupBy("_block")
        .agg(F.sum(value).alias("_sum"))
        .select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocks.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(sums, "_block")
        .withColumn(name, F.col("_base") + F.col("_in"))
        .drop("_block", "_in", "_base")
    )

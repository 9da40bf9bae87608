"""Sharding: contiguous shards of equal bytes, cut along a global prefix sum of sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import in_order, with_columns, with_totals_before


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, and one for the end of the row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_key(text: Column) -> Column:
    """Equal for equal texts; null and empty text are equal."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def shard(
    rows: DataFrame, shards: int, size: str = "size", group: str = "text_key", doc_id: str = "doc_id", whole: float = 0.01
) -> DataFrame:
    """
    Every row with ``shard`` and ``slot``, its place in the shard from 0; ``size`` and ``group`` name columns of ``rows``.

    The rows stand in one global order, by group and then by id, so a group (equal texts, by ``text_key``) stands
    together. The bytes before a row are a running sum in its partition plus the totals of the partitions before; shard
    s starts where they reach s / shards of all bytes. A group that such a cut would part goes whole to the side that
    holds more of it, if it has at most the share ``whole`` of one shard's bytes; larger groups are cut like any rows.
    At most ``shards - 1`` groups lie on a cut, and only they are looked at.

    Rows alike in group and id stand next to each other in no said order. An empty table stays empty; with fewer rows
    than shards some shards are empty. Null sizes count as 0, null groups and ids are values like others and come first.
    Input columns named ``shard`` or ``slot`` give way to the new ones; others are kept.
    """
    keyed = rows.select(
        F.struct("*").alias("row"),
        F.col(group).alias("grp"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("bytes"),
        F.col(doc_id).alias("id"),
    )
    placed = in_order(keyed, ["grp", "id"], "shard")
    before = with_totals_before(placed.drop("row", "id"), {"bytes_before": F.col("bytes"), "rows_before": F.lit(1)})
    before = before.select("at", "grp", "bytes", "bytes_before", "rows_before")
    total = max(placed.agg(F.sum("bytes").alias("total")).first().total or 0, 1)
    share = total / shards
    by_bytes = lambda c: F.expr(f"least(({c}) * {shards}L div {total}L, {shards - 1}L)")
    groups = before.groupBy("grp").agg(
        F.min("bytes_before").alias("start"), F.max(F.col("bytes_before") + F.col("bytes")).alias("end")
    )
    on_cut = (
        groups.select("*", by_bytes("start").alias("low"), by_bytes("end - 1").alias("high"))
        .where((F.col("low") < F.col("high")) & (F.col("end") - F.col("start") <= whole * share))
        .select(
            F.col("grp").alias("whole_grp"),
            F.when(F.col("high") * share - F.col("start") >= F.col("end") - F.col("high") * share, F.col("low"))
            .otherwise(F.col("high"))
            .alias("whole_shard"),
        )
    )
    cut = before.join(F.broadcast(on_cut), F.col("grp").eqNullSafe(F.col("whole_grp")), "left")
    cut = cut.select("at", "rows_before", F.coalesce("whole_shard", by_bytes("bytes_before")).cast("int").alias("to"))
    firsts = cut.groupBy(F.col("to").alias("of_shard")).agg(F.min("rows_before").alias("first_row"))
    slots = cut.join(F.broadcast(firsts), F.col("to") == F.col("of_shard")).select(
        F.col("at").alias("of_row"), "to", (F.col("rows_before") - F.col("first_row")).alias("place")
    )
    joined = placed.join(slots, F.col("at") == F.col("of_row"))
    return with_columns("row", joined, shard=F.col("to"), slot=F.col("place"))

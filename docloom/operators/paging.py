"""Pages of view rows, and batches of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.skew import MAX_GROUP_ROWS, number_rows, running_total


def page_rows(
    rows: DataFrame,
    page_size: int = 1024,
    *,
    key_ord: str = "key_ord",
    order: str = "doc_id",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Cut the rows of each listed key into pages of ``page_size`` in ID order.

    Adds ``page_in_key`` and ``page_no``, which counts on over all keys in list order. The page numbers
    come from per-key row counts (one row per key), never from a window over all rows.
    """
    if page_size < 1:
        raise ValueError("page_size must be at least 1")
    per_key = rows.groupBy(key_ord).count().select(
        key_ord, F.ceil(F.col("count") / page_size).alias("_pages")
    )
    first_page = running_total(per_key, key_ord, "_pages", name="_first_page").select(key_ord, "_first_page")
    numbered = number_rows(rows, key_ord, order, name="_row", max_group_rows=max_group_rows)
    return (
        numbered.withColumn("page_in_key", F.floor(F.col("_row") / page_size))
        .join(first_page, key_ord)
        .withColumn("page_no", F.col("_first_page") + F.col("page_in_key"))
        .drop("_row", "_first_page")
    )


def assign_batches(
    df: DataFrame, lane: str, order: str, batch_size: int = 1024, *, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add ``batch_id``: within each lane, batches of at most ``batch_size`` rows by ``order``."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    numbered = number_rows(df, lane, order, name="_row", max_group_rows=max_group_rows)
    return numbered.withColumn("batch_id", F.floor(F.col("_row") / batch_size)).drop("_row")

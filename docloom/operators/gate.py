"""Accept a run although a small share of it failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class FailedShareExceeded(RuntimeError):
    """More of a run failed than was allowed."""


def failed_share(df: DataFrame, chunk: str, failed: Column) -> DataFrame:
    """``(chunk, n_rows, n_failed, failed_share)`` per chunk."""
    return (
        df.groupBy(chunk)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(failed).alias("n_failed"))
        .withColumn("failed_share", F.col("n_failed") / F.col("n_rows"))
    )


def require_failed_share(shares: DataFrame, max_failed_share: float = 0.05, *, unit: str = "row") -> float:
    """Return the failed share of the whole run, or raise if it is above ``max_failed_share``.

    ``unit="row"`` weighs rows, ``unit="chunk"`` counts chunks with any failure.
    """
    if unit == "row":
        share = F.try_divide(F.sum("n_failed"), F.sum("n_rows"))
    elif unit == "chunk":
        share = F.try_divide(F.count_if(F.col("n_failed") > 0), F.count(F.lit(1)))
    else:
        raise ValueError("unit must be 'row' or 'chunk'")
    found = shares.agg(share.alias("share")).first()["share"] or 0.0
    if found > max_failed_share:
        raise FailedShareExceeded(f"{found:.2%} of {unit}s failed, allowed are {max_failed_share:.2%}")
    return found

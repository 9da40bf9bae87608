"""Counters and profiles of a run, computed from its result tables (exact under task retries)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.operators import apply as P

# Counter names.
FAILED_STORE_OPERATIONS = "FAILED_STORE_OPERATIONS"
EXISTENT_KEYS = "EXISTENT_KEYS"
NON_EXISTENT_TOUCHED_KEYS = "NON_EXISTENT_TOUCHED_KEYS"
LINES_WITH_WRONG_COLUMNS_COUNT = "LINES_WITH_WRONG_COLUMNS_COUNT"
TIMEOUT_OPERATIONS = "TIMEOUT_OPERATIONS"
TOTAL_TIMEOUT = "TOTAL_TIMEOUT"
EXP_BACKOFF_COUNT_FOR_TRY = "EXP_BACKOFF_COUNT_FOR_TRY_"
BULKS_COUNT = "BULKS_COUNT"
BULK_SIZES_SUM = "BULK_SIZES_SUM"

# Statuses of a store client.
SUCCESS, TIMED_OUT, TEMPORARY_FAILURE = "Success", "Timed out", "Temporary failure"


def as_counters(df: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """One aggregation of ``df`` as rows ``(counter, value)``."""
    one_row = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in counters.items()])
    pairs = [F.struct(F.lit(name).alias("counter"), F.col(name).alias("value")) for name in counters]
    return one_row.select(F.inline(F.array(*pairs)))


def outcome_counters(outcomes: DataFrame) -> DataFrame:
    """Failed operations, present keys that blocked an ADD, touched keys that were absent."""
    outcome = F.col("outcome")
    return as_counters(
        outcomes,
        {
            FAILED_STORE_OPERATIONS: F.count_if(outcome.isin(P.ALREADY_EXISTS, P.MISSING)),
            EXISTENT_KEYS: F.count_if(outcome == P.ALREADY_EXISTS),
            NON_EXISTENT_TOUCHED_KEYS: F.count_if((F.col("op") == A.TOUCH) & (outcome == P.MISSING)),
        },
    )


def update_counters(summary: DataFrame) -> DataFrame:
    """The same counters from the per-key summary of an update."""
    return as_counters(
        summary,
        {
            FAILED_STORE_OPERATIONS: F.sum(F.col("already_exists") + F.col("missing")),
            EXISTENT_KEYS: F.sum("already_exists"),
            NON_EXISTENT_TOUCHED_KEYS: F.sum("missing_touched"),
        },
    )


def reject_counters(rejects: DataFrame) -> DataFrame:
    return as_counters(
        rejects, {LINES_WITH_WRONG_COLUMNS_COUNT: F.count_if(F.col("reject_reason").isNotNull())}
    )


def attempt_counters(attempts: DataFrame) -> DataFrame:
    """Failed attempts (every retry counts), timeouts and summed waits of a push."""
    status = F.col("status")
    failed = status != SUCCESS
    return as_counters(
        attempts,
        {
            FAILED_STORE_OPERATIONS: F.count_if(failed),
            EXISTENT_KEYS: F.count_if(failed & status.contains("exists")),
            NON_EXISTENT_TOUCHED_KEYS: F.count_if(failed & (F.col("op") == A.TOUCH)),
            TIMEOUT_OPERATIONS: F.count_if(status == TIMED_OUT),
            TOTAL_TIMEOUT: F.sum("wait_ms"),
        },
    )


def retry_profile(attempts: DataFrame) -> DataFrame:
    """Retries made per try number, as ``(counter, value)`` rows; try numbers never used have no row."""
    return (
        attempts.where(F.col("try_no") > 0)
        .groupBy("try_no")
        .count()
        .select(
            F.concat(F.lit(EXP_BACKOFF_COUNT_FOR_TRY), F.col("try_no")).alias("counter"),
            F.col("count").alias("value"),
        )
    )


def failed_records(attempts: DataFrame) -> DataFrame:
    """Records whose last attempt failed, next to the attempt counts above."""
    last = attempts.groupBy("doc_id", "seq").agg(F.max_by("status", "try_no").alias("status"))
    return as_counters(last, {"FAILED_RECORDS": F.count_if(F.col("status") != SUCCESS)})


def batch_sizes(df: DataFrame, lane: str, batch_size: int = 1024) -> DataFrame:
    """``(lane, batches, rows)``: how many lookups of at most ``batch_size`` keys each lane needs."""
    return df.groupBy(lane).agg(F.count(F.lit(1)).alias("rows")).select(
        lane, F.ceil(F.col("rows") / batch_size).alias("batches"), "rows"
    )


def batch_counters(df: DataFrame, lane: str, batch_size: int = 1024) -> DataFrame:
    return as_counters(
        batch_sizes(df, lane, batch_size), {BULKS_COUNT: F.sum("batches"), BULK_SIZES_SUM: F.sum("rows")}
    )


def import_profile(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``(chunk_id, n_keys, n_rows)`` of an import; chunks whose keys found nothing have 0 rows."""
    found = rows.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_rows"))
    planned = keys.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_keys"))
    return planned.join(found, "chunk_id", "left").select(
        "chunk_id", "n_keys", F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows")
    )

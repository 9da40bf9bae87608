"""Expiry, epoch dates and the retry wait schedule. Nothing here reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_sql(as_of: dt.datetime | str) -> str:
    """SQL for a moment; naive datetimes and texts without zone are UTC."""
    moment = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return f"timestamp_micros({micros}L)"


def expires_sql(expiry: str, as_of: str) -> str:
    """SQL for the expiry moment: ``expiry`` seconds after ``as_of``, null (never) for 0 and null."""
    return f"CASE WHEN {expiry} > 0 THEN timestamp_micros(unix_micros({as_of}) + {expiry} * 1000000L) END"


def live_sql(expires_at: str, as_of: str) -> str:
    """SQL that is true for a document that never expires or expires after ``as_of``."""
    return f"({expires_at} IS NULL OR {expires_at} > {as_of})"


def epoch_yyyymmdd(epoch_seconds: Column) -> Column:
    """UTC calendar day of a UNIX time as ``yyyyMMdd`` text, whatever the session time zone is."""
    days = F.floor(epoch_seconds.cast("bigint") / 86400).cast("int")
    return F.date_format(F.date_from_unix_date(days), "yyyyMMdd")


def second_of_minute(epoch_seconds: Column) -> Column:
    return F.pmod(epoch_seconds.cast("bigint"), F.lit(60).cast("bigint"))


def backoff_wait_ms(try_no: Column, max_wait_ms: int = 1000) -> Column:
    """Wait before retry number ``try_no`` (from 0): ``min(2^try_no, max_wait_ms)`` milliseconds."""
    capped = F.least(try_no.cast("int"), F.lit(31))
    return F.least(F.call_function("shiftleft", F.lit(1).cast("bigint"), capped), F.lit(max_wait_ms).cast("bigint"))


def backoff_schedule(tries: Column, max_wait_ms: int = 1000) -> Column:
    """Array with the waits of the first ``tries`` retries."""
    n = F.greatest(tries.cast("int"), F.lit(0))
    numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda i: backoff_wait_ms(i, max_wait_ms))

"""Keyed actions: an operation, a value and an expiry as one struct column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The operation names.
SET, ADD, REPLACE, APPEND, PREPEND = "SET", "ADD", "REPLACE", "APPEND", "PREPEND"
DELETE, TOUCH, EXISTS, NONE = "DELETE", "TOUCH", "EXISTS", "NONE"
OPERATIONS = (SET, ADD, REPLACE, APPEND, PREPEND, DELETE, TOUCH, EXISTS, NONE)
UNARY_OPERATIONS = (DELETE, TOUCH)


def parse_operation(op: str | None) -> str:
    """Strict operation name; a missing one means SET, and EXISTS is an old name of TOUCH."""
    if op is None:
        return SET
    if op not in OPERATIONS:
        raise ValueError(f"unknown operation {op!r}; use one of {', '.join(OPERATIONS)}")
    return TOUCH if op == EXISTS else op


def parse_expiry(expiry: int | str | None) -> int:
    """Strict expiry in seconds; a missing one means 0, that is never."""
    if expiry is None:
        return 0
    try:
        seconds = int(expiry)
    except ValueError as e:
        raise ValueError(f"expiry {expiry!r} is not an integer") from e
    if not 0 <= seconds < 2**31:
        raise ValueError(f"expiry {expiry!r} must be an int that is not negative")
    return seconds


def action(op: Column | str, value: Column | str | None = None, expiry: Column | int = 0) -> Column:
    """``struct(op, value, expiry)``; texts for ``op`` and ``value`` are literals."""
    op = op if isinstance(op, Column) else F.lit(parse_operation(op))
    value = value if isinstance(value, Column) else F.lit(value)
    expiry = expiry if isinstance(expiry, Column) else F.lit(parse_expiry(expiry))
    return F.struct(
        op.cast("string").alias("op"), value.cast("string").alias("value"), expiry.cast("int").alias("expiry")
    )


def set_(value: Column | str, expiry: Column | int = 0) -> Column:
    return action(SET, value, expiry)


def add(value: Column | str, expiry: Column | int = 0) -> Column:
    return action(ADD, value, expiry)


def replace(value: Column | str, expiry: Column | int = 0) -> Column:
    return action(REPLACE, value, expiry)


def append(value: Column | str) -> Column:
    return action(APPEND, value)


def prepend(value: Column | str) -> Column:
    return action(PREPEND, value)


def delete() -> Column:
    return action(DELETE)


def touch(expiry: Column | int = 0) -> Column:
    return action(TOUCH, None, expiry)


def exists() -> Column:
    """Old name of :func:`touch` without expiry; it clears the expiry of a present key."""
    return touch(0)


def none() -> Column:
    return action(NONE)

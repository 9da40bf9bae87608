"""Delimited text as a source of keyed actions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.functions.text import field_count, split_fields, unescape_text

WRONG_COLUMN_COUNT = "wrong_column_count"


@dataclass(frozen=True)
class ParsedLines:
    """``actions(doc_id, seq, op, value, expiry)`` and ``rejects(line, reject_reason)`` of one input."""

    parsed: DataFrame

    @property
    def actions(self) -> DataFrame:
        good = self.parsed.where(F.col("reject_reason").isNull())
        return good.select("doc_id", "seq", "op", "value", "expiry")

    @property
    def rejects(self) -> DataFrame:
        return self.parsed.where(F.col("reject_reason").isNotNull()).select("line", "reject_reason")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files as ``(line, seq)``; ``seq`` rises with the place of the line in its file split.

    The text reader does not interpret quotes, so a line is exactly what the file holds.
    """
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.monotonically_increasing_id().alias("seq")
    )


def parse_action_lines(
    lines: DataFrame,
    op: str | None = None,
    expiry: int | str | None = None,
    *,
    delimiter: str = "\t",
    literal: bool = False,
    escaped: bool = False,
) -> ParsedLines:
    """Parse ``lines(line, seq)``: field 0 is the key, field 1 the value, further fields are ignored.

    ``delimiter`` is a regular expression unless ``literal``. DELETE and TOUCH need one field, the other
    operations two; trailing empty fields do not count. Lines with too few fields become rejects.
    ``escaped`` undoes the escaping of the key-value text sink.
    """
    op, expiry = A.parse_operation(op), A.parse_expiry(expiry)
    needed = 1 if op in A.UNARY_OPERATIONS else 2
    parts = split_fields(F.col("line"), delimiter, literal=literal)
    split = lines.select("line", "seq", parts.alias("_parts"))
    n = field_count(F.col("_parts"))
    undo = unescape_text if escaped else (lambda c: c)
    return ParsedLines(
        split.select(
            "line",
            "seq",
            undo(F.col("_parts")[0]).alias("doc_id"),
            F.lit(op).alias("op"),
            F.when(n >= 2, undo(F.get("_parts", F.lit(1)))).alias("value"),
            F.lit(expiry).alias("expiry"),
            F.when(n < needed, F.lit(WRONG_COLUMN_COUNT)).alias("reject_reason"),
        )
    )

"""Delimited text: field splitting, arity, escaping and UTF-8 bytes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_fields(line: Column, delimiter: str = "\t", *, literal: bool = False) -> Column:
    """Split on a regular expression (or a literal text), keeping every field."""
    return F.split(line, re.escape(delimiter) if literal else delimiter, -1)


def field_count(parts: Column) -> Column:
    """How many fields count: trailing empty ones do not, but an undelimited line is always one field."""
    last_filled = F.array_max(F.transform(parts, lambda p, i: F.when(p != "", i + 1).otherwise(F.lit(0))))
    return F.when(F.size(parts) == 1, F.lit(1)).otherwise(last_filled)


def escape_text(value: Column) -> Column:
    """Backslash-escape backslash, tab, newline and carriage return, so one record is one line."""
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for char, code in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(char), F.lit(code))
    return out


def unescape_text(value: Column) -> Column:
    """Inverse of :func:`escape_text`.

    Cutting at the escaped backslash first leaves pieces in which every remaining escape is unambiguous.
    """

    def plain(piece: Column) -> Column:
        for char, code in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            piece = F.replace(piece, F.lit(code), F.lit(char))
        return piece

    pieces = F.split(value, r"\\\\", -1)
    return F.array_join(F.transform(pieces, plain), "\\")


def utf8(value: Column) -> Column:
    return F.encode(value, "UTF-8")

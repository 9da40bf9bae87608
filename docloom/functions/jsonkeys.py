"""JSON view keys and JSON documents.

``*_sql`` functions take a column name or SQL expression and return SQL, in which one-element arrays bind a
value that is needed several times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that is its own canonical form: a string without escapes, a short integer, or an array of those.
_PLAIN_ITEM = r'(?:"[^"\\\x00-\x1f]*+"|0|-?[1-9]\d{0,17})'
_PLAIN_KEY = rf"\A(?:{_PLAIN_ITEM}|\[{_PLAIN_ITEM}(?:,{_PLAIN_ITEM})*+\])\z"
_MAYBE_JSON = r'\A\s*(?:[\[{"\-0-9]|true|false|null)'


# The parser stops after one value and does not look at what follows it. Parsed as the first item of an array
# whose second item is this mark, text counts as JSON only if it is one value and nothing else.
_MARK = "docloom-end-of-value"


def _strict_sql(raw: str, then: str) -> str:
    """SQL: ``then`` over the parsed variant array ``v`` if ``raw`` is exactly one JSON value, else null.

    Text that holds the mark itself is checked by closing it as an array and as an object: only a whole
    value survives both.
    """
    marked = f"""transform(array(try_parse_json(concat('[', {raw}, ',"{_MARK}"]'))), v ->
        if(try_variant_get(v, '$[1]', 'string') = '{_MARK}', {then}, NULL))[0]"""
    closed_twice = f"""transform(array(try_parse_json(concat('[', {raw}, ']'))), v ->
        if(v IS NOT NULL AND try_variant_get(v, '$[1]', 'variant') IS NULL
           AND try_parse_json(concat('{{"a":', {raw}, '}}')) IS NOT NULL
           AND try_parse_json({raw}) IS NOT NULL, {then}, NULL))[0]"""
    return f"if(contains({raw}, '{_MARK}'), {closed_twice}, {marked})"


def canonical_key_sql(raw: str) -> str:
    """SQL for one spelling per JSON value, so that equal keys are equal strings.

    White space and object member order are normalised. Text that is not JSON is kept as it is, because
    a plain word is a legal key too. Only text that needs it is parsed.
    """
    written = _strict_sql("text", "to_json(try_variant_get(v, '$[0]', 'variant'))")
    return f"""transform(array({raw}), text ->
        CASE WHEN text RLIKE r'{_PLAIN_KEY}' OR NOT text RLIKE r'{_MAYBE_JSON}' THEN text
             ELSE coalesce({written}, text) END)[0]"""


def is_json_sql(raw: str) -> str:
    """SQL that is true where the text is one JSON value."""
    return f"""transform(array({raw}), text ->
        text RLIKE r'{_MAYBE_JSON}' AND coalesce({_strict_sql("text", "true")}, false))[0]"""


def json_scalar(part: Column, kind: T.DataType | None = None) -> Column:
    """JSON text of one column (null becomes ``null``). Knowing its type saves the JSON writer."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return F.coalesce(part.cast("string"), F.lit("null"))
    wrapped = F.to_json(F.array(part), {"ignoreNullFields": "false"})
    written = F.substring(wrapped, F.lit(2), F.length(wrapped) - F.lit(2))
    if not isinstance(kind, T.StringType):
        return written
    plain = ~part.rlike(r'["\\\x00-\x1f]')
    return F.when(plain, F.concat(F.lit('"'), part, F.lit('"'))).otherwise(written)


def json_array_key(parts: Sequence[Column], kinds: Sequence[T.DataType] | None = None) -> Column:
    """JSON array text ``[a,b,...]`` built from columns of different types."""
    items = [json_scalar(p, k) for p, k in zip(parts, kinds or [None] * len(parts))]
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))

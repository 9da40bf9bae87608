"""Fixed schemas of the tables that flow between operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


STORE = _table(("doc_id", T.StringType()), ("value", T.StringType()), ("expires_at", T.TimestampType()))
VIEW = _table(("view_key", T.StringType()), ("doc_id", T.StringType()), ("emitted", T.StringType()))
VIEW_ROWS = _table(("view_key", T.StringType()), ("doc_id", T.StringType()), ("value", T.StringType()))
KEYS = _table(
    ("pos", T.IntegerType()),
    ("sub_pos", T.LongType()),
    ("key_ord", T.LongType()),
    ("raw_key", T.StringType()),
    ("view_key", T.StringType()),
    ("chunk_id", T.LongType()),
)
ACTIONS = _table(
    ("doc_id", T.StringType()),
    ("seq", T.LongType()),
    ("op", T.StringType()),
    ("value", T.StringType()),
    ("expiry", T.IntegerType()),
)
REJECTS = _table(("line", T.StringType()), ("reject_reason", T.StringType()))
OUTCOMES = _table(
    ("doc_id", T.StringType()), ("seq", T.LongType()), ("op", T.StringType()), ("outcome", T.StringType())
)
ATTEMPTS = _table(
    ("doc_id", T.StringType()),
    ("seq", T.LongType()),
    ("op", T.StringType()),
    ("try_no", T.IntegerType()),
    ("status", T.StringType()),
    ("wait_ms", T.IntegerType()),
)
CELLS = _table(
    ("row_key", T.BinaryType()),
    ("family", T.StringType()),
    ("qualifier", T.StringType()),
    ("value", T.BinaryType()),
)
METRICS = _table(("counter", T.StringType()), ("value", T.LongType()))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, in order; a missing column or another type is an error."""
    types = dict(df.dtypes)
    for field in schema.fields:
        if field.name not in types:
            raise ValueError(f"column {field.name!r} is missing; found {sorted(types)}")
        if types[field.name] != field.dataType.simpleString():
            raise ValueError(
                f"column {field.name!r} is {types[field.name]}, expected {field.dataType.simpleString()}"
            )
    return df.select(*schema.names)

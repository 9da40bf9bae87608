"""Views: a secondary index derived from documents, and reads of it by key list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.jsonkeys import canonical_key_sql, is_json_sql, json_array_key
from docloom.operators.keys import Interval
from docloom.operators.skew import fits_broadcast

MAX_BROADCAST_KEY_BYTES = 64 << 20
MAX_LITERAL_KEYS = 1000
_EXACT_JSON = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def define_view(
    docs: DataFrame,
    key: Column | str | Sequence[Column],
    *,
    where: Column | None = None,
    json_only: bool = True,
    emitted: Column | None = None,
    include_docs: bool = False,
) -> DataFrame:
    """Index ``docs(doc_id, value, ...)`` by a key: rows ``(view_key, k0.., doc_id, emitted[, value])``.

    A list of columns makes a JSON array key; if all are strings, integers or booleans, the parts are kept
    as text columns ``k0, k1, ...`` too, for partitioned storage. A single column is JSON key text.
    ``where`` decides which documents are indexed, ``json_only`` skips documents that are not JSON. With
    ``include_docs`` the view carries the document, and scans need no join with the store.
    """
    rows = docs if where is None else docs.where(where)
    if json_only:
        rows = rows.where(is_json_sql("value"))

    def guarded(part: Column) -> Column:
        # The optimizer may test a key before ``where``; it must not fail on rows that are filtered out.
        return part if where is None else F.when(where, part)

    canonical = False
    if isinstance(key, (Column, str)):
        parts: list[Column] = []
        view_key = guarded(F.col(key) if isinstance(key, str) else key)
    else:
        parts = [guarded(part) for part in key]
        kinds = [f.dataType for f in docs.select(*[p.alias(f"k{i}") for i, p in enumerate(parts)]).schema]
        view_key = json_array_key(parts, kinds)
        canonical = all(isinstance(kind, _EXACT_JSON) for kind in kinds)
        parts = parts if canonical else []
    view = rows.select(
        view_key.alias("view_key"),
        *[F.coalesce(p.cast("string"), F.lit("null")).alias(f"k{i}") for i, p in enumerate(parts)],
        "doc_id",
        (F.lit(None) if emitted is None else emitted).cast("string").alias("emitted"),
        *(["value"] if include_docs else []),
    )
    return view if canonical else view.withColumn("view_key", F.expr(canonical_key_sql("view_key")))


def key_parts(view: DataFrame) -> list[str]:
    """Names of the key-part columns of a view."""
    return [c for c in view.columns if c[:1] == "k" and c[1:].isdigit()]


def scan_view(
    view: DataFrame,
    keys: DataFrame,
    store: DataFrame | None = None,
    *,
    broadcast_bytes: int = MAX_BROADCAST_KEY_BYTES,
) -> DataFrame:
    """All view rows of every key in the list, one set per listed key.

    A short key list becomes literal filters too, so a view stored by key parts is read only in the
    partitions of the listed keys. A list is broadcast only if it measures little, and then the view is
    neither shuffled nor sorted; a longer list becomes a shuffled join, where adaptive execution splits a
    key that is too large. With ``store``, documents are looked up by ID and a missing document gives a
    null ``value``; the IDs are measured, and if they are few only their documents leave the store.
    """
    extra = [c for c in keys.columns if c not in view.columns]
    wanted = keys.select("view_key", *extra)
    parts = key_parts(view)
    # The parts repeat what view_key says; as join columns they reach the partition filter of the view.
    wanted = wanted.select(
        "*",
        *[F.coalesce(F.get_json_object("view_key", f"$[{p[1:]}]"), F.lit("null")).alias(p) for p in parts],
    )
    few = _few_keys(wanted.select("view_key", *parts), broadcast_bytes)
    if few is not None:
        view = view.where(few)
    # The keys of a short list are measured already; other columns are too, if their size is fixed.
    fixed = all(isinstance(keys.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in extra)
    if (few is not None and fixed) or fits_broadcast(wanted, broadcast_bytes):
        wanted = F.broadcast(wanted)
    rows = view.join(wanted, ["view_key", *parts])
    if store is None:
        return rows
    documents = asked_for(store.select("doc_id", "value"), rows, broadcast_bytes)
    return (rows.drop("value") if "value" in rows.columns else rows).join(documents, "doc_id", "left")


def within(view: DataFrame, intervals: Sequence[Interval] | None) -> DataFrame:
    """The rows of a view that keys of some interval may have; the filter reaches the folders of a view stored by parts.

    It stands for key lists that are too long to be literals. What it lets through is still joined with the keys.
    """
    if intervals is None:
        return view
    parts = key_parts(view)
    holds = [i.holds(parts) for i in intervals]
    while len(holds) > 1:  # a balanced tree stays shallow
        holds = [holds[i] | holds[i + 1] if i + 1 < len(holds) else holds[i] for i in range(0, len(holds), 2)]
    return view.where(holds[0] if holds else F.lit(False))


def asked_for(documents: DataFrame, rows: DataFrame, broadcast_bytes: int = MAX_BROADCAST_KEY_BYTES) -> DataFrame:
    """The documents whose ID occurs in ``rows``, or all of them if the distinct IDs measure too much to broadcast.

    The filter stands before any shuffle, so a lookup of some IDs moves their documents only.
    """
    ids = rows.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    if not fits_broadcast(ids, broadcast_bytes):
        return documents
    return documents.join(F.broadcast(ids), "doc_id", "left_semi")


def _few_keys(keys: DataFrame, max_bytes: int) -> Column | None:
    """Filter that a view row must pass to have a listed key, or None for a list that is not short.

    The literals of a short list (at most ``MAX_LITERAL_KEYS`` rows and ``max_bytes`` of text) reach the
    partition filter and the file scan of a stored view.
    """
    if max_bytes <= 0:
        return None
    rows = keys.limit(MAX_LITERAL_KEYS + 1).collect()
    if len(rows) > MAX_LITERAL_KEYS or sum(4 * len(text or "") for r in rows for text in r) > max_bytes:
        return None
    condition = F.lit(True)
    for i, name in enumerate(keys.columns):
        condition = condition & F.col(name).isin(sorted({r[i] for r in rows if r[i] is not None}))
    return condition


def sample_view(view: DataFrame, part: str, parts_to_read: int) -> DataFrame:
    """Sample by the partition component of the key: keep its first ``parts_to_read`` numbers.

    A part that is not a number is in no sample.
    """
    return view.where(F.col(part).try_cast("int") < parts_to_read)


def documents_of(rows: DataFrame) -> DataFrame:
    """``(doc_id, value)`` of the rows that have both."""
    return rows.where(F.col("doc_id").isNotNull() & F.col("value").isNotNull()).select("doc_id", "value")


def missing_documents(rows: DataFrame) -> DataFrame:
    """Count of scanned rows without ID or document, as a metrics row."""
    return rows.agg(
        F.count_if(F.col("doc_id").isNull() | F.col("value").isNull()).alias("value")
    ).select(F.lit("ROWS_WITHOUT_DOCUMENT").alias("counter"), "value")


def to_cells(
    rows: DataFrame, family: str, qualifier: str, *, order: str | None = None, unique: bool = False
) -> DataFrame:
    """Cells ``(row_key, family, qualifier, value)``; of several values for one row key the last one stays.

    ``order`` tells which value is last. The reduction is an aggregate with partial results per input
    partition, so many copies of one document do not meet in one task. Rows with ``unique`` IDs need none.
    """
    if not family or not qualifier:
        raise ValueError("family and qualifier are both required")
    kept = rows.where(F.col("doc_id").isNotNull() & F.col("value").isNotNull())
    if not unique:
        latest = F.max_by("value", order) if order else F.max("value")
        kept = kept.groupBy("doc_id").agg(latest.alias("value"))
    return kept.select(
        F.encode("doc_id", "UTF-8").alias("row_key"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        F.encode("value", "UTF-8").alias("value"),
    )

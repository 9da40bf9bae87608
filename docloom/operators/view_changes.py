"""What changes in a view when documents change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Define = Callable[[DataFrame], DataFrame]


def index_changes(define: Define, changed: DataFrame) -> DataFrame:
    """Index rows that ``changed(doc_id, before, after)`` adds and removes: the view's columns and ``added``.

    ``before`` and ``after`` are structs with the document's columns, null where there is none. ``define`` makes view rows
    of documents, as :func:`define_view` with its arguments given does. A row that only gets other contents under its key
    is an added one, which replaces the old; a row that stays the same is not listed.
    """

    def rows_of(side: str) -> DataFrame:
        documents = changed.where(F.col(side).isNotNull()).select("doc_id", f"{side}.*")
        view = define(documents)
        rest = [c for c in view.columns if c not in ("view_key", "doc_id")]
        return view.select("view_key", "doc_id", F.struct(*rest).alias("row"), F.lit(side == "after").alias("added"))

    both = rows_of("before").unionByName(rows_of("after"))
    # A document has one row under a key, so there is at most one of each side.
    met = both.groupBy("view_key", "doc_id").agg(
        F.max(F.when(~F.col("added"), F.col("row"))).alias("old"), F.max(F.when(F.col("added"), F.col("row"))).alias("new")
    )
    told = met.where(~F.col("old").eqNullSafe(F.col("new")))
    row = F.coalesce("new", "old")
    return told.select("view_key", "doc_id", row.alias("row"), F.col("new").isNotNull().alias("added")).select(
        "view_key", "doc_id", "row.*", "added"
    )


def changed_by(result, store: DataFrame) -> DataFrame:
    """``(doc_id, before, after)`` of the documents that an :class:`ApplyResult` changed in ``store``."""
    after = F.when(~F.col("deleted"), F.struct("value", "expires_at"))
    changes = result.changes.select("doc_id", after.alias("after"))
    before = store.select("doc_id", F.struct("value", "expires_at").alias("before"))
    both = changes.join(before, "doc_id", "left")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select("doc_id", "before", "after")


def with_changes(base: DataFrame, layers: DataFrame) -> DataFrame:
    """A view from its ``base`` and the changes since: ``layers`` has the view's columns, ``added`` and ``layer``.

    For each key and document the last layer decides. Filters on the key or its parts reach both sides.
    """
    own = [c for c in base.columns if c not in ("view_key", "doc_id")]
    parts = [c for c in own if c[:1] == "k" and c[1:].isdigit()]
    by = ["view_key", *parts, "doc_id"]
    last = layers.groupBy(*by).agg(F.max_by(F.struct("added", *[c for c in own if c not in parts]), "layer").alias("last"))
    told = last.select(*[F.col(c).alias(f"_{c}") for c in by])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    fresh = last.where("last.added").select(*by, "last.*").drop("added")
    return base.join(told, same, "left_anti").select(*base.columns).unionByName(fresh)

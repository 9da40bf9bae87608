"""Which keys exist in a store: the read-only form of touching them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.expiry import as_of_sql
from docloom.operators.apply import store_state


def key_existence(keys: DataFrame, store: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """``(doc_id, rows, present)`` per distinct key of ``keys``.

    Copies are counted before the join, so it is one row per key on both sides; the store is read by its
    two narrow columns.
    """
    distinct = keys.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    return distinct.join(store_state(store, as_of_sql(as_of)), "doc_id", "left").select(
        "doc_id", "rows", F.coalesce("live", F.lit(False)).alias("present")
    )


def existing_keys(keys: DataFrame, store: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Rows of ``keys`` whose key is in the store."""
    return keys.join(_live(store, as_of), "doc_id", "left_semi")


def missing_keys(keys: DataFrame, store: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Rows of ``keys`` whose key is not in the store."""
    return keys.join(_live(store, as_of), "doc_id", "left_anti")


def _live(store: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return store_state(store, as_of_sql(as_of)).where("live").select("doc_id")


def existence_counts(existence: DataFrame) -> DataFrame:
    """Keys and rows on each side of the split: ``(present, n_keys, n_rows)``."""
    return existence.groupBy("present").agg(F.count(F.lit(1)).alias("n_keys"), F.sum("rows").alias("n_rows"))

"""Save actions into a stored document store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.apply import ApplyResult, apply_actions
from docloom.operators.view_changes import Define
from docloom.schemas import STORE
from docloom.sources.buckets import Result, change_buckets, is_bucketed, read_buckets
from docloom.sources.tables import read_snapshot, snapshot_versions, write_snapshot
from docloom.sources.view_store import follow


@dataclass(frozen=True)
class SavedActions:
    """Number of the new snapshot, and the outcomes (computed on demand from the one before)."""

    version: int
    outcomes: DataFrame


def current_store(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of a bucketed store, or the newest snapshot, or an empty store where there is none yet."""
    if is_bucketed(spark, root):
        return read_buckets(spark, root)
    if snapshot_versions(spark, root):
        return read_snapshot(spark, root)
    return spark.createDataFrame([], STORE)


def change_store(
    spark: SparkSession,
    root: str,
    keys: DataFrame,
    compute: Callable[[DataFrame], Result],
    views: Mapping[str, Define] | None = None,
) -> tuple[int, Result]:
    """Bring the store under ``root`` to ``compute(store).store``; number of the new version, and the result.

    A bucketed store is read and rewritten only in the buckets of ``keys(doc_id)``, all keys that ``compute`` may change;
    another store gets its next whole snapshot. ``views`` names views kept by :func:`create_view` and what they index; they
    follow a bucketed store.
    """
    if not is_bucketed(spark, root):
        if views:
            raise ValueError(f"views can only follow a store in buckets, which {root} is not")
        result = compute(current_store(spark, root))
        return write_snapshot(result.store, root), result
    version, result = change_buckets(spark, root, keys, compute)
    for view_root, define in (views or {}).items():
        follow(spark, view_root, root, define)
    return version, result


def save_actions(
    actions: DataFrame, root: str, as_of: dt.datetime | str, *, views: Mapping[str, Define] | None = None, **options
) -> SavedActions:
    """Apply ``actions`` to the newest version of the store under ``root`` and save the next one (see ``change_store``)."""
    spark = actions.sparkSession
    version, result = change_store(spark, root, actions, lambda store: apply_actions(store, actions, as_of, **options), views)
    return SavedActions(version, result.outcomes)


def merge_into_table(result: ApplyResult, table: str) -> None:
    """Bring a catalog table that supports row-level writes to the new state of the store, by its changes only.

    Plain Parquet tables do not support this; write a snapshot for those.
    """
    values = {c: F.col(f"new.{c}") for c in STORE.names}
    (
        result.changes.alias("new")
        .mergeInto(table, F.col(f"{table}.doc_id") == F.col("new.doc_id"))
        .whenMatched(F.col("new.deleted"))
        .delete()
        .whenMatched()
        .update(values)
        .whenNotMatched(~F.col("new.deleted"))
        .insert(values)
        .merge()
    )

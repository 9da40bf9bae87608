"""Keyed mutations: apply a table of actions to a store table.

The result equals applying the actions of each key one after the other in ``seq`` order. It is computed
without stepping through them:

* SET and ADD leave a key present and DELETE leaves it absent, whatever was before; the other operations
  keep its presence. So whether a key is present before an action is the mark of the last such action, or
  else the store's own state: one running "last value".
* Presence decides which actions succeed. The final value starts from the last successful SET, ADD,
  REPLACE or DELETE (else the stored value) and takes the successful APPEND and PREPEND values after it.
  The final expiry is that of the last successful SET, ADD, REPLACE or TOUCH.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.expiry import as_of_sql, expires_sql, live_sql
from docloom.operators.skew import (
    MAX_GROUP_ROWS,
    fits_broadcast,
    hot_table,
    local_table,
    profile_groups,
    segment_bounds,
    segment_number,
    spread,
)
from docloom.sources.tables import materialize

BROADCAST_BYTES = 32 << 20  # measured size up to which changes are broadcast to the store
KEY_BROADCAST_BYTES = 64 << 20  # measured size up to which the keys of larger changes are

STORED, DELETED, TOUCHED = "stored", "deleted", "touched"
ALREADY_EXISTS, MISSING, IGNORED, INVALID_KEY = "exists", "missing", "ignored", "invalid_key"

VALID_KEY = "(doc_id IS NOT NULL AND doc_id != '')"
_EFFECTIVE = f"""({VALID_KEY} AND coalesce(
    op IN ('SET', 'ADD', 'REPLACE', 'APPEND', 'PREPEND', 'DELETE', 'TOUCH'), false))"""
_MARK = "CASE WHEN op IN ('SET', 'ADD') THEN true WHEN op = 'DELETE' THEN false END"
# Last successful action of a key that sets its value, and that sets its expiry.
_LAST_RESET = "max(CASE WHEN ok AND op IN ('SET', 'ADD', 'REPLACE', 'DELETE') THEN seq END)"
_LAST_EXPIRY = "max(CASE WHEN ok AND op IN ('SET', 'ADD', 'REPLACE', 'TOUCH') THEN seq END)"
OUTCOME = f"""CASE WHEN NOT ok THEN if(op = 'ADD', '{ALREADY_EXISTS}', '{MISSING}')
    WHEN op = 'DELETE' THEN '{DELETED}' WHEN op = 'TOUCH' THEN '{TOUCHED}' ELSE '{STORED}' END AS outcome"""


@dataclass(frozen=True)
class ApplyResult:
    """The new ``store``, one row of ``outcomes(doc_id, seq, op, outcome)`` per input action, and the ``changes``.

    ``changes(doc_id, value, expires_at, deleted)`` has one row per key that some action changed: all that a table with
    row-level writes has to be told.
    """

    store: DataFrame
    outcomes: DataFrame
    changes: DataFrame


def check_seq(rows: DataFrame) -> None:
    """Raise if an action has no ``seq`` or two of one key have the same."""
    repeated = rows.groupBy("doc_id", "seq").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR seq IS NULL")
    found = repeated.limit(1).collect()
    if found:
        what = "no seq" if found[0]["seq"] is None else f"the same seq {found[0]['seq']} as another"
        raise ValueError(f"an action of key {found[0]['doc_id']} has {what}")


def live_documents(store: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Documents that have not expired at ``as_of``."""
    return store.where(live_sql("expires_at", as_of_sql(as_of)))


def normalise(actions: DataFrame) -> DataFrame:
    """Actions with EXISTS renamed to TOUCH; a negative expiry is an error."""
    return actions.selectExpr(
        "doc_id",
        "cast(seq AS bigint) AS seq",
        "if(op = 'EXISTS', 'TOUCH', op) AS op",
        "value",
        """CASE WHEN expiry < 0 THEN raise_error(concat('negative expiry ', expiry))
                ELSE coalesce(expiry, 0) END AS expiry""",
    )


def apply_actions(
    store: DataFrame,
    actions: DataFrame,
    as_of: dt.datetime | str,
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> ApplyResult:
    """Apply ``actions(doc_id, seq, op, value, expiry)`` of any mix of operations to ``store``.

    ``seq`` must be unique per key (a tie is an error). Documents expired at ``as_of`` count as absent.
    The actions are measured first: a small feed is joined to the store by broadcast, so the documents
    are streamed and not shuffled; beyond ``broadcast_bytes`` the documents that are named are shuffled by key,
    and all of them only if the keys alone are too many to broadcast. Keys with
    too many actions for one task are processed in ``seq`` segments.
    """
    return _Application(store, actions, as_of_sql(as_of), max_group_rows, broadcast_bytes).result()


def apply_to(store: DataFrame, as_of: dt.datetime | str) -> Callable[[DataFrame], DataFrame]:
    """For ``actions.transform(apply_to(store, as_of))``: the new store."""
    return lambda actions: apply_actions(store, actions, as_of).store


class _Application:
    """The steps of one :func:`apply_actions` call over its inputs."""

    def __init__(
        self, store: DataFrame, actions: DataFrame, as_of: str, max_group_rows: int, broadcast_bytes: int
    ):
        self.store = store
        self.actions = normalise(actions)
        self.as_of = as_of
        self.rows = self.actions.where(_EFFECTIVE)
        self.profile = profile_groups(self.rows, "doc_id", "seq", max_group_rows=max_group_rows, streamed=True)
        self.small = fits_broadcast(self.rows, broadcast_bytes, self.profile.rows)
        self.split = broadcast_bytes > 0

    def result(self) -> ApplyResult:
        cold = self.cold_annotated
        outcomes, changes = cold.selectExpr("doc_id", "seq", "op", OUTCOME), fold(self.cold_marked)
        if self.profile.hot:
            hot = self.hot_annotated
            outcomes = outcomes.union(hot.selectExpr("doc_id", "seq", "op", OUTCOME))
            changes = changes.union(fold(hot))
        without_effect = self.actions.where(f"NOT {_EFFECTIVE}").selectExpr(
            "doc_id", "seq", "op", f"if({VALID_KEY}, '{IGNORED}', '{INVALID_KEY}') AS outcome"
        )
        new_store, changed = write_changes(self.store, changes, self.as_of, self.rows, small=self.small, split_by_keys=self.split)
        return ApplyResult(new_store, outcomes.union(without_effect), changed)

    @cached_property
    def cold_annotated(self) -> DataFrame:
        rows = self.rows
        if self.profile.hot:
            rows = rows.join(self.hot_keys, "doc_id", "left_anti")
        state = store_state(self.store, self.as_of)
        if self.small:
            # Few keys are asked for: keep only their states before the join.
            state = state.join(F.broadcast(rows.select("doc_id").distinct()), "doc_id", "left_semi")
        else:
            rows = spread(rows, self.profile.rows + self.store.count(), "doc_id")
        # Marks first: the join then finds the rows in the order of their keys, and nothing is sorted twice.
        return succeeding(with_marks(rows, "doc_id").join(state, "doc_id", "left"), "live")

    @property
    def cold_marked(self) -> DataFrame:
        whole_key = "OVER (PARTITION BY doc_id)"
        return self.cold_annotated.where("ok").selectExpr(
            "*", f"{_LAST_RESET} {whole_key} AS reset_seq", f"{_LAST_EXPIRY} {whole_key} AS expiry_seq"
        )

    @cached_property
    def hot_keys(self) -> DataFrame:
        return hot_table(self.rows, "doc_id", self.profile)

    @cached_property
    def hot_annotated(self) -> DataFrame:
        """Rows of oversized keys: per-segment windows, with what earlier segments left carried in.

        Three narrow passes over these rows give, per key or per segment, values that are collected and
        broadcast: the boundaries, the presence at the start of each segment, the last reset. Their
        number is bounded by the number of segments.
        """
        spark = self.store.sparkSession
        bounds = segment_bounds(self.rows, "doc_id", "seq", self.profile)
        state = store_state(self.store, self.as_of).join(self.hot_keys, "doc_id", "left_semi")
        present = {r["doc_id"]: r["live"] for r in state.collect()}

        rows = self.rows.join(bounds, "doc_id").withColumn("segment", segment_number("seq"))
        rows = rows.drop("_coarse", "_fine")
        last_mark = F.expr(f"max_by({_MARK}, CASE WHEN ({_MARK}) IS NOT NULL THEN seq END)").alias("mark")
        marks = rows.groupBy("doc_id", "segment").agg(last_mark).collect()
        carried: list[tuple] = []
        key, presence = None, False
        for r in sorted(marks, key=lambda r: (r["doc_id"], r["segment"])):
            if r["doc_id"] != key:
                key, presence = r["doc_id"], bool(present.get(r["doc_id"]))
            carried.append((key, r["segment"], presence, present.get(key)))
            presence = presence if r["mark"] is None else r["mark"]
        schema = "doc_id STRING, segment INT, _carry BOOLEAN, live BOOLEAN"
        rows = rows.join(local_table(spark, carried, schema), ["doc_id", "segment"])
        # Three readers follow (resets, outcomes, fold); each reads its columns of the written rows.
        annotated = materialize(succeeding(with_marks(rows, "doc_id, segment"), "_carry").drop("_carry", "segment"), "hot-actions")
        lasts = annotated.groupBy("doc_id").agg(F.expr(f"{_LAST_RESET} AS r"), F.expr(f"{_LAST_EXPIRY} AS e")).collect()
        lasts = local_table(spark, [tuple(r) for r in lasts], "doc_id STRING, reset_seq BIGINT, expiry_seq BIGINT")
        return annotated.join(lasts, "doc_id", "left")


def store_state(store: DataFrame, as_of: str) -> DataFrame:
    """``(doc_id, live)`` of every stored document; reads two narrow columns."""
    return store.selectExpr("doc_id", f"{live_sql('expires_at', as_of)} AS live")


def with_marks(rows: DataFrame, partition: str) -> DataFrame:
    """Add ``_mark``, the presence that the earlier actions of the partition leave (null: none tells), and ``_previous`` seq."""
    window = f"PARTITION BY {partition} ORDER BY seq"
    return rows.selectExpr(
        "*",
        f"last({_MARK}, true) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _mark",
        f"lag(seq) OVER ({window}) AS _previous",
    )


def succeeding(marked: DataFrame, initial: str) -> DataFrame:
    """Add ``ok`` to rows :func:`with_marks`: whether each action succeeds, given the presence before the partition's first."""
    rows = [c for c in marked.columns if c not in ("_mark", "_previous")]
    return marked.selectExpr("*", f"coalesce(_mark, {initial}, false) AS _present").selectExpr(
        *rows,
        """CASE WHEN seq IS NULL THEN raise_error(concat('an action of key ', doc_id, ' has no seq'))
                WHEN _previous = seq
                THEN raise_error(concat('two actions of key ', doc_id, ' have the same seq'))
                WHEN op = 'SET' THEN true WHEN op = 'ADD' THEN NOT _present ELSE _present END AS ok""",
    )


def fold(marked: DataFrame) -> DataFrame:
    """One row per changed key: base value, pieces to add around it, expiry.

    ``marked`` rows know the last reset and the last expiry of their key, so only the rows that make up
    the final document reach the aggregation.
    """

    def pieces(op: str, newest_first: bool) -> str:
        piece = f"CASE WHEN op = '{op}' THEN struct(seq, coalesce(value, '')) END"
        ordered = f"sort_array(collect_list({piece}), {not newest_first})"
        return f"array_join(transform({ordered}, p -> p.col2), '')"

    piece = "op IN ('APPEND', 'PREPEND') AND (reset_seq IS NULL OR seq > reset_seq)"
    return (
        marked.where(f"ok AND (seq = reset_seq OR seq = expiry_seq OR {piece})")
        .groupBy("doc_id")
        .agg(
            F.expr("first(live) AS live"),
            F.expr("max(CASE WHEN seq = reset_seq THEN struct(op, value) END) AS reset"),
            F.expr("max(CASE WHEN seq = expiry_seq THEN expiry END) AS expiry"),
            F.expr("max(expiry_seq IS NOT NULL) AS expires"),
            F.expr(f"{pieces('APPEND', newest_first=False)} AS tail"),
            F.expr(f"{pieces('PREPEND', newest_first=True)} AS head"),
        )
        .selectExpr(
            "doc_id",
            "live IS NOT NULL AS present",
            "if(reset IS NULL, coalesce(live, false), reset.op != 'DELETE') AS remains",
            "reset IS NOT NULL AS based",
            "reset.value AS base",
            "expires",
            "expiry",
            "tail",
            "head",
        )
    )


def write_changes(
    store: DataFrame,
    changes: DataFrame,
    as_of: str,
    rows: DataFrame,
    *,
    small: bool,
    split_by_keys: bool,
    applies: str = "true",
    inserts: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Merge one change row per key into the store (see :func:`fold` for the columns): the new store, and what changed.

    ``rows`` has the keys of the actions. ``applies`` is the condition on ``live`` (the document is stored and has not
    expired) under which a change takes effect. ``inserts`` tells whether changes may bring new keys.

    Small changes go to the documents by broadcast and new keys are appended. Of larger changes (with ``split_by_keys``)
    the keys are measured, and if they can be broadcast, documents that no action names are streamed and only the others are joined; beyond that
    it is one join of everything on the key.
    """
    fields = ("remains", "based", "base", "expires", "expiry", "tail", "head")
    documents = store.selectExpr("doc_id", "value", "expires_at", "true AS stored")
    changed = changes.select("doc_id", *fields)

    def merged(joined: DataFrame) -> DataFrame:
        return (
            joined.selectExpr("*", f"coalesce(stored, false) AND {live_sql('expires_at', as_of)} AS live")
            .selectExpr("*", f"remains IS NOT NULL AND ({applies}) AS changed")
            .selectExpr(
                "doc_id",
                """CASE WHEN NOT changed THEN value
                        WHEN head = '' AND tail = '' THEN if(based, base, value)
                        ELSE concat(head, coalesce(if(based, base, value), ''), tail) END AS value""",
                f"if(changed AND expires, {expires_sql('expiry', as_of)}, expires_at) AS expires_at",
                "changed",
                "if(changed, remains, coalesce(stored, false)) AS remains",
            )
        )

    keys = rows.select("doc_id").distinct()
    split = split_by_keys and not small and fits_broadcast(keys, KEY_BROADCAST_BYTES)
    named = documents.join(F.broadcast(keys), "doc_id", "left_semi") if small or split else documents
    touched = merged(named.join(changed, "doc_id", "full_outer" if inserts else "left"))
    told = touched.where("changed").selectExpr(
        "doc_id", "if(remains, value, null) AS value", "if(remains, expires_at, null) AS expires_at", "NOT remains AS deleted"
    )

    out = ("doc_id", "value", "expires_at")
    if split:
        untouched = documents.join(F.broadcast(keys), "doc_id", "left_anti")
        return untouched.select(*out).union(touched.where("remains").select(*out)), told
    if not small:
        return touched.where("remains").select(*out), told
    kept = merged(documents.join(F.broadcast(changed), "doc_id", "left")).where("remains").select(*out)
    if not inserts:
        return kept, told
    if "present" in changes.columns:
        fresh = changes.where("NOT present")
    else:
        seen = store.select("doc_id").join(F.broadcast(changes.select("doc_id")), "doc_id", "left_semi")
        fresh = changes.join(seen, "doc_id", "left_anti")
    # A new key starts from nothing, so its change is its document.
    return kept.union(
        fresh.where("remains").selectExpr(
            "doc_id",
            "if(head = '' AND tail = '', base, concat(head, coalesce(base, ''), tail)) AS value",
            f"if(expires, {expires_sql('expiry', as_of)}, cast(null AS timestamp)) AS expires_at",
        )
    ), told

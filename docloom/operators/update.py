"""Update documents: look up the stored document of each source row, merge, write back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.functions.expiry import as_of_sql, live_sql
from docloom.operators.apply import BROADCAST_BYTES
from docloom.operators.skew import (
    MAX_GROUP_ROWS,
    GroupProfile,
    fits_broadcast,
    hot_table,
    profile_groups,
    segment_bounds,
    segment_number,
)
from docloom.operators.views import asked_for
from docloom.sources.tables import materialize, scratch_dir

Merge = Callable[[Column, Column], Column]
MAX_FOLDED_ROWS = 200_000  # source rows of one key folded in one go
HOT_DOCUMENT_BYTES = 128 << 20  # measured size up to which documents of oversized keys are broadcast
LOOKUP_SALTS = 64


@dataclass(frozen=True)
class UpdateResult:
    """The new ``store`` and per key how its actions ended.

    ``summary(doc_id, stored, already_exists, missing, missing_touched, ignored)``.
    """

    store: DataFrame
    summary: DataFrame


def lookup_documents(
    rows: DataFrame,
    store: DataFrame,
    as_of: dt.datetime | str,
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
    broadcast_bytes: int = HOT_DOCUMENT_BYTES,
) -> DataFrame:
    """Add ``existing``, the live document of each row's ``doc_id``, null where there is none.

    Rows are kept as they are, copies included. Keys with too many rows for one task get their few
    documents by broadcast, so those rows stay where they are; should these documents measure too much
    to broadcast, the rows are spread over copies of them. Rows without key are not joined at all.
    """
    documents = store.where(live_sql("expires_at", as_of_sql(as_of))).selectExpr("doc_id", "value AS existing")
    columns = [*rows.columns, "existing"]
    keyless = rows.where("doc_id IS NULL").withColumn("existing", F.lit(None).cast("string"))
    keyed = rows.where("doc_id IS NOT NULL")
    profile = profile_groups(keyed, "doc_id", max_group_rows=max_group_rows)
    documents = asked_for(documents, keyed, broadcast_bytes)
    if not profile.hot:
        return keyed.join(documents, "doc_id", "left").select(columns).union(keyless)

    hot_keys = hot_table(keyed, "doc_id", profile)
    hot_rows = keyed.join(hot_keys, "doc_id", "left_semi")
    hot_documents = documents.join(hot_keys, "doc_id", "left_semi")
    if fits_broadcast(hot_documents, broadcast_bytes):
        hot = hot_rows.join(F.broadcast(hot_documents), "doc_id", "left")
    else:
        salt = F.pmod(F.xxhash64(*rows.columns), F.lit(LOOKUP_SALTS)).cast("int")
        copies = hot_documents.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1))))
        hot = hot_rows.withColumn("_salt", salt).join(copies, ["doc_id", "_salt"], "left")
    cold = keyed.join(hot_keys, "doc_id", "left_anti").join(documents, "doc_id", "left")
    return cold.select(columns).union(hot.select(columns)).union(keyless)


def merge_actions(
    rows: DataFrame, store: DataFrame, merge: Merge, as_of: dt.datetime | str, *, seq: str = "seq", **options
) -> DataFrame:
    """Actions from ``rows(doc_id, seq, payload...)``: ``merge(payload, existing)`` for each row.

    Every row is merged with the stored document, none sees another row's change; ``merge`` may use pandas
    UDFs. Feed the result to ``apply_actions``.
    """
    payload = F.struct(*[c for c in rows.columns if c != "doc_id"])
    return (
        lookup_documents(rows, store, as_of, **options)
        .select("doc_id", F.col(seq).alias("seq"), merge(payload, F.col("existing")).alias("a"))
        .select("doc_id", "seq", "a.op", "a.value", "a.expiry")
    )


def update_documents(
    store: DataFrame,
    source: DataFrame,
    merge: Merge,
    as_of: dt.datetime | str,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    order_by: str | None = None,
    reduce: Sequence[Column] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    max_folded_rows: int = MAX_FOLDED_ROWS,
) -> UpdateResult:
    """Update ``store`` from ``source``.

    ``transform`` turns the source into ``doc_id`` and payload columns; rows with a null or empty
    ``doc_id`` are skipped. ``merge(payload, existing)`` builds one action from the payload struct and
    the document text (null if absent), with the action builders.

    Several rows of one key need a rule: ``reduce`` aggregates them to one payload (partial results are
    combined before the shuffle, so this is the way for heavy keys), ``order_by`` merges them one after
    the other, each seeing the document the one before left. With neither, a key found twice is an error.
    Merging in order is serial per key by nature; a key with more than ``max_folded_rows`` rows is folded
    in rounds of bounded size, each continuing from the documents the round before wrote.
    """
    as_of = as_of_sql(as_of)
    rows = transform(source) if transform else source
    rows = rows.where(F.col("doc_id") != "")
    payload = [c for c in rows.columns if c != "doc_id"]

    if reduce is not None:
        grouped = rows.groupBy("doc_id").agg(*reduce)
        reduced = [c for c in grouped.columns if c != "doc_id"]
        items = grouped.select("doc_id", F.array(F.struct(*reduced)).alias("items"))
    elif order_by is None:
        once = rows.groupBy("doc_id").agg(
            F.count(F.lit(1)).alias("n"), F.any_value(F.struct(*payload)).alias("item")
        )
        twice = F.concat(F.lit("several source rows for key "), F.col("doc_id"), F.lit("; pass order_by or reduce"))
        item = F.when(F.col("n") > 1, F.raise_error(twice)).otherwise(F.col("item"))
        items = once.select("doc_id", F.array(item).alias("items"))
    else:
        profile = profile_groups(rows, "doc_id", order_by, max_group_rows=max_folded_rows)
        small = fits_broadcast(rows, broadcast_bytes, profile.rows)
        if profile.hot:
            return _update_in_rounds(store, rows, payload, merge, as_of, order_by, profile)
        return _finish(_fold_into(store, _items(rows, payload, order_by), merge, as_of, small))
    small = fits_broadcast(items, broadcast_bytes)
    return _finish(_fold_into(store, items, merge, as_of, small))


def _items(rows: DataFrame, payload: list[str], order_by: str) -> DataFrame:
    item = F.struct(F.col(order_by).alias("_order"), *[F.col(c) for c in payload])
    return rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(item)).alias("items"))


_COUNTS = ("stored", "already_exists", "missing", "missing_touched", "ignored")


def _state_sql(exists: str, value: str, expires_at: str) -> str:
    counts = ", ".join(f"'{c}', 0L" for c in _COUNTS)
    return f"named_struct('exists', {exists}, 'value', {value}, 'expires_at', {expires_at}, {counts})"


def _fold_into(store: DataFrame, items: DataFrame, merge: Merge, as_of: str, small: bool) -> DataFrame:
    """Join the items of each key to the store and fold them: ``(doc_id, touched, state)``.

    An expired document of a touched key counts as absent and is dropped.
    """
    documents = store.selectExpr(
        "doc_id",
        f"{_state_sql('true', 'value', 'expires_at')} AS kept",
        f"{live_sql('expires_at', as_of)} AS live",
    )
    absent = _state_sql("false", "cast(null AS string)", "cast(null AS timestamp)")

    def folded(joined: DataFrame) -> DataFrame:
        begun = joined.selectExpr("doc_id", "items", "kept", f"if(live, kept, {absent}) AS begin")
        end = F.aggregate("items", F.col("begin"), lambda state, item: _step(state, item, merge, as_of))
        return begun.select("doc_id", "kept", "items", end.alias("end")).selectExpr(
            "doc_id", "items IS NOT NULL AS touched", "if(items IS NULL, kept, end) AS state"
        )

    if not small:
        return folded(documents.join(items, "doc_id", "full_outer"))
    kept = folded(documents.join(F.broadcast(items), "doc_id", "left"))
    seen = store.select("doc_id").join(F.broadcast(items.select("doc_id")), "doc_id", "left_semi")
    fresh = items.join(seen, "doc_id", "left_anti")
    nothing = "cast(null AS boolean) AS live"
    kept_type = documents.schema["kept"].dataType
    return kept.union(
        folded(fresh.select("doc_id", "items", F.lit(None).cast(kept_type).alias("kept"), F.expr(nothing)))
    )


def _state(exists: Column, value: Column, expires: Column, counts: dict[str, Column]) -> Column:
    return F.struct(
        exists.alias("exists"),
        value.cast("string").alias("value"),
        expires.cast("timestamp").alias("expires_at"),
        *[counts[c].alias(c) for c in _COUNTS],
    )


def _step(state: Column, item: Column, merge: Merge, as_of: str) -> Column:
    """State after one merged action. The one-element transform binds the action once."""
    merged = merge(item, F.when(state["exists"], state["value"]))
    return F.transform(F.array(merged), lambda action: _apply_one(state, action, as_of))[0]


def _apply_one(state: Column, action: Column, as_of: str) -> Column:
    present = state["exists"]
    op = F.when(action["op"] == A.EXISTS, A.TOUCH).otherwise(F.coalesce(action["op"], F.lit(A.NONE)))
    known = op.isin(*[o for o in A.OPERATIONS if o not in (A.NONE, A.EXISTS)])
    ok = known & F.when(op == A.SET, True).when(op == A.ADD, ~present).otherwise(present)
    old = F.coalesce(state["value"], F.lit(""))
    piece = F.coalesce(action["value"], F.lit(""))
    value = (
        F.when(op.isin(A.SET, A.ADD, A.REPLACE), action["value"])
        .when(op == A.APPEND, F.concat(old, piece))
        .when(op == A.PREPEND, F.concat(piece, old))
        .when(op == A.TOUCH, state["value"])
    )
    expiry = F.coalesce(action["expiry"], F.lit(0))
    expiry = F.when(expiry < 0, F.raise_error(F.lit("negative expiry")).cast("int")).otherwise(expiry)
    begin = F.unix_micros(F.expr(as_of))
    moment = F.when(expiry > 0, F.timestamp_micros(begin + expiry * F.lit(1_000_000).cast("bigint")))
    expires = F.when(op.isin(A.SET, A.ADD, A.REPLACE, A.TOUCH), moment).when(
        op != A.DELETE, state["expires_at"]
    )

    def counted(name: str, condition: Column) -> Column:
        return state[name] + F.when(condition, 1).otherwise(0).cast("bigint")

    return _state(
        F.when(ok, op != A.DELETE).otherwise(present),
        F.when(ok, value).otherwise(state["value"]),
        F.when(ok, expires).otherwise(state["expires_at"]),
        {
            "stored": counted("stored", ok),
            "already_exists": counted("already_exists", ~ok & (op == A.ADD)),
            "missing": counted("missing", ~ok & known & (op != A.ADD)),
            "missing_touched": counted("missing_touched", ~ok & (op == A.TOUCH)),
            "ignored": counted("ignored", ~known),
        },
    )


def _finish(folded: DataFrame) -> UpdateResult:
    return UpdateResult(_documents(folded), _summary(folded))


def _documents(folded: DataFrame) -> DataFrame:
    return folded.where(F.col("state.exists")).select("doc_id", "state.value", "state.expires_at")


def _summary(folded: DataFrame) -> DataFrame:
    return folded.where("touched").select("doc_id", *[F.col(f"state.{c}").alias(c) for c in _COUNTS])


def _update_in_rounds(
    store: DataFrame,
    rows: DataFrame,
    payload: list[str],
    merge: Merge,
    as_of: str,
    order_by: str,
    profile: GroupProfile,
) -> UpdateResult:
    """Ordinary keys in one fold; the few oversized keys in rounds over their ordered segments.

    Each round folds at most one segment per key into the documents of those keys and writes the result
    to the shared scratch folder, where the next round starts.
    """
    spark = store.sparkSession
    hot_keys = hot_table(rows, "doc_id", profile)
    cold_store = store.join(hot_keys, "doc_id", "left_anti")
    cold_rows = rows.join(hot_keys, "doc_id", "left_anti")
    cold = _fold_into(cold_store, _items(cold_rows, payload, order_by), merge, as_of, small=False)

    bounds = segment_bounds(rows, "doc_id", order_by, profile)
    hot_rows = materialize(
        rows.join(bounds, "doc_id")
        .withColumn("_segment", segment_number(order_by))
        .select(*rows.columns, "_segment"),
        "update-rows",
        partition_by=("_segment",),
    )
    hot_store = store.join(hot_keys, "doc_id", "left_semi")
    folder = scratch_dir(spark, "update-rounds")
    last = hot_rows.agg(F.max("_segment").alias("n")).first()["n"]
    for segment in range(last + 1):
        items = _items(hot_rows.where(F.col("_segment") == segment), payload, order_by)
        part = _fold_into(hot_store, items, merge, as_of, small=False)
        part.write.parquet(f"{folder}/round={segment}")
        hot_store = _documents(spark.read.schema(part.schema).parquet(f"{folder}/round={segment}"))
    rounds = spark.read.schema(cold.schema).parquet(folder)
    counts = _summary(rounds).groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    return UpdateResult(_documents(cold).union(hot_store), _summary(cold).union(counts))

"""Apply one operation to many keys: the shape of a file export.

With a single operation nothing has to be ordered: each key reduces to its first value (ADD), its last
value (SET, REPLACE) or nothing at all (DELETE, TOUCH) by an aggregate with partial results, so a key that
holds a large share of the input costs no more than any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.functions.expiry import as_of_sql
from docloom.operators import apply as P
from docloom.operators.skew import fits_broadcast


def apply_operation(
    store: DataFrame,
    docs: DataFrame,
    op: str | None,
    as_of: dt.datetime | str,
    *,
    expiry: int | str | None = None,
    broadcast_bytes: int = P.BROADCAST_BYTES,
    unique_seq: bool = False,
) -> P.ApplyResult:
    """Apply ``op`` to ``docs(doc_id, seq, value)``; equal to ``apply_actions`` with that one operation.

    ``value`` may be missing for DELETE and TOUCH. ``seq`` must be given and unique per key: a narrow job
    checks it and raises, unless ``unique_seq`` says that it is known.
    """
    op, expiry, as_of = A.parse_operation(op), A.parse_expiry(expiry), as_of_sql(as_of)
    value = "value" if "value" in docs.columns else "cast(null AS string) AS value"
    docs = docs.selectExpr("doc_id", "cast(seq AS bigint) AS seq", value)
    invalid = _with_outcome(docs.where(f"NOT {P.VALID_KEY}"), op, P.INVALID_KEY)
    rows = docs.where(P.VALID_KEY)
    if op == A.NONE:
        nothing = store.where("false").selectExpr("doc_id", "value", "expires_at", "false AS deleted")
        return P.ApplyResult(store, _with_outcome(rows, op, P.IGNORED).union(invalid), nothing)

    if not unique_seq:
        P.check_seq(rows)
    # Counting first keeps a large feed from being read in full just to be measured.
    small = fits_broadcast(rows, broadcast_bytes, rows.count() if broadcast_bytes else 0)
    state = P.store_state(store, as_of)
    if small:
        state = state.join(F.broadcast(rows.select("doc_id").distinct()), "doc_id", "left_semi")

    changing = rows
    if op in (A.APPEND, A.PREPEND) and not small:
        # Do not gather pieces for keys that are not there.
        changing = rows.join(state.where("live").select("doc_id"), "doc_id", "left_semi")
    new_store, changed = P.write_changes(
        store,
        _changes(changing, op, expiry),
        as_of,
        rows,
        small=small,
        split_by_keys=broadcast_bytes > 0,
        applies="true" if op == A.SET else "NOT live" if op == A.ADD else "live",
        inserts=op in (A.SET, A.ADD),
    )
    return P.ApplyResult(new_store, _outcomes(rows, state, op).union(invalid), changed)


def _with_outcome(rows: DataFrame, op: str, outcome: str) -> DataFrame:
    return rows.selectExpr("doc_id", "seq", f"'{op}' AS op", f"'{outcome}' AS outcome")


def _changes(rows: DataFrame, op: str, expiry: int) -> DataFrame:
    joined = "array_join(transform(sort_array(collect_list(struct(seq, coalesce(value, ''))), {}), p -> p.col2), '')"
    reduced = {
        A.SET: "max_by(value, seq)",
        A.REPLACE: "max_by(value, seq)",
        A.ADD: "min_by(value, seq)",
        A.APPEND: joined.format("true"),
        A.PREPEND: joined.format("false"),
    }
    if op in reduced:
        per_key = rows.groupBy("doc_id").agg(F.expr(reduced[op]).alias("v"))
    else:
        per_key = rows.select("doc_id").distinct()
    based = op in (A.SET, A.ADD, A.REPLACE)
    return per_key.selectExpr(
        "doc_id",
        f"{op != A.DELETE} AS remains",
        f"{based or op == A.DELETE} AS based",
        f"{'v' if based else 'cast(null AS string)'} AS base",
        f"{based or op == A.TOUCH} AS expires",
        f"{expiry} AS expiry",
        f"{'v' if op == A.APPEND else repr('')} AS tail",
        f"{'v' if op == A.PREPEND else repr('')} AS head",
    )


def _outcomes(rows: DataFrame, state: DataFrame, op: str) -> DataFrame:
    if op == A.SET:
        return _with_outcome(rows, op, P.STORED)
    ok = "coalesce(live, false)"
    if op in (A.ADD, A.DELETE):
        # Only the first action of a key can succeed.
        firsts = rows.groupBy("doc_id").agg(F.min("seq").alias("first_seq"))
        state = firsts.join(state, "doc_id", "left")
        ok = f"seq = first_seq AND {'NOT ' if op == A.ADD else ''}coalesce(live, false)"
    return (
        rows.select("doc_id", "seq")
        .join(state, "doc_id", "left")
        .selectExpr("doc_id", "seq", f"'{op}' AS op", f"{ok} AS ok")
        .selectExpr("doc_id", "seq", "op", P.OUTCOME)
    )

"""Merging in order by any Python function: rows of a key are streamed, never held together."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.functions.expiry import as_of_sql, live_sql
from docloom.operators.skew import fits_broadcast
from docloom.operators.update import UpdateResult

#: Payload of a row and the document so far to operation, value and expiry in seconds; None does nothing.
PythonMerge = Callable[[dict, str | None], tuple[str | None, str | None, int] | None]
KEY_BROADCAST_BYTES = 64 << 20
_BATCH_ROWS = 1024
_FOLDED = (
    "doc_id string, present boolean, value string, expires_us long, stored long, already_exists long, missing long,"
    " missing_touched long, ignored long"
)
_FIELDS = [part.split()[0] for part in _FOLDED.split(", ")]
_ARROW = pa.schema([("doc_id", pa.string()), ("present", pa.bool_()), ("value", pa.string())] + [(n, pa.int64()) for n in _FIELDS[3:]])


class _Document:
    """A document while its actions are applied one after the other."""

    def __init__(self, key: str, now_us: int) -> None:
        self.key, self.now_us = key, now_us
        self.present, self.value, self.expires_us = False, None, None
        self.counts = dict.fromkeys(_FIELDS[4:], 0)

    def apply(self, op: str | None, value: str | None, expiry: int | None) -> None:
        op = A.TOUCH if op == A.EXISTS else op or A.NONE
        if op == A.NONE or op not in A.OPERATIONS:
            self.counts["ignored"] += 1
            return
        if (expiry or 0) < 0:
            raise ValueError(f"negative expiry {expiry} for key {self.key}")
        if op != A.SET and self.present == (op == A.ADD):
            self.counts["already_exists" if op == A.ADD else "missing"] += 1
            self.counts["missing_touched"] += op == A.TOUCH
            return
        self.counts["stored"] += 1
        if op in (A.SET, A.ADD, A.REPLACE):
            self.value = value
        elif op == A.APPEND:
            self.value = (self.value or "") + (value or "")
        elif op == A.PREPEND:
            self.value = (value or "") + (self.value or "")
        if op in (A.SET, A.ADD, A.REPLACE, A.TOUCH):
            self.expires_us = self.now_us + expiry * 1_000_000 if expiry else None
        if op == A.DELETE:
            self.value = self.expires_us = None
        self.present = op != A.DELETE

    def row(self) -> list:
        return [self.key, self.present, self.value, self.expires_us, *self.counts.values()]


def update_in_order(
    store: DataFrame,
    source: DataFrame,
    merge: PythonMerge,
    as_of: dt.datetime | str,
    *,
    order_by: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> UpdateResult:
    """Update ``store`` from ``source``, merging the rows of a key in order by Python code.

    Equal to ``update_documents`` with ``order_by``, but ``merge(payload, existing)`` is a plain function of a dict and
    the document's text. Documents and source rows of touched keys are brought together by key and sorted; each task
    streams its rows in Arrow batches and keeps one document at a time, so a key of any number of rows takes memory for
    one batch. Keys are serial by nature: one key is one task's stream. Documents that no row touches never reach
    Python; where the keys can be broadcast, they are not shuffled either. Rows with a null or empty key are skipped.
    """
    as_of = as_of_sql(as_of)
    rows = transform(source) if transform else source
    rows = rows.where(F.col("doc_id") != "")
    keys = rows.select("doc_id").distinct()
    if fits_broadcast(keys, KEY_BROADCAST_BYTES):
        keys = F.broadcast(keys)
    now_us = store.sparkSession.range(1).select(F.unix_micros(F.expr(as_of))).first()[0]
    payload = [c for c in rows.columns if c != "doc_id"]
    begun = store.where(live_sql("expires_at", as_of)).join(keys, "doc_id", "left_semi")
    begun = begun.select("doc_id", F.lit(0).alias("_step"), "value", F.unix_micros("expires_at").alias("_expires"))
    steps = rows.select("doc_id", F.lit(1).alias("_step"), F.struct(*payload).alias("_row"))
    steps = begun.unionByName(steps, allowMissingColumns=True)
    steps = steps.repartition("doc_id").sortWithinPartitions("doc_id", "_step", F.col("_row")[order_by])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        document, done = None, []

        def made() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _ARROW, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        for batch in batches:
            for r in batch.to_pylist():
                if document is None or document.key != r["doc_id"]:
                    if document:
                        done.append(document.row())
                    document = _Document(r["doc_id"], now_us)
                    if len(done) >= _BATCH_ROWS:
                        yield made()
                if r["_step"] == 0:
                    document.present, document.value, document.expires_us = True, r["value"], r["_expires"]
                else:
                    existing = document.value if document.present else None
                    document.apply(*(merge(r["_row"], existing) or (None, None, 0)))
        if document:
            done.append(document.row())
        if done:
            yield made()

    folded = steps.mapInArrow(fold, _FOLDED)
    changed = folded.where("present").selectExpr("doc_id", "value", "timestamp_micros(expires_us) AS expires_at")
    untouched = store.select("doc_id", "value", "expires_at").join(keys, "doc_id", "left_anti")
    return UpdateResult(untouched.union(changed), folded.select("doc_id", *_FIELDS[4:]))

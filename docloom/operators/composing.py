"""Update documents in order without stepping through them, by merges that can be composed.

Such a merge asks of the document only whether there is one, and keeps its text as a whole: its action for an absent
document is fixed by the source row, and so is the one for a present document but for the old text, which may stand in the
new one once. Then a row turns "is there a document" into the same, its opposite, or a fixed answer, and what all rows of a
key do to it is known from running values: the last fixed answer and the turns after it. With that, each row is one known
action, and all of them are applied at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import actions as A
from docloom.functions.expiry import as_of_sql, live_sql
from docloom.operators.apply import apply_actions
from docloom.operators.skew import MAX_GROUP_ROWS, hot_table, number_rows, profile_groups, spread
from docloom.operators.update import Merge
from docloom.operators.views import asked_for
from docloom.sources.tables import materialize

_OLD = "the old text"  # stands for the document's text while the merge is looked at
_KNOWN = [o for o in A.OPERATIONS if o not in (A.NONE, A.EXISTS)]


class ComposedUpdate:
    """As :class:`~docloom.operators.update.UpdateResult`. What each row does is worked out and written once, when the
    first of the two is asked for; the summary counts it, and only the store has it applied."""

    def __init__(self, store: DataFrame, rows: DataFrame, merge: Merge, as_of: dt.datetime | str, order_by: str, max_group_rows: int):
        self._store, self._rows, self._merge, self._order_by = store, rows, merge, order_by
        self._as_of, self._at, self._max_group_rows = as_of, as_of_sql(as_of), max_group_rows

    @cached_property
    def store(self) -> DataFrame:
        actions = self._acts.select("doc_id", "_seq", F.posexplode(_pieces()).alias("_place", "piece")).select(
            "doc_id", (F.col("_seq") * 4 + F.col("_place")).alias("seq"), "piece.*"
        )
        result = apply_actions(self._store, actions, self._as_of, max_group_rows=self._max_group_rows)
        # A named key whose document had expired begins with none, also where no action made one.
        live = live_sql("expires_at", self._at)
        expired = result.store.where(f"NOT ({live})").join(self._acts.where("_seq = 0").select("doc_id"), "doc_id", "left_anti")
        return result.store.where(live).unionByName(expired)

    @cached_property
    def summary(self) -> DataFrame:
        return _summary(self._acts)

    @cached_property
    def _acts(self) -> DataFrame:
        """Number, presence before and action ``a`` of every row."""
        rows = self._rows
        profile = profile_groups(
            rows.select("doc_id", self._order_by), "doc_id", self._order_by, max_group_rows=self._max_group_rows, streamed=True
        )
        documents = self._store.count()
        old = self._store.selectExpr("doc_id", f"{live_sql('expires_at', self._at)} AS live", "value IS NULL AS bare")
        if documents > profile.rows:  # else the few columns of all are sooner shuffled than the keys are found
            old = asked_for(old, rows)

        if not profile.hot:
            known = self._of_whole_keys(rows, old, profile.rows + documents)
        else:
            hot_keys = hot_table(rows, "doc_id", profile)
            known = self._of_whole_keys(rows.join(hot_keys, "doc_id", "left_anti"), old, profile.rows + documents)
            hot = number_rows(
                rows.join(hot_keys, "doc_id", "left_semi"), "doc_id", self._order_by, name="_seq", profile=profile
            )
            known = known.unionByName(self._of_segments(hot, old.join(hot_keys, "doc_id", "left_semi"), profile.group_limit))
        chosen = F.when(F.col("before"), F.col("present")).otherwise(F.col("absent"))
        return materialize(known.select("doc_id", "_seq", "before", chosen.alias("a")).withColumn("a", _fitting()), "composed-actions")

    def _of_whole_keys(self, rows: DataFrame, old: DataFrame, meeting: int) -> DataFrame:
        """Keys that one task sorts: numbered, merged and looked up where one shuffle has brought them."""
        in_key = Window.partitionBy("doc_id").orderBy(self._order_by)
        numbered = spread(rows, meeting, "doc_id").withColumn("_seq", (F.row_number().over(in_key) - 1).cast("bigint"))
        # Running values first: the join then finds the rows in the order of their keys, and nothing is sorted twice.
        running = _running(self._merged(numbered, self._order_by), ["doc_id"], self._order_by)
        return _known(running.join(old, "doc_id", "left"), _live()).select("doc_id", "_seq", "before", "present", "absent")

    def _of_segments(self, numbered: DataFrame, old: DataFrame, segment_rows: int) -> DataFrame:
        """Oversized keys: what each segment makes of the answer at its start, and from that the answer at every start."""
        segment = F.floor(F.col("_seq") / segment_rows).alias("_segment")
        both = materialize(self._merged(numbered, "_seq").select("*", segment), "composed-rows")
        told = both.withColumn("_turned", F.sum("_turns").over(_by(["doc_id", "_segment"], "_seq")))
        last = F.max_by(F.struct("_fixed", "_turned"), F.when(F.col("_fixed").isNotNull(), F.col("_seq"))).alias("last")
        segments = told.groupBy("doc_id", "_segment").agg(last, F.sum("_turns").alias("turns")).select(
            "doc_id",
            "_segment",
            (F.col("last._fixed") != ((F.col("turns") - F.col("last._turned")) % 2 == 1)).alias("_fixed"),
            F.when(F.col("last").isNull(), F.col("turns")).otherwise(0).alias("_turns"),
        )
        running = _running(segments, ["doc_id"], "_segment").join(old, "doc_id", "left")
        starts = _known(running, _live()).select("doc_id", "_segment", F.col("before").alias("start"))
        running = _running(both, ["doc_id", "_segment"], "_seq").join(starts, ["doc_id", "_segment"])
        return _known(running, F.col("start")).select("doc_id", "_seq", "before", "present", "absent")

    def _merged(self, numbered: DataFrame, order: str) -> DataFrame:
        """The action of each row with and without a document, the answer it fixes, and whether it turns it."""
        payload = F.struct(*[c for c in self._rows.columns if c != "doc_id"])
        both = numbered.select(
            *dict.fromkeys(["doc_id", "_seq", order]),
            _normal(self._merge(payload, F.lit(None).cast("string"))).alias("absent"),
            _normal(self._merge(payload, F.lit(_OLD))).alias("present"),
        )
        after_absent, after_present = F.col("absent.op").isin(A.SET, A.ADD), F.col("present.op") != A.DELETE
        both = both.withColumn("_fixed", F.when(after_absent == after_present, after_absent))
        return both.withColumn("_turns", (after_absent & ~after_present).cast("bigint"))


def update_composed(
    store: DataFrame,
    source: DataFrame,
    merge: Merge,
    as_of: dt.datetime | str,
    *,
    order_by: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> ComposedUpdate:
    """Equal to ``update_documents(..., order_by=order_by)`` for a merge that can be composed (see above).

    ``merge(payload, existing)`` may test ``existing`` for null and put it, once, into the new text, as in
    ``concat(before, existing, after)``; it may not look into it. An action on a present document whose text holds the old
    one is a SET or REPLACE; the old text twice, or in another action, is an error, and so is a null document text. A merge
    that decides by the old text itself cannot be told from one that does not, and needs ``update_documents``.

    ``order_by`` must be unique within a key. A key beyond ``max_group_rows`` rows (and beyond what
    :func:`~docloom.operators.skew.profile_groups` allows a streaming task) is cut into segments by the number of its rows;
    segments are looked at side by side and one row of each carries the answer on, so the number of jobs does not depend
    on how many rows a key has. All other keys are shuffled once and read in order.
    """
    rows = (transform(source) if transform else source).where(F.col("doc_id") != "")
    return ComposedUpdate(store, rows, merge, as_of, order_by, max_group_rows)


def _normal(action: Column) -> Column:
    op = F.when(action["op"] == A.EXISTS, A.TOUCH).otherwise(F.coalesce(action["op"], F.lit(A.NONE)))
    return F.struct(
        F.when(op.isin(_KNOWN), op).otherwise(A.NONE).alias("op"), action["value"].alias("value"), action["expiry"].cast("int").alias("expiry")
    )


def _by(group: list[str], order: str) -> Window:
    return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _running(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds ``_last``, the last answer that an earlier row fixed, and ``_since``, the turns after it, from ``_fixed`` and ``_turns``."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turned = rows.withColumn("_turned", F.sum("_turns").over(_by(group, order)))
    fixed = F.when(F.col("_fixed").isNotNull(), F.struct("_fixed", "_turned"))
    turned = turned.withColumn("_fix", F.last(fixed, ignorenulls=True).over(earlier))
    since = F.coalesce(F.lag("_turned").over(Window.partitionBy(*group).orderBy(order)), F.lit(0))
    turned = turned.withColumn("_since", since - F.coalesce("_fix._turned", F.lit(0)))
    return turned.withColumn("_last", F.col("_fix._fixed")).drop("_turned", "_fix")


def _known(running: DataFrame, start: Column) -> DataFrame:
    """Adds ``before``: whether there is a document before each row, given whether there was one at the start."""
    begin = F.coalesce("_last", start, F.lit(False))
    return running.withColumn("before", begin != (F.col("_since") % 2 == 1))


def _live() -> Column:
    no_text = F.raise_error(F.concat(F.lit("the document of key "), "doc_id", F.lit(" has a null text"))).cast("boolean")
    return F.when(F.col("live") & F.col("bare"), no_text).otherwise(F.col("live"))


def _kept() -> Column:
    return F.coalesce(F.col("a.value").contains(_OLD), F.lit(False))


def _fitting() -> Column:
    """The action ``a``, which is an error where it cannot be said without the old text."""
    fits = F.col("a.op").isin(A.SET, A.REPLACE) & (F.size(F.split("a.value", _OLD)) == 2)
    wrong = F.raise_error(F.concat(F.lit("the merge of key "), "doc_id", F.lit(" cannot be composed"))).cast("string")
    return F.col("a").withField("value", F.when(_kept() & ~fits, wrong).otherwise(F.col("a.value")))


def _pieces() -> Column:
    """The actions that one merged action is applied as: around a kept text, one for its expiry and one for either side."""
    a, around = F.col("a"), F.split("a.value", _OLD)

    def act(op: str, value: Column, expiry: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), value.alias("value"), expiry.cast("int").alias("expiry"))

    sides = F.array(
        act(A.TOUCH, F.lit(None).cast("string"), a["expiry"]),
        act(A.PREPEND, around[0], F.lit(0)),
        act(A.APPEND, F.get(around, F.lit(1)), F.lit(0)),
    )
    single = F.array(F.struct(a["op"].alias("op"), a["value"].alias("value"), a["expiry"].alias("expiry")))
    return F.when(_kept(), sides).otherwise(single)


def _summary(acts: DataFrame) -> DataFrame:
    op, before = F.col("a.op"), F.col("before")
    known = op != A.NONE
    ok = known & F.when(op == A.SET, True).when(op == A.ADD, ~before).otherwise(before)
    counts = {
        "stored": ok,
        "already_exists": ~ok & (op == A.ADD),
        "missing": ~ok & known & (op != A.ADD),
        "missing_touched": ~ok & (op == A.TOUCH),
        "ignored": ~known,
    }
    return acts.groupBy("doc_id").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])

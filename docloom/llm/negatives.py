"""Hard negatives: a threshold algorithm over sorted lists of components, within score windows set by an anchor's positives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import in_order, stored, with_row_number
from docloom.llm.vectors import LARGEST, grid, inner_products, matrix, slices, whole_vectors

#: Blocks are made larger rather than more than this many; their labels are sent to every task.
MAX_BLOCKS = 16_384
#: Entries of each list that are read before the first look at the threshold; then twice as many each time.
FIRST_READS = 32


class SortedLists:
    """The rows of a block with one list for each dimension, in the order of that component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.order = np.argsort(rows, axis=0, kind="stable")

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """
        Rows by sorted access, a few entries of every list at a time: those seen first now, their scores, the threshold.

        A list is read from its largest component where the anchor's is positive, from its smallest where it is negative,
        and not at all where it is zero. No row that is still unseen can score above the threshold, the anchor's inner
        product with the components read last. Scores come by random access to whole rows. After the last entry the
        threshold is minus infinity.
        """
        n = len(self.ids)
        down, up = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(down) and not len(up):
            yield np.arange(n), np.zeros(n, np.int64), -np.inf
            return
        of_lists = np.concatenate([anchor[down], anchor[up]])
        seen = np.zeros(n, bool)
        depth, reads = 0, FIRST_READS
        while depth < n:
            upto = min(n, depth + reads)
            met = np.zeros(n, bool)
            met[self.order[n - upto : n - depth, down]] = True
            met[self.order[depth:upto, up]] = True
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            ends = np.concatenate([self.rows[self.order[n - upto, down], down], self.rows[self.order[upto - 1, up], up]])
            with np.errstate(over="ignore", invalid="ignore"):
                # Rounded up: where doubles are not exact, a threshold that is too high, or none, only reads on.
                last = of_lists @ ends + 1e-12 * (np.abs(of_lists) @ np.abs(ends))
            yield fresh, inner_products(anchor[None, :], self.rows[fresh])[0], last if upto < n else -np.inf
            depth, reads = upto, 2 * reads

    def positives(self, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best other rows of the anchor's label."""
        at, score = np.zeros(0, int), np.zeros(0, np.int64)
        for fresh, scores, threshold in self.read(anchor):
            wanted = (self.labels[fresh] == label) & (self.ids[fresh] != anchor_id)
            at, score = self._best(np.append(at, fresh[wanted]), np.append(score, scores[wanted]), k)
            if len(at) == k and threshold < score[-1]:
                break
        return at, score

    def negatives(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window ``(low, high)`` of scores, places and scores of its ``k`` best rows of other labels."""
        best = [(np.zeros(0, int), np.zeros(0, np.int64)) for _ in windows]
        for fresh, scores, threshold in self.read(anchor):
            other = self.labels[fresh] != label
            fresh, scores = fresh[other], scores[other]
            going = False
            for i, (low, high) in enumerate(windows):
                inside = (scores >= low) & (scores <= high)
                at, score = best[i] = self._best(np.append(best[i][0], fresh[inside]), np.append(best[i][1], scores[inside]), k)
                # Over once no unseen row can reach the window, or the k-th row in it.
                going |= low <= high and not (threshold < low or (len(at) == k and threshold < score[-1]))
            if not going:
                break
        return best

    def _best(self, at: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(at) > k:
            kept = score >= np.partition(score, len(at) - k)[len(at) - k]
            at, score = at[kept], score[kept]
        first = np.lexsort((self.ids[at], -score))[:k]
        return at[first], score[first]


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score s with ``low * positive <= 100 * s <= high * positive``, within longs; none if crossed."""
    least, most = -(-low * positive_score // 100), high * positive_score // 100
    return max(least, -LARGEST), min(most, LARGEST)


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    k: int = 10,
    low: int = 30,
    high: int = 90,
    factor: int = 256,
    block_rows: int = 8192,
    slice_rows: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: hard negatives of anchors and positives.

    Anchors are the rows whose id is divisible by ``every``. A row's score is its inner product with the anchor, over
    ``floor(factor * x)`` and so an exact integer; higher ones come first, ties by smaller id. An anchor's positives are
    its first ``positives`` other rows of its label (all, if fewer). For each of them come the first ``k`` (all, if fewer)
    rows of other labels whose score lies between ``low`` and ``high`` per cent of the positive's.

    Rows are laid in blocks in the order of their labels. An anchor meets the blocks that hold its label, then, with its
    windows known, all that hold another. Inside a block the threshold algorithm reads a sorted list for each dimension
    from the end that the anchor's sign asks for, scores the rows it meets, and stops once the threshold is strictly
    below the ``k``-th score of every window (or below the window). What the blocks give is ranked by anchor and score.
    Nothing is sampled, and lists are read to their end where nothing stops them.

    Rows with a null label, without an id, or whose vector is null or holds null or non-finite components take no part.
    Zero vectors do. A row given twice counts once; of different rows under one id the least (by label, then vector)
    counts. Vectors of another width than the anchor's have no score. A positive of negative score has an empty window; one
    of score 0 asks for scores of 0. Scores beyond a long are given as the nearest long. An empty table gives no rows.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    label_of = F.col(label).cast("long")
    whole = stored(whole_vectors(vectors, factor, vec_id, embedding, label=label_of), "negatives")
    rows, asking = whole.select(F.count("*"), F.count_if(F.col("id") % every == 0)).first()
    if not rows:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    parts = slices(asking, slice_rows)
    size = max(block_rows, -(-rows // MAX_BLOCKS))
    # Blocks are cut along the whole order, so they are as few as their size allows, however it is partitioned.
    placed = with_row_number(in_order(whole, ["width", "label", "id"], "negatives-blocks"), "place")
    placed = placed.withColumn("block", F.floor(F.col("place") / size)).drop("at", "place")
    held = placed.groupBy("width", "block").agg(F.min("label").alias("first"), F.max("label").alias("last"))
    # In the order of labels: a block holds those from its first to its last, and no others.
    labels = spark.sparkContext.broadcast(
        {w: tuple(np.array(x) for x in (of["block"], of["first"], of["last"])) for w, of in held.toPandas().groupby("width")}
    )

    @F.pandas_udf("array<long>")
    def of_label(width: pd.Series, own: pd.Series) -> pd.Series:
        found = [labels.value[w] for w in width]
        return pd.Series([number[(first <= x) & (x <= last)] for (number, first, last), x in zip(found, own, strict=True)])

    @F.pandas_udf("array<long>")
    def of_other_labels(width: pd.Series, own: pd.Series) -> pd.Series:
        found = [labels.value[w] for w in width]
        return pd.Series([number[(first != x) | (x != last)] for (number, first, last), x in zip(found, own, strict=True)])

    def near(asked: pa.Table, entries: pa.Table) -> pa.Table:
        lists = SortedLists(entries["id"].to_numpy(), entries["label"].to_numpy(), matrix(entries["v"]))
        out = []
        for a, own, v in zip(asked["id"].to_pylist(), asked["label"].to_pylist(), matrix(asked["v"]), strict=True):
            at, score = lists.positives(a, own, v, positives)
            out += zip([a] * len(at), lists.ids[at].tolist(), score.tolist(), strict=True)
        return _table(out, ["anchor_id", "positive_id", "positive_score"])

    def hard(asked: pa.Table, entries: pa.Table) -> pa.Table:
        lists = SortedLists(entries["id"].to_numpy(), entries["label"].to_numpy(), matrix(entries["v"]))
        out = []
        columns = (asked["id"].to_pylist(), asked["label"].to_pylist(), asked["scores"].to_pylist(), matrix(asked["v"]))
        for a, own, scores, v in zip(*columns, strict=True):
            found = lists.negatives(own, v, [window(s, low, high) for s in scores], k)
            for s, (at, score) in zip(scores, found, strict=True):
                out += zip([a] * len(at), [s] * len(at), lists.ids[at].tolist(), score.tolist(), strict=True)
        return _table(out, ["anchor_id", "positive_score", "negative_id", "negative_score"])

    def met(asked: DataFrame, compare, form: str) -> DataFrame:
        asked, here = grid(asked, placed)
        cell = ("width", "block", "slice")
        return asked.groupBy(*cell).cogroup(here.groupBy(*cell)).applyInArrow(compare, form)

    anchors = whole.where(F.col("id") % every == 0).withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(parts)))
    close = met(
        anchors.withColumn("block", F.explode(of_label("width", "label"))),
        near, "anchor_id long, positive_id long, positive_score long",
    )
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    close = close.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives).drop("place")
    close = stored(close, "negatives-positives")
    # Positives of one score share a window.
    windows = close.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("scores"))
    found = met(
        anchors.join(windows, "id").withColumn("block", F.explode(of_other_labels("width", "label"))),
        hard, "anchor_id long, positive_score long, negative_id long, negative_score long",
    )
    first = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return close.join(ranked, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

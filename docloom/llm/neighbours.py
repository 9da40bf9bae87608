"""Approximate nearest neighbours: a forest of random-projection trees, one queue per query over all trees, exact ranks."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import dropped, stored
from docloom.llm.vectors import slices


@dataclass(frozen=True)
class Forest:
    """
    Trees as arrays over all nodes: direction and threshold of inner nodes, children, and a leaf number or -1.

    ``roots`` has one node for each tree.
    """

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaf: np.ndarray
    roots: np.ndarray

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        at = np.repeat(self.roots[None, :], len(vectors), axis=0)
        while (inner := self.leaf[at] < 0).any():
            row, tree = np.nonzero(inner)
            node = at[row, tree]
            side = np.einsum("ij,ij->i", vectors[row], self.directions[node]) > self.thresholds[node]
            at[row, tree] = self.children[node, side.astype(int)]
        return self.leaf[at]

    def probe(self, vector: np.ndarray, rows: np.ndarray, enough: float) -> list[int]:
        """Leaves in the order of one queue over all trees, until they hold ``enough`` rows; a branch waits at its margin."""
        margins = self.directions @ vector - self.thresholds
        queue = [(0.0, int(r)) for r in self.roots]
        heapq.heapify(queue)
        found, held = [], 0
        while queue and held < enough:
            wait, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                side = int(margins[node] > 0)
                heapq.heappush(queue, (wait + margins[node] ** 2, int(self.children[node, 1 - side])))
                node = int(self.children[node, side])
            if rows[self.leaf[node]]:
                found.append(int(self.leaf[node]))
                held += int(rows[self.leaf[node]])
        return found


def grow(sample: np.ndarray, trees: int, leaf_rows: int, seed: int) -> Forest:
    """Each node splits its part of the sample in half, across the line between two of its rows."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    directions, thresholds, children, leaf, roots = [], [], [], [], []
    leaves = 0

    def node() -> int:
        directions.append(np.zeros(width))
        thresholds.append(0.0)
        children.append([-1, -1])
        leaf.append(-1)
        return len(leaf) - 1

    for _ in range(trees):
        roots.append(node())
        rest = [(roots[-1], np.arange(len(sample)))]
        while rest:
            at, rows = rest.pop()
            if len(rows) > leaf_rows:
                a, b = sample[rng.choice(rows, 2, replace=False)]
                direction = (a - b) / max(np.linalg.norm(a - b), 1e-12)
                along = sample[rows] @ direction
                threshold = float(np.median(along))
                right = along > threshold
                if right.any() and not right.all():
                    directions[at], thresholds[at] = direction, threshold
                    children[at] = [node(), node()]
                    rest += [(children[at][0], rows[~right]), (children[at][1], rows[right])]
                    continue
            leaf[at] = leaves
            leaves += 1
    return Forest(np.array(directions), np.array(thresholds), np.array(children), np.array(leaf), np.array(roots))


def entries_before(forest: Forest, query: np.ndarray, rows: np.ndarray, leaves: np.ndarray) -> list[int]:
    """For each row of ``leaves``, those of one neighbour, the entries held when the query's queue reaches the first of them."""
    order = forest.probe(query, rows, np.inf)
    before = np.concatenate([[0], np.cumsum(rows[order])[:-1]]) if order else np.zeros(0, int)
    at = dict(zip(order, before.tolist(), strict=True))
    return [min((at[x] for x in of if x in at), default=0) for of in leaves.tolist()]


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    trees: int = 16,
    sample_rows: int = 16_384,
    leaf_rows: int = 64,
    share: float | None = None,
    least_entries: int = 800,
    recall: float = 0.95,
    measured_queries: int = 48,
    block_rows: int = 4096,
    slice_rows: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    seed: int = 7,
) -> DataFrame:
    """
    ``query_id, rank, vec_id, score``: the ``k`` nearest of each row whose id is divisible by ``every``, by distance.

    The trees are grown on a bounded sample (the ``sample_rows`` vectors of smallest hash), with ``leaf_rows`` sample
    rows in a leaf. Every vector is then indexed under its leaf in each tree. A query opens leaves by one queue shared by
    all trees until they hold enough entries; the vectors met there are ranked by exact distance on the original
    components, ties by id. How many are enough is measured: for ``measured_queries`` queries the true neighbours are
    found by brute force, and the share ``recall`` of them must be within what is opened. Clustered vectors take few
    entries, 64 independent dimensions over half. With ``share`` given, it is that share of the entries of one tree; at
    least ``least_entries`` are opened in any case.

    Vectors that are null, all zero, of another length than most, or that hold null or non-finite components take no
    part; nor do rows without an id. Equal vectors are one index entry with their ``k + 1`` smallest ids, so copies in any
    number cost nothing and lose nothing. A row given twice counts once; of different vectors under one query id the
    least is asked. Leaves with many rows are searched in blocks of about ``block_rows``, by slices of about ``slice_rows``
    queries, so that one task meets no more of both however many there are. Fewer than ``k`` others: all
    of them. An empty table gives none. Other columns are not read.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    usable = given.where("id IS NOT NULL AND v IS NOT NULL").where(finite & F.exists("v", lambda x: x != 0))
    usable = usable.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    lengths = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    form = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], form)
    width = lengths[0].n
    usable = usable.where(F.size("v") == width)
    marked = usable.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    first = Window.partitionBy("h1", "h2").orderBy("id")
    few = marked.dropDuplicates(["h1", "h2", "id"]).withColumn("place", F.row_number().over(first))
    few = few.where(F.col("place") <= k + 1)
    classes = few.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
    classes = stored(classes.select(F.col("ids")[0].alias("first_id"), "ids", "v", "h1"), "neighbours")

    sample = classes.orderBy("h1", "first_id").limit(sample_rows).select("v").collect()
    forest = spark.sparkContext.broadcast(grow(np.array([r.v for r in sample]), trees, leaf_rows, seed))

    @F.pandas_udf("array<int>")
    def leaves(values: pd.Series) -> pd.Series:
        return pd.Series(list(forest.value.leaves_of(np.stack(values.to_numpy())).astype(np.int32)))

    index = stored(classes.withColumn("leaf", F.explode(leaves("v"))).drop("h1"), "neighbours-index")
    rows = np.zeros(int(forest.value.leaf.max()) + 1, np.int64)
    for r in index.groupBy("leaf").count().collect():
        rows[r.leaf] = r["count"]
    counted = spark.sparkContext.broadcast(rows)
    queries = usable.where(F.col("id") % every == 0).groupBy(F.col("id").alias("query_id")).agg(F.min("v").alias("q"))
    least = max(least_entries, trees * (k + 1))
    if share is None:
        measured = queries.orderBy(F.xxhash64("query_id")).limit(measured_queries).collect()
        enough = max(least, _entries_for(classes, [np.array(r.q) for r in measured], forest, rows, k, recall))
    else:
        enough = share * rows.sum() / trees + least
    dropped(classes)

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for query, v in zip(batch["query_id"], batch["q"], strict=True):
                found = forest.value.probe(np.asarray(v), counted.value, enough)
                yield pd.DataFrame({"query_id": query, "leaf": np.array(found, np.int32), "q": [v] * len(found)})

    asked = queries.mapInPandas(probes, "query_id long, leaf int, q array<double>")

    @F.pandas_udf("int")
    def blocks(of_leaf: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(1, -(-counted.value[of_leaf.to_numpy()] // block_rows)).astype(np.int32))

    here = index.withColumn("block", F.pmod(F.xxhash64("first_id"), blocks("leaf")).cast("int"))
    parts = slices(queries.count(), slice_rows)
    asked = asked.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), blocks("leaf") - 1)))
    if parts == 1:
        here = here.withColumn("slice", F.lit(0))
    else:
        needed = asked.select(F.col("leaf").alias("of"), F.col("block").alias("of_block"), F.col("slice").alias("for_slice")).distinct()
        here = here.join(needed, (F.col("leaf") == F.col("of")) & (F.col("block") == F.col("of_block")))
        here = here.drop("of", "of_block").withColumnRenamed("for_slice", "slice")

    def rank(key: tuple, questions: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(questions) or not len(entries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        v, firsts, ids = np.stack(entries["v"].to_numpy()), entries["first_id"].to_numpy(), entries["ids"].to_numpy()
        out = []
        for query, q in zip(questions["query_id"], questions["q"], strict=True):
            d = np.sqrt(((v - np.asarray(q)) ** 2).sum(axis=1))
            if len(d) > k + 1:
                near = np.flatnonzero(d <= np.partition(d, k)[k])
            else:
                near = np.arange(len(d))
            near = near[np.lexsort((firsts[near], d[near]))][: k + 1]
            found = sorted((d[i], other) for i in near for other in ids[i] if other != query)[:k]
            out += [(query, other, s) for s, other in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    cell = ("leaf", "block", "slice")
    met = asked.groupBy(*cell).cogroup(here.groupBy(*cell))
    met = met.applyInPandas(rank, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _entries_for(classes: DataFrame, queries: list[np.ndarray], forest, rows: np.ndarray, k: int, recall: float) -> float:
    """Entries that queries have to open so that ``recall`` of the true neighbours of these are among them."""
    if not queries:
        return 0.0
    asked = np.stack(queries)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [np.zeros((0, asked.shape[1])) for _ in asked]
        for batch in batches:
            v = np.stack(batch["v"].to_numpy()) if len(batch) else best[0]
            for i, q in enumerate(asked):
                both = np.concatenate([best[i], v])
                d = ((both - q) ** 2).sum(axis=1)
                both, d = both[d > 0], d[d > 0]
                best[i] = both[np.argsort(d, kind="stable")[:k]]
        for i, q in enumerate(asked):
            if len(best[i]):
                d = ((best[i] - q) ** 2).sum(axis=1)
                yield pd.DataFrame({"query": i, "d": d, "leaves": list(forest.value.leaves_of(best[i]).astype(np.int32))})

    found = classes.select("v").mapInPandas(near, "query int, d double, leaves array<int>")
    place = F.row_number().over(Window.partitionBy("query").orderBy("d"))
    found = found.withColumn("place", place).where(F.col("place") <= k).select("query", "leaves").toPandas()
    needed: list[int] = []
    for i, of in found.groupby("query"):
        needed += entries_before(forest.value, queries[i], rows, np.stack(of["leaves"].to_numpy()))
    # A leaf is opened as long as fewer entries than enough are held before it.
    return float(np.quantile(needed, recall, method="higher")) + 1 if needed else 0.0

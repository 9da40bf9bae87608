"""Exact top-k by inner product: segment means and deviations bound every score, coarse to fine, and survivors are computed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import in_order, stored, with_row_number
from docloom.llm.vectors import LARGEST, grid, inner_products, matrix, slices, whole_vectors

#: Segments of a vector at each resolution, and those that blocks of rows are summed up by.
LEVELS, BLOCK_LEVEL = (1, 4, 16, 32), 8
#: Blocks are made larger rather than more than this many; their bounds are sent to every task.
MAX_BLOCKS = 16_384
#: Rows of a block that are bounded together, between two looks at what is known by then.
_TOGETHER = 2048
#: Bounds are rounded up by this share of the product of the norms, far above what doubles can be off by.
_SLACK = 1e-10


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """
    Mean and deviation of every segment of each row, both times the root of the segment's length: means first.

    The inner product of two such rows bounds the inner product of the vectors from above, because in a segment the
    parts around the means have at most the product of the deviations (Cauchy-Schwarz). With the norms it is the same as
    the lower bound of the distance, the sum over segments of length * ((mean - mean')^2 + (deviation - deviation')^2).
    """
    width = rows.shape[1]
    edges = np.unique(np.linspace(0, width, min(segments, width) + 1).astype(int))[:-1]
    if not len(edges):
        return np.zeros((len(rows), 0))
    length = np.diff(np.append(edges, width))
    with np.errstate(over="ignore", invalid="ignore"):
        total = np.add.reduceat(rows, edges, axis=1)
        squares = np.add.reduceat(rows**2, edges, axis=1)
        # A difference of nearly equal squares can come out too small; what it can be off by is added.
        spread = np.maximum(squares - total**2 / length, 0.0) + 1e-13 * squares
        return np.hstack([total / np.sqrt(length), np.sqrt(spread)])


def norms(rows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((rows**2).sum(axis=1))


def slack(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """By how much bounds are raised, from the norms of both sides."""
    with np.errstate(over="ignore", invalid="ignore"):
        return _SLACK * queries[:, None] * rows


def bounds(queries: np.ndarray, rows: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Inner products of statistics and what they can be off by; what doubles cannot hold is no bound, so infinity."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num(queries @ rows + slack, nan=np.inf, posinf=np.inf, neginf=-np.inf)


class Blocks:
    """Bounds of blocks of rows: the range of every segment mean, the largest deviations, the largest norm, the row count."""

    def __init__(self, rows: list):
        self.of: dict[int, tuple] = {}
        by_width: dict[int, list] = {}
        for r in rows:
            by_width.setdefault(r.width, []).append(r)
        for width, found in by_width.items():
            found.sort(key=lambda r: r.block)
            high, low, deviation = (np.array([getattr(r, n) for r in found], float) for n in ("high", "low", "deviation"))
            number, rows_of = np.array([r.block for r in found]), np.array([r.rows for r in found])
            sides = np.hstack([high, low, deviation]).T if width else np.zeros((0, len(found)))
            self.of[width] = number, rows_of, sides, np.array([r.norm for r in found])

    def best_scores(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and row counts of the blocks of the queries' width, and what no row of each can exceed."""
        number, rows, sides, norm = self.of[queries.shape[1]]
        mean, deviation = np.split(segment_statistics(queries, BLOCK_LEVEL), 2, axis=1)
        asked = np.hstack([np.maximum(mean, 0), np.minimum(mean, 0), deviation])
        return number, rows, bounds(asked, sides, slack(norms(queries), norm))

    def homes(self, best: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        """For each query, whether a block is among the most promising ones that hold over ``k`` rows."""
        order = np.argsort(-best, axis=1, kind="stable")
        before = np.cumsum(rows[order], axis=1) - rows[order]
        chosen = np.zeros(best.shape, bool)
        np.put_along_axis(chosen, order, before <= k, axis=1)
        return chosen


def best_in_block(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """
    Places of queries, ids and scores: for each query the ``k`` best rows of this block that reach its floor.

    At every resolution, pairs whose bound lies under the floor go, and rows that no query needs any more are not looked
    at by the next. Exact scores are computed for what is left, and raise the floors for the rows that follow.
    """
    place, found, score = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, np.int64)
    floors, reach = floors.astype(float), norms(queries)
    levels = [m for m in LEVELS if m < rows.shape[1]]
    asked = [segment_statistics(queries, m) for m in levels]
    for start in range(0, len(ids), _TOGETHER):
        some, some_ids = rows[start : start + _TOGETHER], ids[start : start + _TOGETHER]
        size = norms(some)
        alive = query_ids[:, None] != some_ids[None, :]
        for m, q in zip(levels, asked, strict=True):
            at = np.flatnonzero(alive.any(axis=0))
            alive[:, at] &= bounds(q, segment_statistics(some[at], m).T, slack(reach, size[at])) >= floors[:, None]
        at, of = np.flatnonzero(alive.any(axis=0)), np.flatnonzero(alive.any(axis=1))
        if not len(at):
            continue
        exact = np.where(alive[np.ix_(of, at)], inner_products(queries[of], some[at]), -LARGEST - 1)
        if len(at) > k:
            kth = np.partition(exact, len(at) - k, axis=1)[:, len(at) - k]
            kept = exact >= np.maximum(kth, -LARGEST)[:, None]
        else:
            kept = exact >= -LARGEST
        kept &= exact >= floors[of][:, None]
        q, c = np.nonzero(kept)
        place, found = np.append(place, of[q]), np.append(found, some_ids[at][c])
        score = np.append(score, exact[q, c])
        best = np.lexsort((found, -score, place))
        place, found, score = place[best], found[best], score[best]
        first = np.searchsorted(place, place)
        kept = np.arange(len(place)) - first < k
        place, found, score = place[kept], found[kept], score[kept]
        full = np.flatnonzero(np.bincount(place, minlength=len(queries)) >= k)
        if len(full):
            last = np.searchsorted(place, full, side="right") - 1
            floors[full] = np.maximum(floors[full], score[last].astype(float))
    return place, found, score


def search(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    factor: int = 64,
    block_rows: int = 8192,
    slice_rows: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """
    ``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` the ``k`` other rows of highest score.

    The score is the inner product of the vectors of ``floor(factor * x)``, an exact integer; ties go to the smaller id.
    Rows are laid in blocks of about ``block_rows`` in the order of their coarse statistics, and a block is summed up by
    ranges of its segment statistics. Each query first looks into the blocks that promise most; its ``k``-th score there is
    a floor, and only blocks whose bound reaches it are looked into as well. Within a block, bounds of 1, 4, 16 and 32
    segments rule rows out before scores are computed. Nothing is sampled and no candidate is left out: a row is skipped
    only if a bound shows that it cannot be among the ``k`` best. Vectors in which nothing is near are compared with all.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without an id. Zero vectors do.
    Vectors of another width than the query's have no inner product with it and are no candidates. A row given twice
    counts once; of different vectors under one id the least counts. Fewer than ``k`` others: all of them. Components of
    any size are computed exactly; scores beyond a long are given as the nearest long, and rank as equal. An empty table
    gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    whole = stored(whole_vectors(vectors, factor, vec_id, embedding), "topk")
    rows, asking = whole.select(F.count("*"), F.count_if(F.col("id") % every == 0)).first()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = slices(asking, slice_rows)
    # Blocks are cut along the whole order, so they are as few as their size allows, however it is partitioned.
    placed = with_row_number(in_order(_coarse(whole), ["width", "code", "mean"], "topk-blocks"), "place")
    size = max(block_rows, -(-rows // MAX_BLOCKS))
    placed = placed.select("id", "width", "v", F.floor(F.col("place") / size).alias("block"))

    ranges = placed.mapInArrow(_summed, "width int, block long, segment int, low double, high double, deviation double, norm double, rows long")
    ranges = ranges.groupBy("width", "block", "segment").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("deviation").alias("deviation"),
        F.max("norm").alias("norm"), F.sum("rows").alias("rows"),
    )
    by_segment = ranges.groupBy("width", "block").agg(
        F.array_sort(F.collect_list(F.struct("segment", "low", "high", "deviation"))).alias("s"),
        F.max("norm").alias("norm"), F.max("rows").alias("rows"),
    )
    whole_range = by_segment.select("width", "block", "s.low", "s.high", "s.deviation", "norm", "rows")
    blocks = spark.sparkContext.broadcast(Blocks(whole_range.collect()))

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its homes, the most promising blocks that together hold more than ``k`` rows."""
        for batch in batches:
            for of in _by_width(batch):
                number, counts, best = blocks.value.best_scores(matrix(of["v"]))
                homes = [number[chosen] for chosen in blocks.value.homes(best, counts, k)]
                yield from of.append_column("homes", pa.array(homes, pa.list_(pa.int64()))).to_batches()

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with every further block whose bound reaches its floor."""
        for batch in batches:
            for of in _by_width(batch):
                number, _, best = blocks.value.best_scores(matrix(of["v"]))
                wanted = best >= of["floor"].to_numpy().astype(float)[:, None]
                for i, homes in enumerate(of["homes"].to_pylist()):
                    wanted[i, np.isin(number, homes)] = False
                q, b = np.nonzero(wanted)
                for start in range(0, len(q), 1024):
                    part = of.take(q[start : start + 1024]).append_column("block", pa.array(number[b[start : start + 1024]]))
                    yield from part.select(["id", "width", "slice", "v", "floor", "block"]).to_batches()

    def compare(asked: pa.Table, entries: pa.Table) -> pa.Table:
        query_ids, queries, floors = asked["id"].to_numpy(), matrix(asked["v"]), asked["floor"].to_numpy()
        at, found, score = best_in_block(entries["id"].to_numpy(), matrix(entries["v"]), query_ids, queries, floors, k)
        return pa.table({"query_id": query_ids[at], "vec_id": found, "score": score})

    def met(asked: DataFrame) -> DataFrame:
        asked, here = grid(asked, placed)
        cell = ("width", "block", "slice")
        pairs = asked.groupBy(*cell).cogroup(here.groupBy(*cell))
        return pairs.applyInArrow(compare, "query_id long, vec_id long, score long")

    queries = whole.where(F.col("id") % every == 0).select("id", "width", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("slice"), "v")
    form = "id long, width int, slice long, v array<double>"
    queries = stored(queries.mapInArrow(promising, f"{form}, homes array<long>"), "topk-queries")
    no_floor = F.lit(-LARGEST).cast("long").alias("floor")
    at_home = stored(met(queries.select("id", "width", "slice", "v", no_floor, F.explode("homes").alias("block"))), "topk-homes")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = at_home.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    floors = kth.select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    known = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", no_floor))
    beyond = met(known.mapInArrow(others, f"{form}, floor long, block long"))
    ranked = at_home.unionByName(beyond).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _by_width(batch: pa.RecordBatch) -> list[pa.Table]:
    width, table = batch["width"].to_numpy(), pa.Table.from_batches([batch])
    return [table.take(np.flatnonzero(width == w)) for w in np.unique(width)]


def _coarse(whole: DataFrame) -> DataFrame:
    """Adds ``mean`` and ``code``, a bit for each of eight segments: whether its mean lies above that of all rows."""

    def mean(i: int):
        start, end = (F.floor(F.col("width") * j / BLOCK_LEVEL).cast("int") for j in (i, i + 1))
        part = F.slice("v", start + 1, end - start)
        return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.greatest(end - start, F.lit(1))

    means = whole.withColumn("m", F.array(*[mean(i) for i in range(BLOCK_LEVEL)]))
    middle = means.select(*[F.avg(F.col("m")[i]) for i in range(BLOCK_LEVEL)]).first()
    bits = [F.when(F.col("m")[i] > F.lit(middle[i]), 1 << i).otherwise(0) for i in range(BLOCK_LEVEL)]
    code = sum(bits[1:], bits[0])
    return means.select("id", "width", "v", code.alias("code"), F.aggregate("m", F.lit(0.0), lambda a, x: a + x).alias("mean"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every block met in a batch: row count, largest norm, and the range of each segment's statistics."""
    for batch in batches:
        width, number = batch["width"].to_numpy(), batch["block"].to_numpy()
        out = []
        for w, b in np.unique(np.stack([width, number]), axis=1).T:
            at = np.flatnonzero((width == w) & (number == b))
            rows = matrix(pa.chunked_array([batch["v"].take(pa.array(at))]))
            mean, deviation = np.split(segment_statistics(rows, BLOCK_LEVEL), 2, axis=1)
            sides = zip(mean.min(axis=0), mean.max(axis=0), deviation.max(axis=0), strict=True)
            # A vector of no components has no segments; an empty range stands for them.
            for segment, (low, high, most) in enumerate(sides if w else [(0.0, 0.0, 0.0)]):
                out.append((w, b, segment, low, high, most, norms(rows).max(), len(at)))
        columns = list(zip(*out, strict=True)) or [[]] * 8
        names = ["width", "block", "segment", "low", "high", "deviation", "norm", "rows"]
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.float64()] * 4, pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(map(t.to_pandas_dtype(), c)), t) for c, t in zip(columns, kinds, strict=True)], names)

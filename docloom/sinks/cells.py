"""Cell tables: ``(row_key, family, qualifier, value)`` as Parquet, in one piece or in ranges of row keys.

A table in ranges keeps its split points. Cells are sorted by row key within a range, and a later load rewrites only the
ranges it meets; of two puts to one cell the later load's stays.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.schemas import CELLS, conform
from docloom.sources.tables import hadoop_path
from docloom.sources.versions import publish, read_version, versions

_SAMPLE = 10_000  # row keys from which split points are taken
_CELL = ("row_key", "family", "qualifier")


def write_cells(cells: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    conform(cells, CELLS).write.mode(mode).partitionBy("family").parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELLS).parquet(path).select(*CELLS.names)


def load_cells(cells: DataFrame, root: str, *, ranges: int = 64) -> int:
    """Load cells into the table in ranges under ``root``; the table's version after it.

    The first load chooses ``ranges`` - 1 split points from a sample of its row keys; they stay. A load moves its own cells
    and those of the ranges it meets. A cell put more than once in one load is an error, as it is not said which is last
    (:func:`to_cells` leaves one). Older versions stay readable.
    """
    spark, new = cells.sparkSession, conform(cells, CELLS)
    if versions(spark, root):
        version, contents = read_version(spark, root)
    else:
        version, contents = 0, {"splits": _splits(new, ranges), "writes": {}}
    splits = [bytes.fromhex(s) for s in contents["splits"]]
    placed = new.withColumn("range", _range_of(splits))
    met = sorted(r["range"] for r in placed.select("range").distinct().collect())
    old = {str(n): contents["writes"][str(n)] for n in met if str(n) in contents["writes"]}
    both = placed.withColumn("put", F.lit(1)).unionByName(
        _read(spark, root, old).withColumn("range", _range_of(splits)).withColumn("put", F.lit(0))
    )
    last = F.max_by("value", "put").alias("value")
    twice = F.when(F.count_if(F.col("put") == 1) > 1, F.raise_error(F.lit("several puts to one cell in a load")))
    merged = both.groupBy("range", *_CELL).agg(last, twice.cast("string").alias("twice"))
    merged = merged.where(F.col("twice").isNull()).drop("twice")
    name = uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/data/{name}"
    by_range = merged.repartition(max(1, len(met)), "range").sortWithinPartitions("range", *_CELL)
    by_range.write.partitionBy("range").parquet(folder)
    path, fs = hadoop_path(spark, folder)
    written = {s.getPath().getName().removeprefix("range="): name for s in fs.listStatus(path) if "=" in s.getPath().getName()}
    return publish(spark, root, version + 1, contents | {"writes": contents["writes"] | written})


def read_loaded_cells(
    spark: SparkSession, root: str, low: bytes | None = None, high: bytes | None = None, version: int | None = None
) -> DataFrame:
    """Cells of the table in ranges, of row keys from ``low`` up to but without ``high`` if given.

    Only the folders of ranges that can hold such keys are opened; inside a range, statistics of sorted row keys prune.
    """
    _, contents = read_version(spark, root, version)
    splits = [bytes.fromhex(s) for s in contents["splits"]]
    first = bisect_right(splits, low) if low is not None else 0
    last = bisect_right(splits, high) if high is not None else len(splits)
    cells = _read(spark, root, {n: w for n, w in contents["writes"].items() if first <= int(n) <= last})
    if low is not None:
        cells = cells.where(F.col("row_key") >= F.lit(low))
    return cells if high is None else cells.where(F.col("row_key") < F.lit(high))


def _splits(cells: DataFrame, ranges: int) -> list[str]:
    """Hexadecimal split points: quantiles of the row keys with the smallest hashes."""
    keys = cells.select("row_key").distinct().orderBy(F.xxhash64("row_key")).limit(_SAMPLE).collect()
    ordered = sorted(bytes(r["row_key"]) for r in keys)
    return sorted({ordered[i * len(ordered) // ranges].hex() for i in range(1, ranges)} if ordered else set())


def _range_of(splits: list[bytes]) -> Column:
    """Number of split points up to the row key."""
    if not splits:
        return F.lit(0)
    points = F.array(*[F.lit(s) for s in splits])
    return F.size(F.filter(points, lambda s: s <= F.col("row_key")))


def _read(spark: SparkSession, root: str, writes: dict[str, str]) -> DataFrame:
    folders = [f"{root.rstrip('/')}/data/{w}/range={n}" for n, w in sorted(writes.items(), key=lambda x: int(x[0]))]
    return spark.read.schema(CELLS).parquet(*folders) if folders else spark.createDataFrame([], CELLS)

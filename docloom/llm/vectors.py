"""Vectors of whole numbers: which rows take part, exact inner products, and the grid in which all rows meet a query set."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Doubles hold whole numbers up to here exactly.
_EXACT = 2**53
#: Scores end here on both sides; the number below the least is left for "no score".
LARGEST = 2**63 - 1


def whole_vectors(vectors: DataFrame, factor: int, vec_id: str, embedding: str, **more: Column) -> DataFrame:
    """
    ``id, width, v`` and the columns ``more``: one row per id, every component ``floor(factor * x)`` as a double.

    Rows without an id, without a vector or with a null or non-finite component (also after the factor) are left out, and
    so are rows in which one of ``more`` is null. Of different rows under one id the least stays.
    """
    x = F.col(embedding).cast("array<double>")
    scaled = F.transform(x, lambda c: c * F.lit(float(factor)))
    # From 2^52 on a double is a whole number; below, floor() gives an exact long.
    whole = F.transform(scaled, lambda c: F.when(F.abs(c) < 2.0**52, F.floor(c).cast("double")).otherwise(c))
    given = vectors.select(F.col(vec_id).cast("long").alias("id"), scaled.alias("s"), whole.alias("v"), *[c.alias(n) for n, c in more.items()])
    finite = F.forall("s", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))) & ~F.isnan(c))
    given = given.where(F.col("id").isNotNull() & F.col("s").isNotNull() & finite).dropna(subset=["id", *more])
    least = given.groupBy("id").agg(F.min(F.struct(*more, "v")).alias("row"))
    return least.select("id", F.size("row.v").alias("width"), *[F.col(f"row.{n}").alias(n) for n in (*more, "v")])


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column, all of one width, as rows."""
    return pc.list_flatten(column).to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """
    ``a @ b.T`` of whole numbers as longs, exact; a product beyond a long becomes the nearest score, ``-LARGEST`` to ``LARGEST``.

    Doubles do it as long as no partial sum can leave their exact range; beyond, Python's own integers.
    """
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(1, a.shape[1]) < _EXACT:
        return (a @ b.T).astype(np.int64)
    integers = np.frompyfunc(int, 1, 1)
    left, right = integers(a), integers(b)
    return np.array([[max(-LARGEST, min(LARGEST, sum(map(int.__mul__, p, q)))) for q in right] for p in left], np.int64)


def slices(queries: int, slice_rows: int) -> int:
    """Into how many slices a query set of this size is cut."""
    return max(1, math.ceil(queries / slice_rows))


def grid(asked: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """
    Both sides of the cells ``(width, block, slice)`` in which queries meet rows.

    ``asked`` has a row for each query and block it has to look at, ``placed`` each row once with its block; a block is
    repeated for the slices that ask for it and for no others. A cell holds one block and one slice of queries at most.
    """
    needed = asked.select(F.col("width").alias("of_width"), F.col("block").alias("of_block"), F.col("slice").alias("for_slice")).distinct()
    here = placed.join(needed, (F.col("width") == F.col("of_width")) & (F.col("block") == F.col("of_block")))
    return asked, here.drop("of_width", "of_block").withColumnRenamed("for_slice", "slice")

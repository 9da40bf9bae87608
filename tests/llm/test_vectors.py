"""Exact top-k and hard negatives against plain loops in Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from docloom.llm import negatives, topk
from docloom.llm.queries import op11_negatives, op13_topk
from docloom.llm.vectors import LARGEST, inner_products

FORM = "vec_id long, embedding array<double>, label int, score string, width string, block string, slice string, id string, v string"
CLASH = ("mine",) * 6


def table(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], FORM)


def usable(rows, factor, labelled):
    """One row per id, whole numbers; the least of several (by label first where labels count)."""
    found = {}
    for i, v, label in rows:
        if i is None or v is None or (labelled and label is None) or any(x is None or not math.isfinite(x * factor) for x in v):
            continue
        whole = [math.floor(x * factor) for x in v]
        found.setdefault(i, []).append(((label if labelled else 0), whole))
    return {i: min(rest) for i, rest in found.items()}


def score(a, b):
    return max(-LARGEST, min(LARGEST, sum(x * y for x, y in zip(a, b, strict=True))))


def topk_by_hand(rows, every, k, factor=64):
    found = usable(rows, factor, False)
    out = []
    for q in sorted(i for i in found if i % every == 0):
        near = [(-score(found[q][1], v), i) for i, (_, v) in found.items() if i != q and len(v) == len(found[q][1])]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(near)[:k])]
    return out


def negatives_by_hand(rows, every, positives=5, k=10, low=30, high=90, factor=256):
    found = usable(rows, factor, True)
    out = []
    for a in sorted(i for i in found if i % every == 0):
        label, vector = found[a]
        near = [(-score(vector, v), i, own) for i, (own, v) in found.items() if i != a and len(v) == len(vector)]
        near.sort()
        for s, p, _ in [x for x in near if x[2] == label][:positives]:
            fit = [(n, i) for n, i, own in near if own != label and low * -s <= 100 * -n <= high * -s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fit[:k])]
    return out


def got(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(n, seed=3, width=16, centres=5, spread=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    return [(i, [float(x) for x in middle[i % centres] * 0.3 + spread * rng.normal(size=width)], int(rng.integers(4))) for i in range(n)]


def odd(rows):
    """Copies of one vector in all labels, ties, nulls, other widths, large and repeated rows."""
    same = rows[5][1]
    inf, nan = float("inf"), float("nan")
    extra = [(2000 + i, same, i % 3) for i in range(150)]
    extra += [(1, rows[1][1], rows[1][2]), (3, rows[4][1], 1), (None, same, 1), (3000, None, 1), (3020, [], 2), (3040, [], 1)]
    extra += [(3060, [0.0] * 16, 1), (3080, [None] * 16, 1), (3100, [inf] * 16, 2), (3120, [nan] + [1.0] * 15, 2)]
    extra += [(3140, [1.0, -2.0], 1), (3160, [-0.5, 2.0], 1), (3161, [-0.5, 3.0], 2), (3180, same, None)]
    extra += [(3200, [1e300] * 16, 1), (3220, [-1e17] * 16, 2), (3240, [1e308] * 16, 1), (3260, [3e8] * 16, 3), (-20, same, 0), (-100, same, 1)]
    return rows + extra


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 40, "slice_rows": 7}])
def test_topk_of_odd_rows(spark, sizes):
    rows = odd(vectors(400))
    assert got(topk.search(table(spark, rows), **sizes)) == sorted(topk_by_hand(rows, 20, 20))


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 40, "slice_rows": 3}])
def test_negatives_of_odd_rows(spark, sizes):
    rows = odd(vectors(400))
    found = got(negatives.hard_negatives(table(spark, rows), every=20, **sizes))
    assert found == sorted(negatives_by_hand(rows, 20))


def test_few_rows(spark):
    for rows in ([], [(0, None, 1)], [(20, [1.0], 1)], vectors(3), vectors(30, width=1), vectors(30, width=3)):
        assert got(topk.search(table(spark, rows))) == sorted(topk_by_hand(rows, 20, 20))
        assert got(negatives.hard_negatives(table(spark, rows), every=5)) == sorted(negatives_by_hand(rows, 5))


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    rows, queries = np.floor(64 * rng.normal(size=(300, 23))), np.floor(64 * rng.normal(size=(40, 23)))
    exact = queries @ rows.T
    before = np.full(exact.shape, np.inf)
    for segments in (1, 2, 4, 8, 23, 40):
        bound = topk.segment_statistics(queries, segments) @ topk.segment_statistics(rows, segments).T
        assert (bound >= exact - 1e-6).all()
        if segments in (1, 2, 4):  # halves of segments nest, so finer bounds are no weaker
            nested = segments == 1 or 23 % segments == 0
            assert not nested or (bound <= before + 1e-6).all()
            before = bound
    assert np.allclose(topk.segment_statistics(queries, 23) @ topk.segment_statistics(rows, 23).T, exact, atol=1)


def test_blocks_that_cannot_win_are_not_read():
    """Of well separated groups a query is compared with its own group's blocks only."""
    rng = np.random.default_rng(2)
    rows = np.concatenate([np.floor(64 * (5 * np.sign(rng.normal(size=32)) + 0.1 * rng.normal(size=(50, 32)))) for _ in range(20)])
    found = []
    for b in range(20):
        part = rows[50 * b : 50 * b + 50]
        mean, deviation = np.split(topk.segment_statistics(part, topk.BLOCK_LEVEL), 2, axis=1)
        row = {"width": 32, "block": b, "low": mean.min(0), "high": mean.max(0), "deviation": deviation.max(0)}
        found.append(type("Row", (), row | {"norm": topk.norms(part).max(), "rows": 50}))
    number, counts, best = topk.Blocks(found).best_scores(rows[::50])
    for q in range(20):
        exact = (rows[50 * q] @ rows.T).reshape(20, 50)
        assert (best[q] >= exact.max(axis=1)).all()
        kth = np.sort(np.delete(rows[50 * q : 50 * q + 50] @ rows[50 * q], 0))[-20]
        assert (best[q] >= kth).sum() < 10


def test_lists_are_not_read_to_their_end_where_something_stops_them():
    """Rows near the anchor's direction are met first, so that most of a block stays unread."""
    rng = np.random.default_rng(4)
    rows = np.floor(256 * np.concatenate([rng.normal(size=(40, 8)) * 0.05 + 2, rng.normal(size=(4000, 8)) * 0.05]))
    lists = negatives.SortedLists(np.arange(len(rows)), np.arange(len(rows)) % 2, rows)
    read = sum(len(fresh) for fresh, _, threshold in lists.read(rows[0]))
    assert read == len(rows)
    seen = 0
    for fresh, _, threshold in lists.read(rows[0]):
        seen += len(fresh)
        if threshold < 512 * 512 * 8 / 4:
            break
    assert seen < len(rows) / 4
    at, score = lists.positives(0, 0, rows[0], 5)
    assert len(at) == 5 and list(score) == sorted(score, reverse=True)


def test_inner_products_are_exact():
    a, b = np.array([[2.0**40, 3.0, -(2.0**61)]]), np.array([[2.0**13, 5.0, 1.0], [2.0**40, 1.0, 0.0]])
    assert inner_products(a, b).tolist() == [[2**53 + 15 - 2**61, LARGEST]]
    assert inner_products(np.zeros((0, 3)), b).shape == (0, 2)


def test_the_queries_follow_their_contracts(spark, tmp_path):
    rows = odd(vectors(250))
    table(spark, rows).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, (label + 1) % 10 if i is not None and label is not None and i % 7 == 0 else label) for i, v, label in rows]
    assert got(op11_negatives(spark, str(tmp_path))) == sorted(negatives_by_hand(moved, 100))
    assert got(op13_topk(spark, str(tmp_path))) == sorted(topk_by_hand(rows, 20, 20))

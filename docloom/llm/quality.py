"""Quality by positive-unlabelled learning: the non-negative risk of a linear model, minimised from moments of all rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import dropped, stored, with_columns

#: Kinds of bytes that the features tell apart; the last kind is all that is in none of them.
_KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".", b",;:'\"-?()", b"!"]
_OTHER, _HIGH = len(_KINDS), len(_KINDS) + 1
_KIND = np.full(256, _OTHER, np.uint16)
_KIND[128:] = _HIGH
for _number, _members in enumerate(_KINDS):
    _KIND[list(_members)] = _number
_N_KINDS = _HIGH + 1
#: Pairs of kinds, four figures of the whole text, and a constant.
WIDTH = _N_KINDS * _N_KINDS + 5
#: Scores are counted in so many bins.
_BINS = 400


def features(text: str | None) -> np.ndarray:
    """What a score may depend on: how kinds of characters follow each other and how much the text repeats itself."""
    x = np.zeros(WIDTH)
    x[-1] = 1
    words = text.split() if text else []
    if not words:
        return x
    kinds = _KIND[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    pairs = np.bincount(kinds[:-1] * _N_KINDS + kinds[1:], minlength=_N_KINDS * _N_KINDS)
    x[: len(pairs)] = np.sqrt(pairs / max(len(kinds) - 1, 1))
    lines = text.split("\n")
    x[-5:-1] = (
        np.log1p(len(words)) / 10,
        len(kinds) / len(words) / 20,
        len(set(words)) / len(words),
        len(set(lines)) / len(lines),
    )
    return x


@dataclass(frozen=True)
class Model:
    """Weights of the features, the class prior, and the curve that turns a margin into a probability."""

    weights: np.ndarray
    prior: float
    margins: np.ndarray
    probabilities: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights
        level = np.interp(margin, self.margins, self.probabilities)
        return np.clip(0.98 * level + 0.02 / (1 + np.exp(-4 * margin)), 0, 1)


def least_risk(
    prior: float, p_mean: np.ndarray, p_square: np.ndarray, u_mean: np.ndarray, u_square: np.ndarray, ridge: float
) -> np.ndarray:
    """
    Weights of least non-negative risk under squared loss, from means of x and of x x' over positives and unlabelled.

    The risk is prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)). The maximum is the largest of t
    times its second part over t in [0, 1], and for each t the best weights solve a linear system; t is 1 unless that
    makes the second part negative, else the t that makes it 0.
    """
    hold = ridge * np.eye(len(p_mean))

    def best(t: float) -> np.ndarray:
        return np.linalg.solve(prior * (1 - t) * p_square + t * u_square + hold, prior * (1 + t) * p_mean - t * u_mean)

    def second(w: np.ndarray) -> float:
        return (1 + 2 * w @ u_mean + w @ u_square @ w) - prior * (1 + 2 * w @ p_mean + w @ p_square @ w)

    if second(best(1.0)) >= 0:
        return best(1.0)
    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if second(best(middle)) >= 0 else (low, middle)
    return best(low)


def class_prior(positives: np.ndarray, unlabelled: np.ndarray, risk: float = 0.1) -> float:
    """
    Share of positives among the unlabelled, from counts by bin of a score.

    In the best bins nearly all unlabelled rows are positives, so there the tail of the unlabelled over the tail of the
    positives is the share; the tail is chosen by the smallest upper bound of that ratio.
    """
    n_p, n_u = max(positives.sum(), 1), max(unlabelled.sum(), 1)
    p_tail, u_tail = np.cumsum(positives[::-1]) / n_p, np.cumsum(unlabelled[::-1]) / n_u
    slack = np.sqrt(np.log(4 / risk) / 2) * (1 / np.sqrt(n_p) + 1 / np.sqrt(n_u))
    usable = p_tail > 0
    if not usable.any():
        return 0.5
    bound = (u_tail[usable] + slack) / p_tail[usable]
    at = int(np.argmin(bound))
    return float(np.clip(u_tail[usable][at] / p_tail[usable][at], 0.01, 0.99))


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence: neighbours out of order are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / max(w1 + w2, 1e-300), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else values


def learn(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    quality: str = "quality",
    ridge: float = 1e-4,
) -> Model:
    """
    Fit on all rows that ``learn_from`` (a condition on ``doc_id``) allows; no sample.

    Trusted positives are documents whose labels all say 1; every allowed document counts as unlabelled, whatever its
    label. Features are computed once and stored; the fit needs their means and mean products in both classes only,
    which are sums over all rows. A first fit with prior 1/2 orders the rows for the estimate of the prior; after the
    second fit the share of positives in each bin of margins, made rising, turns margins into scores.

    Without positives or without documents every score is 1/2. Null ids match no label. Repeated documents count each
    time, repeated labels once.
    """
    good = labels.where(learn_from & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("good_id"))
    good = good.agg(F.min(F.coalesce(quality, F.lit(0))).alias("q")).where("q = 1").select("good_id")

    @F.pandas_udf("array<float>")
    def vector(values: pd.Series) -> pd.Series:
        return pd.Series([features(v).astype(np.float32) for v in values])

    table = stored(docs.where(learn_from).select(F.col(doc_id).alias("id"), vector(F.col(text)).alias("x")), "quality")
    positives = table.join(good, F.col("id") == F.col("good_id"), "left_semi")
    classes = {"p": positives.select("x"), "u": table.select("x")}

    def moments(rows: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((WIDTH + 1, WIDTH + 1))
            for batch in batches:
                if len(batch):
                    x = np.column_stack([np.ones(len(batch)), np.stack(batch["x"].to_numpy())]).astype(np.float64)
                    total += x.T @ x
            yield pd.DataFrame({"total": [total.ravel()]})

        # One array for each input partition; summed place by place, so no task holds many of them.
        parts = rows.mapInPandas(partial, "total array<double>").select(F.posexplode("total").alias("place", "value"))
        total = np.zeros((WIDTH + 1) ** 2)
        for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
            total[r.place] = r.value
        total = total.reshape(WIDTH + 1, WIDTH + 1)
        n = total[0, 0]
        return n, total[0, 1:] / max(n, 1), total[1:, 1:] / max(n, 1)

    def bins(rows: DataFrame, w: np.ndarray, low: float, high: float) -> np.ndarray:
        @F.pandas_udf("int")
        def bin_of(xs: pd.Series) -> pd.Series:
            at = (np.stack(xs.to_numpy()) @ w - low) / max(high - low, 1e-12) * _BINS
            return pd.Series(np.clip(at, 0, _BINS - 1).astype(np.int32))

        counts = np.zeros(_BINS)
        for r in rows.groupBy(bin_of("x").alias("bin")).count().collect():
            counts[r.bin] = r["count"]
        return counts

    n_p, p_mean, p_square = moments(classes["p"])
    n_u, u_mean, u_square = moments(classes["u"])
    if not n_p or not n_u:
        dropped(table)
        return Model(np.zeros(WIDTH), 0.5, np.array([0.0]), np.array([0.5]))

    def spread(w: np.ndarray) -> tuple[float, float]:
        middle, width = u_mean @ w, np.sqrt(max(w @ u_square @ w - (u_mean @ w) ** 2, 1e-12))
        return middle - 8 * width, middle + 4 * width

    first = least_risk(0.5, p_mean, p_square, u_mean, u_square, ridge)
    prior = class_prior(*(bins(classes[k], first, *spread(first)) for k in "pu"))
    weights = least_risk(prior, p_mean, p_square, u_mean, u_square, ridge)
    low, high = spread(weights)
    p, u = (bins(classes[k], weights, low, high) for k in "pu")
    dropped(table)
    held = u > 0
    share = np.clip(prior * (p[held] / n_p) / (u[held] / n_u), 0, 1)
    centres = low + (np.flatnonzero(held) + 0.5) * (high - low) / _BINS
    return Model(weights, prior, centres, rising(share, u[held]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """
    Every row with ``score``, from 0 to 1, of its whole text; higher means likelier good.

    Null and empty text, and text of white space only, have no features but the constant and score 0, since nothing
    in them is worth keeping. A score depends on the text alone, so ties and repeated rows agree. An input column named
    ``score`` gives way to the new one; others are kept.
    """

    @F.pandas_udf("double")
    def scores(values: pd.Series) -> pd.Series:
        x = np.stack([features(v) for v in values]) if len(values) else np.zeros((0, WIDTH))
        empty = np.array([not (v and v.strip()) for v in values], bool)
        return pd.Series(np.where(empty, 0.0, model.score(x)) if len(values) else np.zeros(0))

    found = docs.select(F.struct("*").alias("row"), scores(F.col(text)).alias("found"))
    return with_columns("row", found, score=F.col("found"))

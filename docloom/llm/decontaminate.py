"""Benchmark decontamination by spaced seeds: hashes that skip fixed word positions, then overlaps checked around hits."""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import dropped, stored, with_columns
from docloom.llm.tokens import WordHashes, factors, mixed, runs

_WORD = re.compile(r"\w+")
#: Hashes are first looked up in a bit table of this many bits.
_FILTER_BITS = 24
#: Places times seeds of one hash in one text from which their shifts are noted on a line.
_MANY = 4096
#: Characters of text looked at together.
_TOGETHER = 1_000_000


def words(text: str | None) -> list[bytes]:
    """Lower-case runs of letters, digits and underscores, as UTF-8."""
    return " ".join(_WORD.findall(text.lower())).encode("utf-8", "replace").split() if text else []


def masks(span: int, wrong: int) -> list[list[int]]:
    """
    Position sets such that any ``wrong`` substitutions in ``span`` words leave one of them untouched.

    The span is cut into ``wrong + 2`` blocks and each mask looks at two of them: substitutions touch at most ``wrong``
    blocks, so two stay whole.
    """
    cuts = [round(i * span / (wrong + 2)) for i in range(wrong + 3)]
    blocks = [list(range(a, b)) for a, b in itertools.pairwise(cuts)]
    return [sorted(a + b) for a, b in itertools.combinations(blocks, 2)]


def seed_hashes(hashes: np.ndarray, mask: list[int], salt: int) -> np.ndarray:
    """Hash of the words under the mask at each place where its whole span fits; the span ends at the last masked word."""
    places = len(hashes) - mask[-1]
    if places <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(places, salt, np.uint64)
    for offset, f in zip(mask, factors(len(mask)), strict=True):
        total += hashes[offset : offset + places] * f
    return mixed(total)


@dataclass(frozen=True)
class Seeds:
    """Seeds of a block of items: sorted hashes with the item and word position of each, and the items' words.

    ``wrong`` has the words of a window that may differ, for each item.
    """

    ids: list
    wrong: list[int]
    items: list[np.ndarray]
    masks: list[tuple[int, list[int]]]
    hashes: np.ndarray
    item: np.ndarray
    position: np.ndarray
    bits: np.ndarray


def build_seeds(rows: list[tuple[int | None, str | None]], window: int, least_words: int, similarity: float) -> Seeds:
    hashed = WordHashes()
    ids, items = [], []
    for item_id, text in rows:
        held = hashed.of(words(text))
        if len(held):
            ids.append(item_id)
            items.append(held)
    kinds = sorted({min(window, len(x)) for x in items})
    wrong = {span: wrong_words(span, similarity) if span >= least_words else 0 for span in kinds}
    # A short item has one mask that looks at all of its words.
    numbered = [(span, m) for span in kinds for m in (masks(span, wrong[span]) if span >= least_words else [list(range(span))])]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for salt, (span, mask) in enumerate(numbered):
        for number, held in enumerate(items):
            if min(window, len(held)) == span:
                got = seed_hashes(held, mask, salt)
                found.append((got, np.full(len(got), number), np.arange(len(got))))
    empty = np.zeros(0, np.int64)
    hashes, item, position = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (empty.astype(np.uint64), empty, empty)
    order = np.argsort(hashes, kind="stable")
    bits = np.zeros(1 << _FILTER_BITS, bool)
    bits[hashes >> np.uint64(64 - _FILTER_BITS)] = True
    allowed = [wrong[min(window, len(x))] for x in items]
    return Seeds(ids, allowed, items, numbered, hashes[order], item[order], position[order], np.packbits(bits))


def wrong_words(span: int, similarity: float) -> int:
    return span - math.ceil(similarity * span - 1e-9)


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, window: int, wrong: int) -> int:
    """Words in which the item, laid on the document ``shift`` words in, agrees with it; 0 unless a window agrees enough."""
    span = min(window, len(item))
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high - low < span:
        return 0
    same = np.concatenate([[0], np.cumsum(doc[low + shift : high + shift] == item[low:high])])
    return int(same[-1]) if (same[span:] - same[:-span]).max() >= span - wrong else 0


def shifts(places: np.ndarray, low: np.ndarray, high: np.ndarray, seeds: Seeds) -> dict[int, np.ndarray]:
    """
    For each item the shifts at which some of its seeds meet a text: hit places, and the range of seeds of each.

    Where many places meet many seeds, as in texts of one word over and over, shifts are noted on a line of them: time
    goes with the places times the seeds of one hash, a vector at a time, and space with the shifts.
    """
    found: dict[int, list[np.ndarray]] = {}
    few = np.ones(len(places), bool)
    hashes, which, counts = np.unique(low, return_inverse=True, return_counts=True)
    for n in np.flatnonzero(counts * (high - low)[np.unique(low, return_index=True)[1]] > _MANY):
        own = which == n
        few &= ~own
        at = places[own]
        seen: dict[int, np.ndarray] = {}
        for k in range(int(hashes[n]), int(high[own][0])):
            item = int(seeds.item[k])
            line = seen.setdefault(item, np.zeros(int(at.max()) + len(seeds.items[item]) + 1, bool))
            line[at - seeds.position[k] + len(seeds.items[item])] = True
        for item, line in seen.items():
            found.setdefault(item, []).append(np.flatnonzero(line) - len(seeds.items[item]))
    each = (high - low)[few]
    first = np.repeat(low[few] - np.concatenate([[0], np.cumsum(each)[:-1]]) if len(each) else each, each)
    k = first + np.arange(each.sum())
    item, shift = seeds.item[k], np.repeat(places[few], each) - seeds.position[k]
    order = np.argsort(item, kind="stable")
    item, shift = item[order], shift[order]
    cuts = np.flatnonzero(np.diff(item)) + 1
    for part, of in zip(np.split(shift, cuts), np.split(item, cuts), strict=True):
        if len(of):
            found.setdefault(int(of[0]), []).append(part)
    return {item: np.unique(np.concatenate(parts)) for item, parts in found.items()}


def search(texts: list[str | None], seeds: Seeds, hashed: WordHashes, window: int) -> list[dict[int, int]]:
    """For each text the items found in it, by number, with the most words that agree."""
    found: list[dict[int, int]] = [{} for _ in texts]
    for run in runs(texts, _TOGETHER):
        parts = [hashed.of(words(texts[i])) for i in run]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        joined = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        hits = []
        for salt, (_, mask) in enumerate(seeds.masks):
            got = seed_hashes(joined, mask, salt)
            slot = got >> np.uint64(64 - _FILTER_BITS)
            maybe = np.flatnonzero(seeds.bits[slot >> np.uint64(3)] >> (7 - (slot & np.uint64(7))).astype(np.uint8) & 1)
            low = np.searchsorted(seeds.hashes, got[maybe], "left")
            high = np.searchsorted(seeds.hashes, got[maybe], "right")
            met = high > low
            hits.append(np.stack([maybe[met], low[met], high[met]]))
        at, low, high = np.concatenate(hits, axis=1) if hits else np.zeros((3, 0), int)
        of = np.searchsorted(starts, at, "right") - 1
        order = np.argsort(of, kind="stable")
        at, low, high, of = at[order], low[order], high[order], of[order]
        cuts = np.flatnonzero(np.diff(of)) + 1
        for own in np.split(np.arange(len(of)), cuts) if len(of) else []:
            doc = int(of[own[0]])
            for item, tried in shifts(at[own] - starts[doc], low[own], high[own], seeds).items():
                most = max(overlap(parts[doc], seeds.items[item], int(s), window, seeds.wrong[item]) for s in tried)
                if most:
                    found[run[doc]][item] = most
    return found


def look(seeds: Broadcast, window: int) -> Callable[[Column], Column]:
    """What a text holds of a broadcast block of items."""

    @F.pandas_udf("ids array<long>, n int, hit boolean")
    def found_in(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashed, ids = WordHashes(), seeds.value.ids
        for batch in values:
            found = search(list(batch), seeds.value, hashed, window)
            yield pd.DataFrame(
                {
                    "ids": [sorted({ids[i] for i in f if ids[i] is not None}) for f in found],
                    "n": [max(f.values(), default=0) for f in found],
                    "hit": [bool(f) for f in found],
                }
            )

    return found_in


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    similarity: float = 0.8,
    least_words: int = 8,
    block_chars: int = 4_000_000,
) -> DataFrame:
    """
    Every row of ``docs`` with ``contaminated``, ``item_ids`` (sorted) and ``overlap_words``.

    A document is contaminated by an item if, word beside word, some ``window`` neighbouring words of the item (all of
    them, if it has fewer) agree with the document in at least ``similarity`` of the places. The masks of the seeds are
    such that no such window is missed: with so few substitutions one mask sees none of them. Hits of test hashes in the
    document are joined to the items' words and checked there. ``overlap_words`` is the largest number of words in which
    an item, so laid, agrees.

    An item of fewer than ``least_words`` words is found only where all of its words stand as they are (an item of one word
    marks every text with that word). Items without words are not looked for; null and empty texts hold nothing and are
    clean. Repeated items add nothing; items without an id mark documents but are not listed. An empty
    benchmark leaves all clean. Input columns named like the new ones give way to them; others are kept.

    Only blocks of the benchmark of about ``block_chars`` characters are broadcast. With more than one block, the
    documents are gone through once for each, stored in between.
    """
    spark = docs.sparkSession
    size = benchmark.agg(F.sum(F.length(item_text)).alias("n")).first().n or 0
    blocks = max(1, math.ceil(size / block_chars))
    rows = docs.select(F.struct("*").alias("row"), F.array().cast("array<long>").alias("ids"), F.lit(0).alias("n"))
    rows = rows.withColumn("hit", F.lit(False))
    for number in range(blocks):
        of_block = F.pmod(F.xxhash64(item_text), F.lit(blocks)) == number
        chosen = benchmark.where(of_block & F.col(item_text).isNotNull()).select(item_id, item_text).distinct().collect()
        seeds = spark.sparkContext.broadcast(build_seeds([tuple(r) for r in chosen], window, least_words, similarity))

        looked = rows.withColumn("more", look(seeds, window)(F.col("row")[text]))
        after = looked.select(
            "row",
            F.array_sort(F.array_union("ids", "more.ids")).alias("ids"),
            F.greatest("n", "more.n").alias("n"),
            (F.col("hit") | F.col("more.hit")).alias("hit"),
        )
        if number:
            after = stored(after, "decontaminate")
            dropped(rows)
        elif blocks > 1:
            after = stored(after, "decontaminate")
        rows = after
    return with_columns("row", rows, contaminated=F.col("hit"), item_ids=F.col("ids"), overlap_words=F.col("n"))

"""Runs in texts: Lyndon arrays of words under both orders by grouping suffixes, Lyndon roots extended to maximal repetitions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.tokens import mixed
from docloom.llm.tokens import runs as neighbouring

#: Characters of texts that are looked at together; a longer text is looked at alone.
_TOGETHER = 2_000_000

FORM = "runs array<struct<start: long, length: long, period: long>>, collapsed string, n_words long"


def lyndon_array(ranks: list[int]) -> list[int]:
    """
    Length of the longest Lyndon word that starts at each place of a sequence of ranks, by grouping suffixes.

    Suffixes start out grouped by their first rank. From the highest group to the lowest, each member hands its group's
    word to the nearest place before it whose suffix lies in a lower group: that place's word goes on with as many copies
    of the word as were handed to it, and it moves to a new group just above its old one, more copies above fewer. When a
    group's turn comes, its word is the longest Lyndon prefix of its members, so its length is all that need be kept.
    """
    n = len(ranks)
    members: list[list[int]] = []
    length: list[int] = []
    below: list[int] = []
    above: list[int] = []
    group = [0] * n
    of_rank: dict[int, int] = {}
    for rank in sorted(set(ranks)):
        g = of_rank[rank] = len(members)
        members.append([])
        length.append(1)
        below.append(g - 1)
        above.append(g + 1)
    for i, rank in enumerate(ranks):
        group[i] = g = of_rank[rank]
        members[g].append(i)
    # The nearest place at or before i that is in a group still to come, with shortcuts; -1 stands before all.
    lower = list(range(n))
    out = [1] * n
    now = len(members) - 1
    while now >= 0:
        own, size = [i for i in members[now] if group[i] == now], length[now]
        for i in own:
            out[i] = size
            lower[i] = i - 1
        handed: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and lower[j] != j:
                j = lower[j]
            at = i
            while at > j and lower[at] != j:
                lower[at], at = j, lower[at]
            if j >= 0:
                handed[j] = handed.get(j, 0) + 1
        if handed:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, copies in handed.items():
                moved.setdefault((copies, group[j]), []).append(j)
            # Each new group goes just above its old one, so that of more copies has to come first.
            for copies, old in sorted(moved, reverse=True):
                places = moved[copies, old]
                g = len(members)
                members.append(places)
                length.append(length[old] + copies * size)
                higher = above[old]
                below.append(old)
                above.append(higher)
                above[old] = g
                below[higher] = g
                for j in places:
                    group[j] = g
        now = below[now]
    return out


class Extensions:
    """Longest common extensions of pairs of places in a sequence, exact: names of all stretches of 1, 2, 4, ... ranks."""

    def __init__(self, ranks: np.ndarray):
        self.n = len(ranks)
        self.names = [ranks.astype(np.int64)]
        while 2 << (len(self.names) - 1) <= self.n:
            last, step = self.names[-1], 1 << (len(self.names) - 1)
            pairs = last[:-step] * (int(last.max()) + 1) + last[step:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many places from ``a`` and ``b`` on agree; ``b`` lies behind ``a`` and may be the end."""
        agree = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            names = self.names[level]
            fits = np.flatnonzero(b + agree < len(names))
            same = fits[names[a[fits] + agree[fits]] == names[b[fits] + agree[fits]]]
            agree[same] += 1 << level
        return agree

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many places before ``a`` and ``b`` agree, counted from there to the front; ``a`` lies before ``b``."""
        agree = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            step, names = 1 << level, self.names[level]
            fits = np.flatnonzero(a - agree >= step)
            same = fits[names[a[fits] - agree[fits] - step] == names[b[fits] - agree[fits] - step]]
            agree[same] += step
        return agree


def runs_of(ranks: np.ndarray) -> np.ndarray:
    """
    Rows ``start, length, period`` of all runs of a sequence: maximal stretches of at least two periods.

    Every run holds, from some place on, its period as the longest Lyndon word of that place under the order of ranks or
    its reverse. So the Lyndon words of all places under both orders, extended as far as the period holds, give all runs.
    """
    _, ranks = np.unique(ranks, return_inverse=True)
    same = Extensions(ranks)
    found = []
    for ordered in (ranks, ranks.max(initial=0) - ranks):
        start, period = np.arange(len(ranks)), np.array(lyndon_array(ordered.tolist()), np.int64)
        after, before = same.forward(start, start + period), same.backward(start, start + period)
        is_run = after + before >= period
        found.append(np.stack([start - before, before + period + after, period], axis=1)[is_run])
    return np.unique(np.concatenate(found), axis=0)


def repeated_areas(words: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """
    Starts and ends of the stretches of ``words`` outside which there is no run of ``least`` words and more.

    A run of length m and period q repeats each of its first m - q words after q words, at least half of ``least`` in a
    row. So all of its words lie in windows of that many words which occur twice within one stretch of such windows.
    ``text`` numbers the text of each word. Stretches are narrowed until nothing changes; equal hashes only widen them.
    """
    size = max(1, least // 2)
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, int), np.zeros(0, int)
    window = np.zeros(n, np.uint64)
    for i in range(size):
        window = mixed(window * np.uint64(31) + words[i : i + n].astype(np.uint64))
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    area = text[at].astype(np.uint64)
    while True:
        _, which, count = np.unique(mixed(window[at] + mixed(area)), return_inverse=True, return_counts=True)
        kept = at[count[which] > 1]
        # Windows of one area overlap or touch, and lie in one text.
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) > size) | (text[kept[1:]] != text[kept[:-1]])
        area = np.cumsum(new).astype(np.uint64)
        if len(kept) == len(at):
            first = np.flatnonzero(new)
            return kept[first], np.append(kept[first[1:] - 1], kept[-1:]) + size
        at = kept


def find(texts: list[str | None], least: int) -> list[tuple[list[tuple[int, int, int]], str, int]]:
    """Runs, text without repetitions and word count of each text."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = [len(s) for s in split]
    first = np.cumsum([0, *sizes])
    words = pd.factorize(np.fromiter((w for s in split for w in s), object, int(first[-1])))[0]
    text = np.repeat(np.arange(len(split)), sizes)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for start, end in zip(*repeated_areas(words, text, least), strict=True):
        found = runs_of(words[start:end])
        wanted = found[found[:, 1] >= np.maximum(least, 2 * found[:, 2])]
        owner = int(text[start])
        runs[owner] += [(int(s + start - first[owner]), int(m), int(q)) for s, m, q in wanted]
    out = []
    for own, of in zip(runs, split, strict=True):
        change = np.zeros(len(of) + 1, np.int64)
        for s, m, q in own:
            change[s + q] += 1
            change[s + m] -= 1
        kept = [of[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)] if own else of
        out.append((sorted(own, key=lambda r: (r[0], r[2])), b" ".join(kept).decode("utf-8", "surrogatepass"), len(of)))
    return out


def with_runs(docs: DataFrame, text: Column, least: int = 12) -> DataFrame:
    """
    ``docs`` with ``runs``, ``collapsed`` and ``n_words`` in a struct column ``found``, in place of a column of that name.

    Words are what stands between ASCII white space. A run is a stretch of words with smallest period q (words q apart are
    equal), of ``least`` words and 2 q words at least, that no neighbouring word continues.
    ``runs`` has start (counted from 0), length and period of each, by start, then period. ``collapsed`` is the text
    without the words that some run contains after its first q words, joined by one space.

    The whole text is looked at, however long; memory grows with the longest text. A null text has no words, no runs and an
    empty ``collapsed``. Repeated rows each get their own result. An empty table gives none.
    """

    @F.pandas_udf(FORM)
    def look(values: pd.Series) -> pd.DataFrame:
        texts = values.tolist()
        rows = [row for some in neighbouring(texts, _TOGETHER) for row in find(texts[some.start : some.stop], least)]
        made = pd.DataFrame(rows, columns=["runs", "collapsed", "n_words"])
        made["runs"] = [[{"start": s, "length": m, "period": q} for s, m, q in r] for r in made["runs"]]
        return made

    return docs.withColumn("found", look(text))

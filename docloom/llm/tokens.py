"""Words as numbers, for the operators that compare texts in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Hashes kept at a time; beyond that they are computed anew.
_KEPT = 1 << 17


class WordHashes(dict):
    """The 64-bit hash of a word, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def plain_words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, as UTF-8."""
    return text.encode("utf-8", "replace").split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def factors(n: int) -> np.ndarray:
    """``n`` odd numbers to multiply hashes by, so that order counts when they are added."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words in order; of all words if there are fewer; none for no words."""
    if not len(words):
        return words
    n = min(n, len(words))
    last = len(words) - n + 1
    total = np.zeros(last, np.uint64)
    for i, f in enumerate(factors(n)):
        total += words[i : i + last] * f
    return mixed(total)


def runs(texts: list[str | None], most: int) -> Iterator[range]:
    """Neighbouring texts of about ``most`` characters in all; one that is longer stands alone."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if total and total + n > most:
            yield range(start, i)
            start, total = i, 0
        total += n
    if start < len(texts):
        yield range(start, len(texts))

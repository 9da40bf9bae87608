"""Runs of words against all periods tried one by one."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import odd_documents, rng, sentence  # noqa: F401

from docloom.llm import periodic
from docloom.llm.queries import op12_runs


def by_hand(words, least):
    """Every maximal stretch of each period; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def longest_lyndon_words(words):
    """By definition: a word is Lyndon if it is smaller than each of its proper suffixes."""
    best = [1] * len(words)
    for i in range(len(words)):
        for m in range(1, len(words) - i + 1):
            x = words[i : i + m]
            if all(x < x[k:] for k in range(1, m)):
                best[i] = m
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=24))
def test_lyndon_words_and_runs(words):
    assert periodic.lyndon_array(words) == longest_lyndon_words(words)
    assert [tuple(r) for r in periodic.runs_of(np.array(words))] == sorted(by_hand(words, 2))


def test_hard_sequences():
    fibonacci, thue = [[0], [0, 1]], [0]
    while len(fibonacci[-1]) < 200:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    while len(thue) < 256:
        thue += [1 - x for x in thue]
    for words in (fibonacci[-1], thue, [7] * 300, list(range(50)) * 5 + [3], [1] * 50 + [0] * 50 + [1] * 50):
        assert [tuple(r) for r in periodic.runs_of(np.array(words))] == sorted(by_hand(words, 2))


def text_of(rng):
    words = []
    for _ in range(rng.randrange(6)):
        part = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 10))]
        words += part * rng.randrange(1, 6) + [rng.choice("abcdefgh") for _ in range(rng.randrange(9))]
    return words


def test_runs_of_many_texts(rng):  # noqa: F811
    for least in (2, 3, 12, 20):
        texts = [text_of(rng) for _ in range(300)]
        spaces = [" ", "\n", "\t \r", "\x0b", " \x0c"]
        joined = ["".join(rng.choice(spaces) + w for w in words) for words in texts]
        for words, (runs, said, n) in zip(texts, periodic.find(joined, least), strict=True):
            assert runs == by_hand(words, least)
            assert said == collapsed(words, runs) and n == len(words)


def test_areas_leave_out_texts_without_repeats(rng):  # noqa: F811
    line = sentence(rng, 30)
    # The line comes twice, but with too much between for a run.
    apart = f"{line} {sentence(rng, 200)} {line} {sentence(rng, 100)}".split()
    words = np.unique(apart, return_inverse=True)[1]
    assert len(periodic.repeated_areas(words, np.zeros(len(words), int), 12)[0]) == 0


def test_with_runs_of_odd_rows(spark, odd_documents, rng):  # noqa: F811
    said = "one two three four " * 9 + "end"
    more = spark.createDataFrame([(9, said, "en", "a", 1), (10, "x " * 70_000, "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd_documents.unionByName(more, allowMissingColumns=True).withColumn("found", odd_documents.key)
    found = periodic.with_runs(docs, docs.text).collect()
    assert len(found) == odd_documents.count() + 2
    assert {"key", "runs", "row"} <= set(found[0].asDict())
    for r in found:
        words = (r.text or "").encode().split()
        want = by_hand([w.decode() for w in words], 12) if len(words) < 1000 else None
        if want is not None:
            assert [tuple(x) for x in r.found.runs] == want
            assert r.found.collapsed == collapsed([w.decode() for w in words], want)
        assert r.found.n_words == len(words)
        assert r.runs in ("mine", None)
    by_id = {r.doc_id: r.found for r in found if r.doc_id}
    assert [tuple(x) for x in by_id[9].runs] == [(0, 36, 4)] and by_id[9].collapsed == "one two three four end"
    assert [tuple(x) for x in by_id[10].runs] == [(0, 70_000, 1)] and by_id[10].collapsed == "x"
    assert periodic.with_runs(docs.limit(0), docs.text).count() == 0




def test_the_query_says_words_over_as_the_contract_does(spark, tmp_path, rng):  # noqa: F811
    """All rules of the contract by plain loops, on texts of every kind under ids that are and are not rewritten."""
    rewritten = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    others = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10]
    texts = [None, "", " \n\t ", "one", "a b a b a b a b a b a b a b", "\x0bx\x0c y\u00a0z \u2003 w ", sentence(rng, 300), sentence(rng, 40), "w " * 50]
    rows = [(i, t) for ids in (rewritten, others) for i, t in zip(ids, texts * 3)] + [(None, texts[4]), (rewritten[0], texts[6])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = (0 if i is None else zlib.crc32(str(i).encode())), len(words)
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = by_hand(words, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed(words, runs))]
        want.append((i, len(runs), *figures, *digests))
    columns = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    got = [tuple(r) for r in op12_runs(spark, str(tmp_path)).select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(w[1] for w in want)

from __future__ import annotations

import itertools
import math
import time

import numpy as np
import pytest
from odd import empty, odd_documents, rng, sentence  # noqa: F401
from pyspark.sql import functions as F

from docloom.llm import common, decontaminate, lines, neardup
from docloom.llm.tokens import WordHashes


def shingle_set(text: str) -> set:
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def changed(rng, text: str, n: int) -> str:
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def classes_by_hand(texts: dict[int, str]) -> dict[int, int]:
    sets = {i: shingle_set(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if texts[a] == texts[b] or both and both / len(sets[a] | sets[b]) >= 0.8:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in texts}


def test_classes_equal_brute_force(spark, rng):
    texts, number = {}, itertools.count()
    for _ in range(12):
        base = sentence(rng, rng.randrange(60, 200))
        for n in (0, 0, 1, 1, 2, 3, 6, 20):
            texts[next(number)] = changed(rng, base, n)
        texts[next(number)] = sentence(rng, 70)
    hub = sentence(rng, 150)
    for _ in range(80):  # near copies that are linked through their source only
        texts[next(number)] = changed(rng, hub, 3)
    texts[next(number)] = hub
    texts |= {next(number): t for t in ("one two", "one two", "one three", "word")}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in neardup.near_duplicates(docs.repartition(3)).collect()}
    want = classes_by_hand(texts)
    assert {i: r.class_id for i, r in got.items()} == want
    for i, r in got.items():
        assert r.kept == (want[i] == i)
        assert r.class_rows == sum(c == want[i] for c in want.values())


def test_all_pairs_of_a_band_are_compared(spark, rng):
    """A chain of texts, each near the next only: many share bands, no pivot is near all."""
    w = sentence(rng, 120).split()
    texts = {}
    for i in range(30):
        texts[i] = " ".join(w)
        for j in rng.sample(range(len(w)), 2):
            w[j] = f"x{i}_{j}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert got == classes_by_hand(texts)


def test_copies_with_repeated_lines_are_proposed(spark, rng):
    """Copies to which a line is appended many times: as similar as with the line once."""
    texts = {}
    for i in range(0, 80, 2):
        texts[i] = sentence(rng, 80)
        texts[i + 1] = texts[i] + ("\n" + sentence(rng, 7)) * 100
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    want = classes_by_hand(texts)
    assert sum(want[i] == i - 1 for i in range(1, 80, 2)) == 40
    assert got == want


def test_fingerprints_lose_under_one_in_a_million():
    for threshold in (0.7, 0.8, 0.9):
        p, n = (1 - threshold) / 2, neardup._BITS
        most = int(neardup.most_differing(threshold))
        assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(most + 1, n + 1)) < 1e-6


def test_signatures_estimate_probability_jaccard(rng):
    a = {i: 1 + rng.random() * 4 for i in range(300)}
    b = {i: (a[i] * 3 if i < 300 else rng.random() * 9) for i in range(60, 380)}
    pa, pb = sum(a.values()), sum(b.values())
    both = a.keys() & b.keys()
    exact = sum(
        1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in both
    )
    hashes = np.random.default_rng(1).integers(0, 2**63, 400).astype(np.uint64)
    sets = [(hashes[list(s)], np.array(list(s.values())) / p) for s, p in ((a, pa), (b, pb))]
    got = neardup.signatures(sets, 4096)
    assert np.mean(got[0] == got[1]) == pytest.approx(exact, abs=0.03)


def test_one_row_of_each_class_stays(spark, odd_documents):
    marked = neardup.near_duplicates(odd_documents)
    rows = marked.collect()
    assert len(rows) == odd_documents.count()
    assert {r.key for r in rows} == {"mine"}
    of = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert of[5] == of[6] == 5
    assert of[3] == 3 and of[4] == 4
    columns = odd_documents.columns
    left = neardup.one_of_each(marked, columns)
    assert left.columns == columns
    kept = left.select("doc_id", "text").collect()
    assert sum(r.doc_id == 5 for r in kept) == 1 and not any(r.doc_id == 6 for r in kept)
    assert sum(r.text is None for r in kept) == 2
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(0, 60) if i % 20 != 19] + [("100", "100"), ("050", "200")]
    got = {r.id: r.root for r in common.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {k: v for k, v in got.items() if k != v} == {
        **{f"{i:03}": f"{i // 20 * 20:03}" for i in range(60) if i % 20},
        "200": "040",
    }
    assert common.components(spark.createDataFrame([], "a string, b string")).count() == 0


# --- decontamination ---------------------------------------------------------------------------------


def overlaps(doc: str, item: str, window: int = 13, need: float = 0.8) -> bool:
    d, t = ([x.decode() for x in decontaminate.words(s)] for s in (doc, item))
    span = min(window, len(t))
    least = int(np.ceil(need * span - 1e-9))
    return len(t) >= 8 and any(
        sum(d[i + k] == t[p + k] for k in range(span)) >= least
        for i in range(len(d) - span + 1)
        for p in range(len(t) - span + 1)
    )


def test_marks_equal_brute_force(spark, rng):
    items = [(i, sentence(rng, n)) for i, n in enumerate((40, 30, 14, 13, 10, 8, 5, 25))]
    docs = []
    for i in range(120):
        text = sentence(rng, 40)
        if i % 3:
            passage = rng.choice(items)[1].split()
            begin = rng.randrange(max(1, len(passage) - 12))
            passage = passage[begin : begin + rng.randrange(8, 30)]
            for _ in range(rng.randrange(4)):
                passage[rng.randrange(len(passage))] = "other"
            text += " " + " ".join(passage).upper() + ", " + sentence(rng, rng.randrange(10))
        docs.append((i, text))
    made = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (9, None), (10, "")], "item_id long, text string")
    for chars in (4_000_000, 600):  # in one block, and in several
        got = {r.doc_id: r for r in decontaminate.mark(made, benchmark, block_chars=chars).collect()}
        for i, text in docs:
            want = [k for k, t in items if overlaps(text, t)]
            assert got[i].item_ids == want
            assert got[i].contaminated == bool(want)
            assert (got[i].overlap_words > 0) == bool(want)


@pytest.mark.parametrize(("span", "wrong"), [(13, 2), (8, 1), (10, 2)])
def test_masks_miss_nothing(span, wrong):
    made = decontaminate.masks(span, wrong)
    for bad in itertools.combinations(range(span), wrong):
        assert any(not set(bad) & set(m) for m in made)


def test_decontamination_of_odd_rows(spark, odd_documents):
    items = spark.createDataFrame([(None, "one two three four five six seven eight nine"), (1, None)], "item_id long, text string")
    got = decontaminate.mark(odd_documents, items).collect()
    assert len(got) == odd_documents.count()
    assert not any(r.contaminated for r in got)
    assert decontaminate.mark(empty(spark), items).count() == 0
    assert decontaminate.mark(odd_documents, items.limit(0)).where("contaminated").count() == 0
    said = spark.createDataFrame([(1, "x One, two three four FIVE six seven eight nine!")], "doc_id long, text string")
    row = decontaminate.mark(said, items).first()
    assert (row.contaminated, row.item_ids, row.overlap_words) == (True, [], 9)


# --- lines -------------------------------------------------------------------------------------------


def cleaned_by_hand(texts: dict[int, str], least: int) -> dict[int, str]:
    """Every run of lines with enough words that also starts earlier is deleted; all runs are tried."""
    first, out = {}, {}
    for number, (i, text) in enumerate(sorted(texts.items())):
        held = text.split("\n")
        at = [j for j, x in enumerate(held) if x.split()]
        gone = set()
        for a in range(len(at)):
            for b in range(a, len(at)):
                run = tuple(held[j] for j in at[a : b + 1])
                if sum(len(x.split()) for x in run) >= least and first.setdefault(run, (number, a)) < (number, a):
                    gone |= set(at[a : b + 1])
        out[i] = "\n".join(x for j, x in enumerate(held) if j not in gone)
    return out


def test_runs_equal_brute_force(spark, rng):
    pool = [sentence(rng, rng.choice((1, 3, 8, 12))) for _ in range(14)]
    passage = [sentence(rng, 7) for _ in range(9)]
    texts = {}
    for i in range(60):
        held = [rng.choice(pool) if rng.random() < 0.6 else sentence(rng, 5) for _ in range(rng.randrange(1, 14))]
        if i % 4 == 0:
            begin = rng.randrange(4)
            held[2:2] = passage[begin : begin + rng.randrange(2, 9)]
        if i % 9 == 0:
            held += [pool[0], ""] * 12
        texts[i] = "\n".join(held)
    texts[60] = texts[3]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lines.without_repeats(docs, 20).collect()}
    want = cleaned_by_hand(texts, 20)
    assert {i: r.clean_text for i, r in got.items()} == want
    assert any(want[i] != texts[i] for i in texts)
    for i, r in got.items():
        assert r.n_lines == len(texts[i].split("\n"))
        assert r.deleted_lines == len(texts[i].split("\n")) - (len(want[i].split("\n")) if want[i] else 0)


def test_lines_of_odd_rows(spark, odd_documents):
    got = lines.without_repeats(odd_documents).collect()
    assert len(got) == odd_documents.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[5].deleted_lines == 0 and by_id[6].deleted_lines == 1 and by_id[6].clean_text == ""
    assert by_id[2].clean_text is None and by_id[2].n_lines == 0
    assert by_id[4].clean_text == " \n\t "
    assert lines.without_repeats(empty(spark)).count() == 0


def test_word_hashes_forget_but_agree(monkeypatch):
    monkeypatch.setattr("docloom.llm.tokens._KEPT", 3)
    held = WordHashes()
    first = held.of([b"a", b"b", b"c", b"d", b"e"])
    assert (held.of([b"e", b"a"]) == first[[4, 0]]).all()
    assert len(held) <= 4


def test_queries_over_a_table(spark, sf_dir):
    from docloom.llm.queries import op1_minhash, op2_decontaminate, op7_lines

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.class_id for r in op1_minhash(spark, sf_dir).collect()} == classes_by_hand(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    marked = {r.doc_id: r.item_ids for r in op2_decontaminate(spark, sf_dir).collect()}
    leaks = {i: {x.item_id for x in items if x.text in t} for i, t in docs.items()}
    assert all(found <= set(marked[i]) for i, found in leaks.items())
    got = op7_lines(spark, sf_dir).agg(F.count("*").alias("n"), F.sum("deleted_lines").alias("d")).first()
    assert got.n == len(docs) and got.d > 0


def test_short_items_are_found_whole(spark):
    texts = {1: "so one two three four it is", 2: "one two three five", 3: "Three! two", 4: None, 5: "one two three four"}
    items = [(10, "One two, three four"), (11, "three two"), (12, ""), (13, None), (14, "two three five six")]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = decontaminate.mark(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.item_ids, r.overlap_words) for r in found} == {
        1: ([10], 4), 2: ([], 0), 3: ([11], 2), 4: ([], 0), 5: ([10], 4),
    }


@pytest.mark.parametrize("period", [1, 2, 3])
def test_repeated_words_take_time_by_their_number(period):
    said, item = (" ".join(f"w{i % period}" for i in range(n)) for n in (20_000, 400))
    seeds = decontaminate.build_seeds([(1, item)], 13, 8, 0.8)
    start = time.process_time()
    assert decontaminate.search([said], seeds, WordHashes(), 13) == [{0: 400}]
    assert time.process_time() - start < 5


def test_shifts_are_the_same_both_ways(monkeypatch, rng):  # noqa: F811
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (300, 0, 40, 500)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(n))) for i, n in enumerate((30, 60, 9))]
    seeds = decontaminate.build_seeds(items, 13, 8, 0.8)
    found = []
    for many in (0, 10, 10**9):
        monkeypatch.setattr(decontaminate, "_MANY", many)
        found.append(decontaminate.search(texts, seeds, WordHashes(), 13))
    assert found[0] == found[1] == found[2] and any(found[0])


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        common.shared_dir(Cluster)

from __future__ import annotations

import hashlib
import html
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import empty, odd_documents, rng, sentence  # noqa: F401
from pyspark.sql import functions as F

from docloom.llm import chat, languages, pages, quality
from docloom.llm.queries import held_out, op3_chat, op8_quality, op10_language

TURNS = "conv_id long, turn long, role string, text string"


# --- chat --------------------------------------------------------------------------------------------


def read_windows(rows):
    """Turns and targets of one conversation's windows, read by splitting the text."""
    turns, targets = [], []
    for r in sorted(rows, key=lambda r: r.starts_at):
        parts = r.formatted.split(chat.END)
        assert parts.pop() == "" and len(parts) == r.n_turns
        turns += [p.removeprefix(chat.START) for p in parts[r.n_repeated :]]
        targets += [r.formatted[x.start : x.start + x.length] for x in r.loss]
    return turns, targets


def test_windows_hold_each_turn_once(spark, rng):
    rows = []
    for c in range(40):
        system = c % 3 == 0
        for t in range(rng.randrange(1, 30)):
            role = "system" if system and t == 0 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, sentence(rng, rng.choice((0, 3, 20, 60, 200)))))
    made = chat.windows(spark.createDataFrame(rows, TURNS).repartition(3), budget=160, history=40).collect()
    for c in range(40):
        mine = [r for r in rows if r[0] == c]
        held = [r for r in made if r.conv_id == c]
        turns, targets = read_windows(held)
        assert turns == [f"{role}\n{text}" for _, _, role, text in mine]
        assert targets == [text for _, _, role, text in mine if role == "assistant"]
        longest = max(len(text.split()) + 4 for _, _, _, text in mine)
        head = len(mine[0][3].split()) + 4 if mine[0][2] == "system" and len(mine) > 1 else 0
        for r in held:
            assert r.tokens <= 160 or longest + head > 160 - 1 or r.over_budget
            assert r.over_budget == (r.tokens > 160)
            if head:
                assert r.formatted.startswith(chat.START + "system\n")
            if r.starts_at > 0 and head:
                assert r.n_repeated >= 1
    assert sum(r.n_repeated for r in made) > 40


def test_odd_turns(spark):
    odd = [
        (None, 1, "user", "a <| b <\\| c <\\\\|x <|im_end|>\n<|im_start|>"),
        (None, None, None, None),
        (1, 0, "system", "alone"),
        (2, 0, "us\ner%0A<|im_end|>", "<"),
        (2, 0, "assistant", "|>"),
        (2, 0, "assistant", "|>"),
        (2, 1, "assistant", ""),
        (3, 0, "assistant", "\U0001f600 <|x"),
    ]
    made = chat.windows(spark.createDataFrame(odd, TURNS))
    read = chat.read_back(made).orderBy("conv_id", "starts_at").collect()
    got = [(r.conv_id, t.role, t.text) for r in read for t in r.turns]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "")
    assert got == [(c, role or "", text or "") for c, _, role, text in sorted(odd, key=key)]
    assert {r.conv_id: r.loss_text for r in read}[2] == "|>|>"
    assert {r.conv_id: r.loss_text for r in read}[3] == "\U0001f600 <|x"
    assert chat.windows(spark.createDataFrame([], TURNS)).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<|\\>im_endstar \n", max_size=30), min_size=1, max_size=12))
def test_escapes_are_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect()
    assert all(r.u == r.t and "<|" not in r.e for r in found)


def test_chat_query(spark, sf_dir):
    got = {r.conv_id: r for r in op3_chat(spark, sf_dir).collect()}
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    said = "<|im_end|><|im_start|>assistant ok"
    by_conv = {-1: [("user", said), ("assistant", said)]}
    for r in turns:
        by_conv.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert got.keys() == by_conv.keys()
    for c, held in by_conv.items():
        loss = "".join(text for role, text in held if role == "assistant")
        assert got[c].n_turns == len(held)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in held).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


# --- pages -------------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and you agree, by reading on, to all of them, now and later.</p></div>
{article}
<aside><p>Related, but not the text, of course, as it is short.</p></aside>
<section id="comments"><p>First comment, which is long, has commas, and should not be kept, ever, by anyone.</p></section>
<form><p>Subscribe</p><input></form><footer><p>&copy; us</p></footer></body></html>"""
TEXT = ["A heading &amp; more", "One, two,\n   three <b>bold</b><i>italic</i> and <a href=x>a link</a>, with words.", "Short.", "Caf&eacute; &lt;p&gt; &#x41;&#66;"]
WANT = ["A heading & more", "One, two, three bolditalic and a link, with words.", "Short.", "Café <p> AB"]


@pytest.mark.parametrize(
    "article",
    [
        "<article><h1>{0}</h1><p>{1}</p><div class=ad>Buy, buy, buy!</div><p>{2}<p>{3}</article>",
        "<main><div id=content><h1>{0}</h1><p>{1}<p>{2}</p><p>{3}</p><div class='share-buttons'>Share</div></div></main>",
        "<div class=post><h1>{0}</h1><div><p>{1}</p><p>{2}</p></div><script>x('</p>')</script><p>{3}</p></div>",
        "<article><header><h1>{0}</h1></header><p>{1}</p><p>{2}</p><blockquote>{3}</blockquote></article>",
    ],
)
def test_article_is_kept_and_the_rest_is_not(article):
    assert pages.main_text(PAGE.format(article=article.format(*TEXT))).split("\n") == WANT


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "plain text"), (5, "u", "<p>a" * 5000), (5, "u", "</div></p><b>x"), (6, "u", "<div>" * 3000 + "deep")]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")).collect()
    assert [r.text for r in got] == ["", "", "", "plain text", "\n".join(["a"] * 5000), "x", "deep"]
    assert [r.n_chars for r in got] == [len(r.text) for r in got]


def test_page_query_by_pattern(spark, sf_dir):
    """Pages of the test table are simple enough for patterns."""
    for r in pages.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [html.unescape(re.sub("<[^>]*>", " ", x)) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(" ".join(b.split()) for b in blocks if b.split())


# --- quality -----------------------------------------------------------------------------------------


def test_quality_of_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.1")  # sf0.01 has 94 held-out labels
    got = op8_quality(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    right = got.where("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col("quality")).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] >= 0.98
    assert got.where("score < 0 OR score > 1 OR score IS NULL OR (score >= 0.7) <> (predicted = 1)").count() == 0


def test_risk_is_least_where_it_says(rng):
    import numpy as np

    g = np.random.default_rng(3)
    p = np.column_stack([g.normal(1, 1, (400, 3)), np.ones(400)])
    u = np.vstack([np.column_stack([g.normal(-1, 1, (300, 3)), np.ones(300)]), p[:200]])
    for prior in (0.4, 0.95):
        w = quality.least_risk(prior, p.mean(0), p.T @ p / len(p), u.mean(0), u.T @ u / len(u), 1e-6)

        def risk(w, prior=prior):
            loss = lambda x, y: np.mean((1 - y * (x @ w)) ** 2)
            return prior * loss(p, 1) + max(0, loss(u, -1) - prior * loss(p, -1)) + 1e-6 * w @ w

        assert all(risk(w) <= risk(w + g.normal(0, s, 4)) + 1e-6 for s in (1e-3, 1e-2, 0.1, 1) for _ in range(60))


def test_prior_and_rising():
    import numpy as np

    positives, unlabelled = np.zeros(100), np.zeros(100)
    positives[50:] = 400
    unlabelled[50:], unlabelled[:50] = 120, 280
    assert quality.class_prior(positives, unlabelled) == pytest.approx(0.3, abs=0.02)
    assert list(quality.rising(np.array([1.0, 3, 2, 5]), np.ones(4))) == [1, 2.5, 2.5, 5]


def test_quality_of_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (1, 1), (7, None), (None, 1), (5, 1), (5, 0)], "doc_id long, quality int")
    model = quality.learn(odd_documents, labels, ~held_out())
    got = quality.score(odd_documents, model).collect()
    assert len(got) == odd_documents.count()
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if not (r.text or "").strip())
    nothing = quality.learn(empty(spark), labels.limit(0), ~held_out())
    assert quality.score(odd_documents, nothing).where("doc_id = 5").first().score == pytest.approx(0.5, abs=0.02)
    assert quality.score(empty(spark), model).count() == 0


# --- languages ---------------------------------------------------------------------------------------


def test_language_of_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = op10_language(spark, sf_dir)
    assert got.count() == docs.count()
    right = got.where("held_out").join(docs, "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] >= 0.97


def test_language_of_odd_rows(spark, odd_documents):
    learned = languages.learn_dictionaries(odd_documents, ~held_out())
    assert set(learned) <= {"en", "de", "fr", "es"} and "de" not in learned
    got = languages.identify(odd_documents, learned).collect()
    assert len(got) == odd_documents.count()
    for r in got:
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert (r.lang_pred, r.score, r.sure) == ("und", 0.0, False)
        else:
            assert r.lang_pred in learned and 0 <= r.score <= 1
    assert {r.lang_pred for r in languages.identify(odd_documents, {}).collect()} == {"und"}
    assert languages.learn_dictionaries(empty(spark), ~held_out()) == {}
    assert languages.identify(empty(spark), learned).count() == 0


def test_learning_is_bounded(spark, rng):
    rows = [(i, sentence(rng, 50), "en") for i in range(300)] + [(1000, "x" * 99_999, "en")]
    learned = languages.learn_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), dictionary_bytes=4096)
    assert list(learned) == ["en"] and 1000 < len(learned["en"]) <= 4096


def test_every_part_of_a_long_text_counts(spark, rng):
    def text(words, n):
        return " ".join(rng.choice(words) for _ in range(n // 7))

    made = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(6000)]
    a, b = made[:3000], made[3000:]
    learned = {"a": text(a, 65_000).encode(), "b": text(b, 65_000).encode()}
    rows = [(0, text(a, 200_000) + " " + text(b, 3_000_000)), (1, text(b, 3_000_000) + " " + text(a, 200_000)), (2, text(b, 200_000) + " " + text(a, 3_000_000))]
    got = languages.identify(spark.createDataFrame(rows, "doc_id long, text string"), learned).collect()
    assert {r.doc_id: (r.lang_pred, r.sure) for r in got} == {0: ("b", True), 1: ("b", True), 2: ("a", True)}


def test_languages_of_long_texts_only_are_learned(spark, rng):
    rows = [(i, "en", sentence(rng, 50)) for i in range(3)]
    rows += [(10 + i, "xx", "12 34 " * 9000 + "kjempe " * 3000 + "skog " * 9000) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    learned = languages.learn_dictionaries(docs, F.lit(True))
    assert list(learned) == ["xx", "en"]  # by rows
    assert 0 < len(learned["xx"]) <= 1 << 14
    asked = spark.createDataFrame([(1, "skog kjempe skog skog kjempe kjempe skog")], "doc_id long, text string")
    assert languages.identify(asked, learned).first().lang_pred == "xx"


# --- what stands around and between, and deep pages -----------------------------------------------------

LONG = "Some words of a sentence that go on for a while, with commas, and more, so that it scores. " * 4


def test_what_stands_between_parts_of_the_text_stays():
    between = (
        "<h2>Second</h2><h3>Third</h3><ul><li>one</li></ul><table><tr><td>cell</td></tr></table>"
        "<blockquote>said</blockquote><div>short close</div>"
    )
    half = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    page = f"<div class=menu><a href=x>Home</a></div><div>{half}{between}{half}</div><div class=footer>foot</div>"
    one = LONG.strip()
    assert pages.main_text(page).split("\n") == [one, one, "Second", "Third", "one", "cell", "said", "short close", one, one]


def test_several_short_articles_all_stay():
    articles = "".join(f"<article><h2>T{i}</h2><p>Short text {i}, with a comma.</p></article>" for i in range(3))
    want = [x for i in range(3) for x in (f"T{i}", f"Short text {i}, with a comma.")]
    for page in (f"<nav>menu</nav><main>{articles}</main>", f"<nav>menu</nav><div>{articles}</div><footer>foot</footer>"):
        assert pages.main_text(page).split("\n") == want


def test_names_of_asides_may_name_text_within_an_article():
    page = f"""<article><p>{LONG}</p><div class="social-history"><p>{LONG}</p></div><div class="comments"><p>{LONG}</p></div>
        <div class="share-box">Share this <a href=x>here</a></div><div class="related"><a href=y>{LONG}</a></div></article>"""
    assert pages.main_text(page) == f"{LONG.strip()}\n{LONG.strip()}"


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 100_000 + "x" + "</i>" * 100_000,
        "<p>" + "<div>" * 100_000 + "x",
        "<ul>" + "<li><b>x" * 50_000,
        "<p><button>" + "<div>" * 100_000 + "</button>x",
        "<header>" * 100_000 + "x",
        "<table><tr><td>" * 30_000 + "x" + "</b>" * 30_000,
    ],
)
def test_deep_pages_take_time_by_their_length(page):
    def seconds(text):
        start = time.process_time()
        pages.main_text(text)
        return time.process_time() - start

    half = seconds(page[: len(page) // 2])
    assert seconds(page) < 4 * half + 1


def test_only_letters_are_letters(spark):
    docs = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, "½a"), (3, "ß ﬁ")], "doc_id long, text string")
    assert [languages.letters(t).decode() for t in ("½ ² Ⅷ", "½a b_c 3d", "É é")] == ["", "a b c d", "é é"]
    found = languages.identify(docs, {"en": b"a b c", "de": b"\xc3\x9f"})
    assert {r.doc_id: r.lang_pred == "und" for r in found.collect()} == {1: True, 2: False, 3: False}


def test_the_sample_of_a_language_is_ranked_in_bounded_groups(spark, rng):  # noqa: F811
    docs = spark.createDataFrame([(i, sentence(rng, 5), "en") for i in range(3000)], "doc_id long, text string, lang string")
    found = languages.learn_dictionaries(docs.repartition(50), F.lit(True), sample_rows=20)
    marks = sorted((r.m, r.text) for r in docs.select(F.xxhash64("text").alias("m"), "text").distinct().collect())[:20]
    assert found["en"] == b"".join(languages.letters(t) + b" " for _, t in marks)


def test_languages_equal_a_plain_loop(spark, sf_dir):
    """All rows of a table: the smallest sum of compressed pieces, computed one by one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dictionaries = languages.learn_dictionaries(docs, ~held_out())
    by_language = languages.compressors(dictionaries)
    got = {r.doc_id: r.lang_pred for r in op10_language(spark, sf_dir).collect()}
    for r in docs.collect():
        data = "".join(c if c.isalpha() else " " for c in (r.text or "").lower())
        data = " ".join(data.split()).encode()
        sizes = [sum(len(c.compress(data[i : i + 16384])) for i in range(0, len(data), 16384)) for _, c in by_language]
        want = by_language[sizes.index(min(sizes))][0] if data else "und"
        assert got[r.doc_id] == want


def test_moments_are_sums_over_all_rows(spark, sf_dir):
    """The fit equals one from plain sums over all features, however many partitions there are."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    one, many = (quality.learn(d, labels, ~held_out()) for d in (docs.coalesce(1), docs.repartition(100)))
    assert np.allclose(one.weights, many.weights, rtol=1e-6, atol=1e-9) and abs(one.prior - many.prior) < 1e-9
    kept = {r.doc_id for r in docs.where(~held_out()).select("doc_id").collect()}
    good = {r.doc_id for r in labels.where(~held_out() & (F.col("quality") == 1)).collect()}
    x = {r.doc_id: quality.features(r.text).astype(np.float32).astype(float) for r in docs.collect() if r.doc_id in kept}
    p, u = np.stack([v for i, v in x.items() if i in good]), np.stack(list(x.values()))
    weights = quality.least_risk(one.prior, p.mean(0), p.T @ p / len(p), u.mean(0), u.T @ u / len(u), 1e-4)
    assert np.allclose(one.weights, weights, rtol=1e-5, atol=1e-7)

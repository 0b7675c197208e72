"""Language, quality and page models: held-out accuracy, edge rows, brute-force kernels."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm.html_blocks import blocks
from tillcast.llm.html_main import (Labeller, extract_main_text, fit_labeller, gradients, main_text, page_sample,
                                    run_direction, train, vectors)
from tillcast.llm.language import (GRAMS, LanguageModel, fit_languages, language_sample, predict_languages, presence)
from tillcast.llm.quality import fit_quality, quality_sample, score_quality
from tillcast.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_presence_counts_the_grams_inside_padded_words():
    def grams(text):
        out = set()
        for w in set(text.lower().split()):
            p = f" {w} "
            out |= {p[i:i + n] for n in range(1, GRAMS + 1) for i in range(len(p) - n + 1)} - {" "}
        return out
    for text in ("aa", "The the THE", "abc bcd é", "x"):
        assert len(presence(text)) == len(grams(text))
    assert len(presence("")) == len(presence(" \n")) == 0


def test_weights_equal_the_nystroem_kernel_ridge_solution():
    texts = [("a", "lorem ipsum dolor"), ("b", "quick brown foxes"), ("a", "ipsum dolores lor"), ("b", "brown quicker fox"), ("a", "dolor dolor ip")]
    model = fit_languages(texts, landmarks=2, ridge=0.1)
    sets = [(x, set(presence(t))) for x, t in texts]
    kernel = lambda p, q: len(p & q) / np.sqrt(len(p) * len(q))
    marks = [s for lang in "ab" for s in [s for x, s in sets if x == lang][:2]]
    k_mm = np.array([[kernel(p, q) for q in marks] for p in marks])
    values, vec = np.linalg.eigh(k_mm)
    root = vec / np.sqrt(values) @ vec.T
    phi = np.array([[kernel(s, q) for q in marks] for _, s in sets]) @ root
    y = np.array([[1.0 if x == lang else -1.0 for lang in "ab"] for x, _ in sets])
    beta = np.linalg.solve(phi.T @ phi + 0.1 * np.eye(4), phi.T @ (y - y.mean(0)))
    np.testing.assert_allclose(model.scores([t for _, t in texts]), phi @ beta, atol=1e-4)


def test_language_query_is_right_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    said = QUERIES["op7_language_id"](spark, sf)
    rows = said.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.995


def test_language_edges(spark, hostile, no_docs):
    model = fit_languages(language_sample(hostile))
    rows = predict_languages(hostile, model).collect()
    assert len(rows) == hostile.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5, 6))
    assert by[8].lang_pred == "de" and by[2].lang_pred == "en"
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id == 1} == {(by[2].lang_pred, by[2].score)}
    assert predict_languages(no_docs, model).collect() == []
    nothing = fit_languages(language_sample(no_docs))
    assert isinstance(nothing, LanguageModel) and {r.lang_pred for r in predict_languages(hostile, nothing).collect()} == {"und"}
    one = fit_languages(language_sample(hostile.where("lang = 'de'")))
    assert {r.lang_pred for r in predict_languages(hostile, one).collect()} == {"de", "und"}


def test_long_texts_and_pages_teach(spark):
    words = {"en": "the river runs past the old mill and ", "de": "der alte Müller zählt die Säcke und "}
    docs = spark.createDataFrame([(i, w * (900 + i), lang) for i, (lang, w) in enumerate(words.items())],
                                 "doc_id long, text string, lang string")
    sample = language_sample(docs)
    assert sorted(lang for lang, _ in sample) == ["de", "en"] and all(len(t) == 20_000 for _, t in sample)
    said = predict_languages(docs, fit_languages(sample)).collect()
    assert {r.doc_id: r.lang_pred for r in said} == {0: "en", 1: "de"}
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    assert {q for q, _ in quality_sample(docs, labels)[0]} == {0, 1}
    page = ("<html><body><nav><p>Home</p></nav><article>" + "<p>Some words of the article, of one length.</p>" * 2000
            + "</article><footer><p>Contact</p></footer></body></html>")
    assert page_sample(spark.createDataFrame([(1, page)], "page_id long, html string")) == [page]
    with pytest.raises(ValueError):
        fit_labeller(["<html></html>"])


def auc(score, good):
    rank = np.argsort(np.argsort(score)) + 1
    n = good.sum()
    return (rank[good].sum() - n * (n + 1) / 2) / (n * (~good).sum())


def test_quality_query_separates_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op10_compression_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    score, good = np.array([r.score for r in held]), np.array([r.quality == 1 for r in held])
    assert auc(score, good) > 0.96 and (score[good] >= 0.3).mean() > 0.97 and (score[~good] < 0.3).mean() > 0.75


def test_quality_edges(spark, hostile, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 1), (8, 0), (9, 0), (9, 1), (None, 0), (10, None), (99, 0)], "doc_id long, quality int")
    sample, share = quality_sample(hostile, labels)
    assert {q for q, _ in sample} == {0, 1} and share == pytest.approx(3 / 5)
    for model in (fit_quality(sample, share), fit_quality([], 0.5), fit_quality([(1, "good text")], 1.0)):
        rows = score_quality(hostile, model).collect()
        assert len(rows) == hostile.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
        assert score_quality(no_docs, model).collect() == []
    assert quality_sample(no_docs, labels.limit(0)) == ([], 0.5)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p><p>no";</script></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News &amp; more</a></ul></nav><article><h1>A  title\n of it</h1>
<p>First <b>bold</b>&nbsp;words &#8212; and<br>a line.<p>Second, <a href=x>linked</a>.<!-- not > this --><div>Third<p></div></article>
<footer>&copy; us</footer></body></html>"""


def test_blocks_of_broken_markup():
    found = blocks(PAGE)
    assert [b.text for b in found] == ["Home", "News & more", "A title of it", "First bold words — and a line.", "Second, linked.",
                                       "Third", "© us"]
    assert found[0].linked == 4 and found[4].linked == 6 and [t for t, _ in found[3].path] == ["html", "body", "article", "p"]
    assert [b.text for b in blocks("a < b & c <p class='x>y'>d</p> <unclosed")] == ["a < b & c", "d"]
    assert blocks("") == [] and blocks("<script>only") == [] and [b.text for b in blocks("plain &lt;i&gt;")] == ["plain <i>"]
    deep = blocks("<div>" * 5000 + "x")
    assert deep[0].text == "x" and len(blocks("<p>w" * 20000)) == 20000


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    data = [(rng.normal(size=(n, vectors([]).shape[1])).astype(np.float32), None) for n in (3, 1, 5)]
    w = {k: a.astype(np.float64) for k, a in train([(x, np.ones(len(x), np.float32)) for x, _ in data], epochs=1).w.items()}
    pages, n = [x for x, _ in data], np.array([3, 1, 5])
    weight = rng.normal(size=(9, 20))
    for k, back in (("f", False), ("b", True)):
        out, x, tape = run_direction(w, k, pages, n, back, True)
        g = gradients(w, k, x, tape, weight)
        for name in (k + "x", k + "h", k + "b"):
            at = tuple(rng.integers(s) for s in w[name].shape)
            value = []
            for e in (1e-2, -1e-2):
                w[name][at] += e
                value.append((run_direction(w, k, pages, n, back)[0].astype(float) * weight).sum())
                w[name][at] -= e
            assert g[name][at] == pytest.approx((value[0] - value[1]) / 2e-2, rel=0.05, abs=2e-3)


def test_batched_labels_equal_page_by_page():
    rng = np.random.default_rng(1)
    pages = [rng.normal(size=(n, vectors([]).shape[1])).astype(np.float32) for n in (4, 0, 9, 1)]
    model = train([(x, (x[:, 0] > 0).astype(np.float32)) for x in pages], epochs=2)
    for one, both in zip([model.probabilities([p])[0] for p in pages], model.probabilities(pages)):
        np.testing.assert_allclose(one, both, atol=1e-5)


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = fit_labeller(page_sample(pages))
    assert isinstance(model, Labeller)
    rows = extract_main_text(pages, model).join(pages.select("page_id", "html"), "page_id").collect()
    exact = 0
    for r in rows:
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        exact += r.text == "\n\n".join(b.text for b in blocks(body)) and r.n_chars == len(r.text)
    assert exact >= 0.97 * len(rows) and len(rows) == pages.count()
    unseen = ("<body><header>Site</header><div class='cookie-bar'>We use cookies here</div><main><p>A first paragraph of the story that is "
              "long enough to be one.</p><aside>Buy this now</aside><p>A second paragraph, which also goes on for a while.</p>"
              "<section class='comments'><p>I liked it very much, thank you.</p></section></main><form><p>Send us mail</p></form></body>")
    seq = blocks(unseen)
    assert main_text(seq, model.probabilities([vectors(seq)])[0]) == (
        "A first paragraph of the story that is long enough to be one.\n\nA second paragraph, which also goes on for a while.")
    odd = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>"), (3, "u", "x" * 10 ** 6), (3, "u", "x" * 10 ** 6)],
                                "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    got = extract_main_text(odd, model).collect()
    assert len(got) == 5 and all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2, None))
    assert extract_main_text(odd.limit(0), model).collect() == [] and page_sample(odd.limit(0)) == []


def test_deep_markup_keeps_its_path_and_open_elements_hide_nothing():
    deep = "<div class=sidebar>" + "<div>" * 300 + "inner" + "</div>" * 300 + "tail</div><p>after</p>"
    got = {b.text: [names for _, names in b.path] for b in blocks(deep)}
    assert ("sidebar",) in got["tail"] and ("sidebar",) in got["inner"] and got["after"] == [()]
    for tag in ("svg", "select", "object", "noscript", "iframe", "datalist", "template"):
        assert [b.text for b in blocks(f"<p>one</p><{tag}><p>two</p>")] == ["one", "two"]
        assert [b.text for b in blocks(f"<p>one</p><{tag}>x</{tag}><p>two</p>")] == ["one", "two"]
    for tag in ("script", "style", "textarea", "title"):
        assert [b.text for b in blocks(f"<p>one</p><{tag}><p>two</p>")] == ["one"]


def test_a_block_of_many_pieces_costs_no_square():
    import time
    took = []
    for n in (20_000, 80_000):
        start = time.process_time()
        assert blocks("<p>" + "<b>x</b>" * n + "</p>")[0].text == "x" * n
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 0.5


def test_numerals_without_a_letter_are_undetermined(spark):
    sample = [("de", "der alte Mann geht nach Haus"), ("en", "the old man walks home again")] * 3
    rows = [(1, "½ ² ① Ⅷ 12"), (2, "½ Haus"), (3, "_ _")]
    got = {r.doc_id: r.lang_pred for r in predict_languages(spark.createDataFrame(rows, "doc_id long, text string"), fit_languages(sample)).collect()}
    assert got == {1: "und", 2: "de", 3: "und"}


def test_long_texts_teach_the_dictionaries_beside_short_ones():
    from tillcast.llm.quality import DICTIONARY_TEXT_BYTES, _passage
    long = ("a very particular phrase of good prose " * 500).encode()
    assert len(_passage(long)) == DICTIONARY_TEXT_BYTES and _passage(b"short") == b"short" and _passage(b"") == b""
    sample = [(1, long.decode())] * 8 + [(1, "x y z")] + [(0, "@@@ ### junk " * 20)] * 8
    model = fit_quality(sample)
    assert b"particular phrase" in model.good

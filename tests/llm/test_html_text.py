"""Page extraction: hand-made pages, exact marginals, and accuracy on other pages than those learned from."""

from __future__ import annotations

import html
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitloom.llm import html_text

PAGES = "/root/testdata/sf0.01/pages.parquet"
LONG = "A sentence of an article that says something at some length, and then goes on. "


@pytest.fixture(scope="module")
def model(spark):
    return html_text.fit_on_table(spark.read.parquet(PAGES).where("page_id % 2 = 0"))


def article(source):
    """The text of the test pages' article element."""
    inner = re.search("<article>(.*?)(</article>|$)", source, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>|</?p>|</?h1>", " ", inner))).split())


def test_pages_of_the_table(spark, model):
    pages = spark.read.parquet(PAGES).where("page_id % 2 = 1")
    expected = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    found = html_text.extract_main_text(pages, model).collect()
    assert np.mean([r["text"] == expected[r["page_id"]] for r in found]) > 0.99
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_pages_with_other_wrapping(spark, model):
    rows = [r[0] for r in spark.read.parquet(PAGES).where("page_id % 2 = 1").select("html").collect()]
    rng = random.Random(99)
    blocks = [[b for b in (" ".join(p.split()) for p in re.findall("<p>([^<]+)", r)) if b] for r in rows]
    rest = [b for some in blocks for b in some[:2]]
    good = total = 0
    for some in blocks:
        if len(some) < 2:
            continue
        page = html_text.read_page(html_text.other_page(rng, some, rest))
        y = html_text.labels(page)
        p = html_text.marginals(model, html_text.plant([page]))[0]
        leaf = np.array([t is not None for t in page.text])
        good += ((p > 0.5) == y)[leaf].sum()
        total += leaf.sum()
    assert good / total > 0.97


def test_chrome_goes(model):
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body>
    <header><h1>Site</h1><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></header>
    <div class="cookie-notice"><p>We use cookies. {LONG}</p></div>
    <main><article class=post><h1>Title of it</h1><p>{LONG}<b>bo</b>ld &amp; caf&eacute;&nbsp;&#33;
    <p>{LONG}<script>var x = "<p>no</p>";</script><!-- not <p> this -->
    <div class="advert">Buy now. {LONG}</div><blockquote>{LONG}</blockquote>
    </article><section id="comments"><h2>Comments</h2><p>{LONG}</p><form><textarea>say</textarea><button>Send</button></form></section></main>
    <aside class="sidebar"><p>{LONG}</p></aside><footer><p>&copy; 2024 Site. {LONG}</p></footer></body></html>"""
    long = LONG.strip()
    assert html_text.page_texts(model, [page]) == [f"Title of it {long} bold & café ! {long} {long}"]


def test_marginals_are_exact():
    """Sum-product against all states of small trees."""
    rng = np.random.default_rng(3)
    pages = [html_text.read_page(s) for s in ("<div>a<p>b</p></div>c", "<ul><li>x<li>y</ul>", "z")]
    model = html_text.TreeModel(rng.normal(size=len(html_text.FEATURES)), rng.normal(size=(2, 2, 2)))
    got = html_text.marginals(model, html_text.plant(pages))[0]
    at = 0
    for page in pages:
        n = len(page.parent)
        whole, on = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=n):
            score = sum(model.weights[page.features[i]].sum() for i in range(n) if states[i])
            for i in range(1, n):
                score += model.potentials[int(page.text[i] is not None), states[page.parent[i]], states[i]]
            whole += np.exp(score)
            on += np.exp(score) * np.array(states)
        assert np.allclose(got[at : at + n], on / whole)
        at += n


def test_broken_pages_do_not_crash(model):
    odd = ["", "<", "<p", "</p>", "<a <b> \"", "<div " + "x='" * 50, "<p>" * 3000 + "deep", "<div>" * 3000 + "deep", "<!-- open", "<script>open", "&#xFFFFFFF; &bogus; &am"]
    texts = html_text.page_texts(model, odd)
    assert len(texts) == len(odd) and texts[0] == ""


def test_odd_rows(spark, model):
    rows = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 2), (2, "v", f"<article><p>{LONG}</article>", 3)], "page_id long, url string, html string, text int")
    found = sorted((tuple(r) for r in html_text.extract_main_text(rows, model).collect()), key=str)
    long = LONG.strip()
    assert found == sorted([(None, None, "", 0), (1, "u", "", 0), (2, "v", long, len(long))], key=str)
    assert html_text.extract_main_text(rows.limit(0), model).count() == 0
    assert not html_text.fit_on_table(rows.limit(0)).weights.any()


def test_unmatched_tags_take_time_in_proportion():
    k = 30_000
    for source in ("<span>" * k + "</b>" * k, "<b><table>" + "<span>" * k + "</b>" * k, "<span>" * k + "<div></div>" * k, "<p>" + "<i>" * k + "</p><p>" * k):
        assert len(source) >= 300_000
        start = time.perf_counter()
        html_text.read_page(source + LONG)
        assert time.perf_counter() - start < 15


def test_pages_that_do_not_mark_their_article(spark):
    """Without any article element the model learns from made-up pages, and still finds most of the text."""
    pages = spark.read.parquet(PAGES).where("page_id % 4 = 0")
    plain = pages.withColumn("html", F.regexp_replace("html", "<(/?)article", "<$1div"))
    model = html_text.fit_on_table(plain)
    expected = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    found = html_text.extract_main_text(plain, model).collect()
    shares = [len(set(r["text"].split()) & set(expected[r["page_id"]].split())) / max(1, len(set(expected[r["page_id"]].split()))) for r in found]
    assert np.mean(shares) > 0.8

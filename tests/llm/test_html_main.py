import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_main as h
from tidemark.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return h.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def article(html):
    """The text of the article element, by cutting the page at its tags."""
    import re
    from html import unescape

    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)
    blocks = re.split(r"</?(?:h1|p)>", inner[1]) if inner else []
    texts = (" ".join(unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks)
    return " ".join(t for t in texts if t)


def test_query_on_whole_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op9_html_main_text(spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PROSE = "The river ran past the old mill, and nobody in the town could say who had built it. " * 4


@pytest.mark.parametrize(
    "opening", ["<main>", '<div class="post-content">', '<div id="content">', '<section class="article-body">', '<div class="entry">', "<article>"]
)
@pytest.mark.parametrize(
    "junk",
    [
        '<div class="sidebar"><p>Most read today in our town</p></div>',
        '<aside><h3>Related</h3><p>Another story, which you may like.</p></aside>',
        '<div id="cookie-banner">We use cookies, please accept.</div>',
        '<form><label>Your mail</label><p>Sign up for the newsletter, it is free.</p></form>',
        '<section id="comments"><div class="comment"><p>I read this twice, and liked it.</p></div></section>',
        '<div class="ad">Buy now.</div>',
        '<header class="site-header"><p>The Daily News</p></header>',
    ],
)
def test_other_markups(model, opening, junk):
    tag = opening[1:].split()[0].rstrip(">")
    page = f"<html><body><nav><a href=/>Home</a></nav><div class=wrap>{opening}<h1>Title here</h1><p>{PROSE}</p><p>{PROSE}</p></{tag}>{junk}</div><footer>&copy; 2020</footer></body></html>"
    want = " ".join(["Title here", PROSE.strip(), PROSE.strip()])
    assert h.main_text(page, model) == want


def test_bare_pages(model):
    page = f"<h1>Title</h1><p>{PROSE}<a href=x>a link</a> in it.</p><ul><li>{PROSE}</li></ul><div class=sidebar><p>Read more.</p></div><p>{PROSE}</p>"
    assert h.main_text(page, model) == " ".join(["Title", PROSE + "a link in it.", PROSE.strip(), PROSE.strip()])


def test_marginals_equal_enumeration():
    rng = random.Random(6)
    for _ in range(20):
        n = rng.randrange(2, 9)
        nodes = [h.Node("#root", -1, frozenset(), False)]
        for i in range(1, n):
            nodes.append(h.Node(rng.choice(["p", "div", "nav"]), rng.randrange(i), frozenset(), False))
        draw = lambda: [[rng.uniform(-3, 0), rng.uniform(-3, 0)], [rng.uniform(-3, 0), rng.uniform(-3, 0)]]
        pair, root = {t: draw() for t in ("p", "div", h._OTHER)}, [rng.uniform(-2, 0), rng.uniform(-2, 0)]
        speak = {look: (rng.uniform(-2, 0), rng.uniform(-2, 0)) for x in nodes for look in h.looks(x)}
        weights = {}
        for ys in itertools.product((0, 1), repeat=n):
            w = sum(speak[look][y] for x, y in zip(nodes, ys) for look in h.looks(x))
            edges = sum(pair.get(nodes[i].tag, pair[h._OTHER])[ys[nodes[i].parent]][ys[i]] for i in range(1, n))
            weights[ys] = math.exp(w + edges + root[ys[0]])
        total = sum(weights.values())
        want = [sum(w for ys, w in weights.items() if ys[i]) / total for i in range(n)]
        got = h.TreeModel(root, pair, speak).marginals(nodes)
        assert all(abs(a - b) < 1e-9 for a, b in zip(got, want))


def test_parsing(model):
    def blocks(html):
        _, stream = h.parse(html)
        return " ".join("".join(p if p != "\0" else " | " for _, p in stream).split())

    assert blocks("a<p>b<p>c &amp; &eacute;&nbsp;d</p>e") == "a | b | | c & é d | e"
    assert blocks("<script>var t='</p>';</script>x<!-- <p> -->y<style>z") == "| x y".replace("x y", "xy") + " |"
    assert "1 < 2" in blocks("<p>1 < 2</p>") and blocks("<p>cut<di") == "| cut |"
    assert blocks("<p>a<br>b<b>c</p>d") == "| a bc | d"


def test_edge_cases(spark, model):
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain"), (4, "u", deep), (5, "u", "<article><p>" + "word " * 200_000), (5, "u", "<"), (None, "u", "<p")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = h.extract(pages, model).collect()
    assert len(got) == 7 and all(r.text is not None for r in got)
    by = {(r.page_id, len(r.text)): r.text for r in got}
    assert (1, 0) in by and (2, 0) in by and (5, 999_999) in by
    assert h.extract(pages.limit(0), model).count() == 0
    assert h.fit(pages.limit(0)).marginals(h.parse("<p>x")[0])


def test_open_head_and_formulas():
    def shown(html):
        nodes, stream = h.parse(html)
        return " ".join("".join(" " if t == "\0" else t for n, t in stream if not nodes[n].hidden).split())

    assert shown("<head><title>T</title><main><p>one two</p></main>") == "one two"
    assert shown("<head><title>T</title><meta charset=x></head><p>one</p>") == "one"
    assert shown("<article><p>so <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds</p></article>") == "so a=2 holds"


def test_nothing_of_an_article_is_dropped(model):
    """Paragraphs and lists that are all links, summaries, tables and definitions."""
    inside = {
        f"<p><a href=x>{PROSE.strip()}</a></p>": PROSE.strip(),
        "<p><a href=x>One link, alone in its paragraph</a></p>": "One link, alone in its paragraph",
        "<ul><li><a href=x>First source</a></li><li><a href=y>Second source</a></li></ul>": "First source Second source",
        "<details><summary>What is known so far</summary><p>Not much, but for the date.</p></details>": "What is known so far Not much, but for the date.",
        "<table><tr><th>Year</th><th>Sum</th></tr><tr><td>1901</td><td>12</td></tr></table>": "Year Sum 1901 12",
        "<dl><dt>Mill</dt><dd>A house that grinds corn.</dd></dl>": "Mill A house that grinds corn.",
    }
    for part, text in inside.items():
        for opening in ("<article>", "<main>", '<div class="post-content">'):
            tag = opening[1:].split()[0].rstrip(">")
            page = f"<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li></ul></nav>{opening}<h1>Title here</h1><p>{PROSE}</p>{part}<p>{PROSE}</p></{tag}><footer><a href=/b>Imprint</a></footer></body></html>"
            assert h.main_text(page, model) == " ".join(["Title here", PROSE.strip(), text, PROSE.strip()])


def test_comments_and_adverts_inside_an_article_stay_out(model):
    for junk in (
        '<section id="comments"><h3>Comments</h3><div class="comment"><p>I read this twice, and liked it.</p></div></section>',
        '<div class="ad sponsored"><a href=x>Buy now, and save.</a></div>',
        '<aside class="related"><ul><li><a href=x>Another story</a></li></ul></aside>',
    ):
        page = f"<html><body><article><h1>Title here</h1><p>{PROSE}</p>{junk}<p>{PROSE}</p></article></body></html>"
        assert h.main_text(page, model) == " ".join(["Title here", PROSE.strip(), PROSE.strip()])


@pytest.mark.parametrize("page", ["<b>" * 8_000 + "</p>" * 8_000, "<p><li>" + "<b>" * 8_000 + "<h1></h1>" * 8_000, "<div>" * 8_000 + "</td>" * 8_000])
def test_unclosed_tags_cost_in_proportion(page):
    start = time.perf_counter()
    h.parse(page)
    assert time.perf_counter() - start < 1


def test_copies_of_a_page_are_one_page(spark, model):
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(20)
    first = pages.limit(1)
    for _ in range(6):
        first = first.union(first)
    assert h.fit(pages.union(first)) == h.fit(pages)

from __future__ import annotations

import html as std
import itertools
import math
import re

import numpy as np
import pytest

from logsilt.llm import html, queries
from logsilt.llm.common import table
from logsilt.llm.seed_pages import SEED_PAGES

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string"


def article_text(page):
    """The article of the synthetic pages, which hold h1, p, b and br only."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    blocks = re.sub(r"</?b>", "", inner).replace("<br>", " ")
    blocks = [" ".join(std.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", blocks)]
    return "\n".join(b for b in blocks if b)


def test_query(spark):
    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    rows = queries.op10_html_tree(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article_text(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.fixture(scope="module")
def reader(spark):
    return html.Reader(html.train(table(spark, SF, "pages")))


def test_other_kinds_of_page(reader):
    """Parts that the corpus lacks: held-out pages, written like none of the seed pages."""
    body = "<p>It was a long day, and when it ended, all of us were glad. We went home by the old road. </p><p>Short.</p>" * 3
    page = f"""<!doctype html><html><head><title>T</title><script>document.write("<p>no</p>")</script></head><body class=home>
<header><div class="logo">Site</div></header><nav><a href=1>One</a></nav><div class="cookie-banner">We use cookies. OK?</div>
<div class="wrapper"><article class="post"><h1>A &lt;day&gt; &amp; more&hellip;</h1>{body}<div class="share-buttons"><a href=x>Share</a></div>
<div class="advertisement">Buy now! Only today.</div><ul><li><a href=y>A linked item</a></li><li>Two</li></ul></article>
<aside>Read this too. It is good.</aside><section id="comments"><h2>3 comments</h2><p>First! I really liked it. Thanks a lot.</p>
<p>Me too, and I will say why at some length, since there is room. It was well told. </p></section></div>
<form><label>Mail</label><input></form><footer>&copy; 2024 Site. All rights reserved.</footer></body></html>"""
    want = ["A <day> & more…"] + ["It was a long day, and when it ended, all of us were glad. We went home by the old road.", "Short."] * 3 + ["A linked item", "Two"]
    assert reader.blocks(page) == want
    main = page.replace('<article class="post">', '<div class="entry-content">').replace("</article>", "</div>")
    assert reader.blocks(main) == want


def test_seed_pages(reader):
    for page in SEED_PAGES:
        nodes = html.parse(page)
        labels = html.label_nodes(nodes)
        want = [" ".join("".join(n.text).split()) for n, y in zip(nodes, labels, strict=True) if n.text and y == 1]
        assert reader.blocks(page) == want


@pytest.mark.parametrize("page", ["", "plain", "<", "<p", "<!--", "<script>x", "</div></p></b>", "<div>" * 3000, "<a <b> c='>'>x</a>", "\x00<p>퟿"])
def test_broken_pages_do_not_fail(reader, page):
    assert isinstance(reader.blocks(page), list)


def test_blocks():
    leaves = lambda page: [" ".join("".join(n.text).split()) for n in html.parse(page) if n.text]
    assert leaves("<p>a<b>b\n <i>c</i><br>d&nbsp;e<p>f &amp g&#x41;<div>h</div>i") == ["ab c d e", "f & gA", "h", "i"]
    assert leaves("<ul><li>a<li>b<ul><li>c</ul></ul><td>x<td>y") == ["a", "b", "c", "x", "y"]
    assert leaves("<p>a<!-- x --><script>'</p>'</script>b<style>p{}</style></p>") == ["ab"]


def test_messages_give_exact_marginals():
    rng = np.random.default_rng(1)
    for _ in range(5):
        model = html.Model(rng.normal(0, 1, len(html.FEATURES) + 1), np.log(rng.uniform(0.05, 1, (html.EDGES, 2, 2))))
        nodes = html.parse('<div class="post"><p>a b.</p><ul><li>x</li></ul></div><nav>n</nav><section>t</section>')
        odds = html.Reader(model).marginals(nodes)
        sums = np.zeros((len(nodes), 2))
        for labels in itertools.product((0, 1), repeat=len(nodes)):
            score = sum(model.evidence(n.bits) * y for n, y in zip(nodes, labels, strict=True) if n.bits)
            score += sum(model.edges[html.edge_kind(n), labels[n.parent], y] for n, y in zip(nodes[1:], labels[1:], strict=True))
            for i, y in enumerate(labels):
                sums[i, y] += math.exp(score)
        assert np.allclose(odds, np.log(sums[:, 1] / sums[:, 0]), atol=1e-8)


def test_odd_rows(spark):
    page = "<html><body><nav><a href=x>Menu</a></nav><article><p>Some words to read. And some more of them.</p></article></body></html>"
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, page, None), (2, "u", None, "x"), (3, "u", "", "x"), (4, "u", "<p>" + "long " * 200_000, "x")]
    got = html.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6
    assert sorted((r.text for r in got if r.page_id in (1, None)), key=str) == ["Some words to read. And some more of them."] * 3
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (2, 3))
    assert html.extract(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize(
    "between",
    ["<!-- <script src=a.js> -->", "<i title='<style>'></i>", "<style-guide></style-guide>", "<script>a = '<p>no</p>'</script>", "<style/>p {}</style>"],
)
def test_what_looks_like_a_script_cuts_nothing(between):
    nodes = html.parse(f"<article><p>One.</p>{between}<p>Two.</p><p>Three.</p></article>")
    assert [" ".join("".join(n.text).split()) for n in nodes if n.text] == ["One.", "Two.", "Three."]

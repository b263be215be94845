from __future__ import annotations

import pytest

from martlet.llm.site_style_tree import TreeParams, extract_main_text, host_of, importance, observations, page_text, parse

SCHEMA = "page_id long, url string, html string"


def text(html):
    return page_text(html, "", frozenset())


def test_parsing():
    assert text("<p>One<p>Two &amp; <b>three</b>&nbsp;four<br>five") == "One\nTwo & three four five"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a\nb\nc d\ne"
    assert text('<p title="a > b">x</p><script>var t="</p>";</script><style>p{}</style><p>y &am') == "x\ny &am"
    assert text("<p>1 < 2 and 3 > 2</p><!-- no --><p>z</p") == "1 < 2 and 3 > 2\nz"
    assert text("<div>a<div>b</div>c</div>") == "a\nb\nc"
    assert text(None) == text("") == text("   ") == text("<p></p>") == ""
    assert text("plain &lt;b&gt; text") == "plain <b> text"
    assert len(text("<p>w</p>" * 50_000).split("\n")) == 50_000
    assert text("<div>" * 100_000 + "deep") == "deep"


def test_declared_roles_go():
    html = """<html><body><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav><div class="cookie-notice">We use</div>
    <div id="leftSidebar">side</div><form>search<input></form><aside>more</aside>
    <article><header><h1>Title</h1></header><p>Body.</p><div class="ad">Buy</div><p hidden>no</p>
    <section class="comments"><article><p>reader</p></article></section><article><p>nested reply</p></article></article>
    <div role="dialog">x</div><footer>(c)</footer></body></html>"""
    assert text(html) == "Title\nBody."
    assert text("<form><main><p>whole page in a form</p></main></form>") == "whole page in a form"
    for name in ("topnav", "site-footer", "cookiebar", "userComments", "AdSlot", "page_header", "leftSidebar", "advertisement-2"):
        assert text(f"<div class='{name}'>gone</div><p>kept</p>") == "kept", name
    for name in ("content", "adventure", "shadow", "load-more-text", "heading", "recommendation"):
        assert text(f"<div class='{name}'>here</div><p>kept</p>") == "here\nkept", name
    assert text("<main><p>m</p><div class='widget'>w</div></main><p>outside</p>") == "m"


def test_tree_removes_what_the_site_repeats(spark):
    """Boilerplate in unnamed containers, which only the merged tree can tell."""
    rows = [
        (i, f"https://one.example/{i}",
         f"<div><p>Welcome to our site</p></div><div><p>Story {i} tells of {i * 7}.</p><p>The end of {i}.</p><p>Common line.</p></div><div><p>Made by us</p></div>")
        for i in range(40)
    ]
    rows += [(100, "https://two.example/", rows[0][2]), (101, None, rows[0][2]), (102, "https://three.example/x", None)]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "'x' AS text")
    for params in (TreeParams(), TreeParams(broadcast_nodes=0)):
        got = {r["page_id"]: r for r in extract_main_text(pages, params).collect()}
        assert len(got) == len(rows)
        for i in range(40):
            assert got[i]["text"] == f"Story {i} tells of {i * 7}.\nThe end of {i}.\nCommon line." and got[i]["n_chars"] == len(got[i]["text"])
        assert got[100]["text"].startswith("Welcome") and got[101]["text"].startswith("Welcome")
        assert got[102]["text"] == "" and got[102]["n_chars"] == 0


def test_importance_of_known_nodes(spark):
    rows = [(i, "http://h/x", f"<div><p>same</p></div><section><p>own {i}</p></section>") for i in range(16)]
    found = {}
    blocks, _ = parse(rows[0][2])
    from martlet.llm.site_style_tree import _node
    for r in importance(observations(spark.createDataFrame(rows, SCHEMA)), TreeParams()).collect():
        found[r["node"] % (1 << 64)] = r
    same, own = (found[_node("h", next(b.paths))] for b in blocks)
    assert same["m"] == own["m"] == 16
    assert same["content"] == pytest.approx(0) and own["content"] == pytest.approx(1)


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(i, "http://copies/x", "<div><p>Only this.</p></div>") for i in range(20)]
    got = extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["text"] for r in got} == {"Only this."} and len(got) == 20


def test_given_pages_and_empty_table(spark):
    import html
    import re

    from .tests_data import SMALL

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    expected = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", body)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", x)).split()) for x in parts]
        expected[r["page_id"]] = "\n".join(x for x in lines if x)
    assert {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()} == expected
    assert extract_main_text(pages.where("false")).count() == 0


def test_hosts():
    assert host_of("HTTPS://u:p@WWW.Example.org:80/a?b#c") == "www.example.org"
    assert host_of("//x.y/z") == "x.y" and host_of(None) == host_of("") == host_of("/rel") == ""


def test_names_of_body_text_within_an_article(prose):
    from martlet.llm.site_style_tree import page_text

    parts = [
        '<div class="share-price">Shares rose.</div>', '<section id="form-and-function">Form follows.</section>', '<p class="alert">Mind the gap.</p>',
        '<div class="related-work">Others wrote.</div>', '<table class="search-results"><tr><td>Found it.</td></tr></table>', '<h2 class="widget-title">Widgets</h2>',
    ]
    gone = ['<div class="ad">Buy</div>', '<div class="comments x">First!</div>', '<div role="navigation">Up</div>', "<aside>Other</aside>", '<p hidden>no</p>']
    html = f"<html><body><div class='share-bar'>Share</div><article>{''.join(parts + gone)}</article></body></html>"
    assert page_text(html, "", frozenset()).split("\n") == ["Shares rose.", "Form follows.", "Mind the gap.", "Others wrote.", "Found it.", "Widgets"]


def test_the_tree_decides_where_names_tell_nothing(spark, prose):
    """A site without telling tags, classes or ids: with an empty tree the
    boilerplate stays, with its tree exactly the body text is left."""
    from martlet.llm.site_style_tree import extract_main_text, page_text

    rows, bodies = [], {}
    for i in range(24):
        body = [prose(1000 + 7 * i + j, 30) for j in range(3)]
        bodies[i] = "\n".join(body)
        top = "<div class='a1'><p>Start</p><p>About us</p><p>All our topics</p></div>"
        low = f"<div class='a3'><p>Made with care in our town.</p><p>Read on: {['one', 'two'][i % 2]}</p></div>"
        main = "<div class='a2'>" + "".join(f"<p>{b}</p>" for b in body) + "</div>"
        rows.append((i, f"https://plain.example/{i}", f"<html><body>{top}{main}{low}</body></html>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    assert got == bodies
    without = {i: page_text(html, "plain.example", frozenset()) for i, _, html in rows}
    assert all(without[i] != bodies[i] and "All our topics" in without[i] for i in bodies)

from __future__ import annotations

import html
import re
import time

import pytest

from retrocohort.llm.html_text import extract_pages, main_text, parse
from retrocohort.llm.texts import table


def expected(page):
    """The article of the test pages, taken from their fixed shape."""
    body = page.split("<article>", 1)[1].split("</article>")[0]
    body = re.sub(r"<[a-zA-Z/][^<>]*\Z", "", body)
    parts = [html.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(x for x in (" ".join(p.split()) for p in parts) if x)


def test_articles_of_the_table(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    source = {r.page_id: r for r in pages.collect()}
    got = extract_pages(pages).collect()
    assert len(got) == len(source)
    for r in got:
        assert r.text == expected(source[r.page_id].html)
        assert (r.url, r.n_chars) == (source[r.page_id].url, len(r.text))


PROSE = [f"Paragraph {i} of the article has words, and then some more words, so that it is long." for i in range(6)]
ARTICLE = "".join(f"<p>{p}</p>" for p in PROSE)
LINKS = "".join(f'<li><a href="/{i}">Go to the page number {i} of this site</a></li>' for i in range(20))


def page(before="", after="", article=ARTICLE, wrap="div"):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body>{before}<{wrap}>{article}</{wrap}>{after}</body></html>"


def test_clutter_goes_whatever_holds_the_article():
    clutter = [
        f"<nav><ul>{LINKS}</ul></nav>", "<header><h2>Site</h2><p>Slogan of the site</p></header>", f'<ul class="menu">{LINKS}</ul>',
        '<aside><p>Something beside it that is long enough to count as text.</p></aside>', '<div id="sidebar"><p>Side text here.</p></div>',
        '<div class="cookie-notice"><p>We use cookies. Please accept all of them, thank you very much.</p></div>',
        '<section class="comments"><h3>Comments</h3><article class="comment"><p>I like it a lot, nice read.</p></article></section>',
        "<form><label>Name</label><input><textarea>x</textarea><button>Send</button></form>", "<script>var a='<p>x</p>'</script>",
        "<footer>&copy; 2020</footer>", '<div role="dialog">Sign up now</div>', "<p hidden>secret</p>", "<noscript>Enable it</noscript>",
        '<div class="adBox"><p>Buy this wonderful thing today, it is cheap and good.</p></div>', "<!-- <p>comment</p> -->",
    ]
    for wrap in ("article", "main", "div", "section"):
        for c in clutter:
            assert main_text(page(before=c, wrap=wrap)).split("\n") == PROSE, (wrap, c)
            assert main_text(page(after=c, wrap=wrap)).split("\n") == PROSE, (wrap, c)
        assert main_text(page("".join(clutter), "".join(clutter), wrap=wrap)).split("\n") == PROSE
    assert main_text(page(article=ARTICLE + clutter[6] + clutter[13], wrap="article")).split("\n") == PROSE


def test_names_that_articles_have_too():
    prose = "\n".join(PROSE)
    assert main_text(f"<body><article class='post comments-open'>{ARTICLE}</article></body>") == prose
    assert main_text(f"<body><div id='page' class='no-comments'>{ARTICLE}</div></body>") == prose
    assert main_text(f"<body><div id='page' class='no-comments'><article>{ARTICLE}</article></div></body>") == prose
    assert main_text(f"<body><div class='comments'>{ARTICLE}</div></body>") == prose
    part = "<h2>A part</h2><p>It has text that belongs to the article as well.</p>"
    for name in ("id='discussion'", "class='related-work'", "class='social-history'", "class='notice'"):
        got = main_text(page(article=f"{ARTICLE}<section {name}>{part}</section>", wrap="article"))
        assert got == f"{prose}\nA part\nIt has text that belongs to the article as well.", name


def test_long_comments_go():
    said = "".join(f"<article class='comment-body'><p>{p}</p></article>" for p in PROSE * 3)
    for wrap in ("article", "main"):
        for name in ("id='comments'", "class='comments-area'", "class='comment-list'"):
            assert main_text(page(after=f"<div {name}>{said}</div>", wrap=wrap)).split("\n") == PROSE


def test_reference_lists_of_pages_without_article():
    refs = "<h2>References</h2><ol>" + "".join(f"<li><a href='/{i}'>Title of the cited work {i}</a></li>" for i in range(3)) + "</ol>"
    got = main_text(page(before=f"<ul>{LINKS}</ul>", article=ARTICLE + refs))
    assert got.split("\n") == [*PROSE, "References", *(f"Title of the cited work {i}" for i in range(3))]


def test_blocks_and_references():
    got = main_text(page(article="<h1>A &amp; B</h1><p>x &lt;b&gt; &#233;&nbsp;y\n\t z<p>un<b>clos</b>ed <i>one<p>two<ul><li>i<li>j</ul>tail"))
    assert got == "A & B\nx <b> é y z\nunclosed one\ntwo\ni\nj\ntail"
    cut = main_text("<body><article><p>Long words in the page that ends</p><p>inside of a tag <a href='x")
    assert cut == "Long words in the page that ends\ninside of a tag"


def test_odd_pages(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, None, "plain words only"), (3, "v", "<p>" * 3000 + "deep"), (4, "w", page(article="<p>" + "word " * 200_000 + "</p>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = extract_pages(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 16), (3, 4), (4, 999_999)]
    assert extract_pages(pages.limit(0)).isEmpty()
    assert main_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"


@pytest.mark.parametrize("tag", ["<div>", "<p>", "<b>", "<td>", "<table><tr><td>", '<div class="related">', "<b></i>"])
def test_deep_pages_take_seconds(tag):
    began = time.monotonic()
    assert main_text(tag * 100_000 + "words at the end") == "words at the end"
    assert time.monotonic() - began < 60


def test_which_elements_an_end_tag_closes():
    body = parse("<div><p>a<div>b</p>c<span>d</div>e</span>f<table><tr><td>g<table><tr><td>h<td>i</table>j<tr>k")
    shape = [(n.tag, n.parent.tag if n.parent else None, sum(isinstance(c, str) for c in n.children)) for n in body.elements()]
    assert shape == [
        ("p", "div", 1),
        ("span", "div", 1),
        ("div", "div", 2),
        ("td", "tr", 1),
        ("td", "tr", 1),
        ("tr", "table", 0),
        ("table", "td", 0),
        ("td", "tr", 2),
        ("tr", "table", 0),
        ("tr", "table", 1),
        ("table", "div", 0),
        ("div", "html", 2),
        ("html", None, 0),
    ]
